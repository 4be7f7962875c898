"""Checks on a run: duplicates, orphans, bad names, ratios, drops. Every check is one aggregate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .upsert import keep_top

# What no building name holds; the second is harmless beside 棟.
BAD_NAME_TOKENS = ("》", "号", "NEW")
#: The reason of a file without rows.
NO_ROWS = "extracted_rows=0"


def duplicate_groups(df: DataFrame, *keys: str) -> DataFrame:
    """Groups of more than one row, without rows whose key is empty."""
    filled = reduce(lambda a, k: a & (F.coalesce(F.col(k).cast("string"), F.lit("")) != ""), keys, F.lit(True))
    return df.where(filled).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def share(cond: Column) -> Column:
    """Aggregate: the part of the rows for which cond holds; null counts as not."""
    return F.avg(F.coalesce(cond, F.lit(False)).cast("int"))


def doctor(buildings: DataFrame, listings: DataFrame, unmatched: int = 0, policy: str = "warn") -> DataFrame:
    """(check, value, level): duplicate names, duplicate addresses, orphans, unmatched facts."""
    pairs = duplicate_groups(buildings, "norm_name", "norm_address").agg(F.count(F.lit(1)).alias("value"))
    places = duplicate_groups(buildings, "canonical_address").agg(F.count(F.lit(1)).alias("value"))
    lost = listings.where("coalesce(building_key, '') <> ''").join(buildings.select(F.col("building_id").alias("building_key")), "building_key",
        "left_anti").agg(F.count(F.lit(1)).alias("value"))
    rows = [(pairs, "duplicate_name_address", "NG"), (places, "duplicate_address", "NG"), (lost, "orphan_listings", "NG")]
    out = reduce(DataFrame.unionByName, [d.select(F.lit(c).alias("check"), F.col("value").cast("long"), F.when(F.col("value") > 0, lvl).otherwise("OK").alias("level"))
        for d, c, lvl in rows])
    facts = buildings.sparkSession.range(1).select(F.lit("unmatched_facts").alias("check"), F.lit(unmatched).cast("long").alias("value"),
        F.lit("OK" if not unmatched else policy.upper()).alias("level"))
    return out.unionByName(facts)


def looks_like_money(col: Column) -> Column:
    return col.rlike(r"\d{1,3}(,\d{3})+|円|万")


def looks_like_address(col: Column) -> Column:
    return col.rlike(r"(都|道|府|県|市|区|町|村).*(丁目|番地|番|号|\d+-\d+)")


def structure_or_age(col: Column) -> Column:
    return col.rlike(r"RC|SRC|S造|木造|鉄骨|鉄筋|築\d+年|築年")


def noise_line(col: Column) -> Column:
    """A line of a report that carries no data: contact lines, page counters, dates, titles."""
    return (col == "") | col.rlike(r"(?i)TEL[:：]|FAX[:：]|^\d+/\d+(?:頁|ページ)?$|空室一覧表|^\d{4}[/-]\d{1,2}[/-]\d{1,2}|^\d{1,2}:\d{2}|北九州市.*区$|号室名をクリック|リアプロにログイン|詳細情報のウェブページ")


def bad_name(col: Column) -> Column:
    tokens = reduce(lambda a, t: a | (F.contains(col, F.lit(t)) & (~F.contains(col, F.lit("棟")) if t == "号" else F.lit(True))), BAD_NAME_TOKENS, F.lit(False))
    return (F.length(col) <= 2) | col.rlike(r"^\d{2,4}$") | tokens


def two_decimals(ratio: Column) -> Column:
    """A ratio of 0.125 to 1 with two decimals, rounded from its exact binary value, halves to the even digit."""
    exact = (ratio * F.lit(float(1 << 56))).cast("long") * 100  # a whole number: such doubles have no bits below 2 ** -56
    whole, rest = F.shiftright(exact, 56), exact.bitwiseAND(F.lit((1 << 56) - 1))
    up = (rest > 1 << 55) | ((rest == 1 << 55) & (whole % 2 == 1))
    cents = whole + up.cast("int")
    return F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def qc(rows: DataFrame, group: str, category: Column, name: Column, address: Column, room: Column, files: DataFrame | None = None) -> DataFrame:
    """(group, rows, reasons): what is wrong with the extracted rows of a file; reasons is an array.

    Names, addresses and rooms in normal text form. files: (group) of all files, those without rows included."""
    name, address, room = (F.coalesce(c, F.lit("")) for c in (name, address, room))
    g = rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("rows"), share(bad_name(name)).alias("bad"), F.bool_or((category == "realpro") & name.rlike(r"TEL|FAX|^\d+/\d+頁$")).alias("noise"),
        F.bool_or(looks_like_money(address)).alias("money"), F.bool_or(address == "").alias("no_address"),
        share(room == "").alias("no_room"), F.bool_or(category.isin("ulucks", "realpro")).alias("roomed"),
            F.bool_or((category == "realpro") & (room != "") & (name == "")).alias("nameless"),
    )
    reasons = F.array_compact(F.array(
        F.when(F.col("bad") >= 0.20, F.concat(F.lit("building_name_bad_ratio="), two_decimals(F.col("bad")))),
        F.when(F.col("noise"), F.lit("building_name_contains_noise")), F.when(F.col("money"), F.lit("address_looks_like_money")),
            F.when(F.col("no_address"), F.lit("address_empty")),
        F.when(F.col("roomed") & (F.col("no_room") >= 0.50), F.concat(F.lit("room_empty_ratio="), two_decimals(F.col("no_room")))),
            F.when(F.col("nameless"), F.lit("building_name_missing_with_room")),
    ))
    found = g.select(group, F.col("rows").cast("long"), reasons.alias("reasons"))
    if files is None:
        return found
    every = files.select(group).distinct().join(found, group, "left")
    return every.select(group, F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), F.coalesce("reasons", F.array(F.lit(NO_ROWS))).alias("reasons"))


def qc_stops(reports: DataFrame, mode: str, harmless: tuple[str, ...] = ()) -> bool:
    """Does strict mode stop the run? Harmless reasons (by their text before =) do not count."""
    bad = reports.where(F.exists("reasons", lambda r: ~F.substring_index(r, "=", 1).isin(*harmless) if harmless else F.lit(True)))
    return mode == "strict" and bool(bad.head(1))


def drop_percent(before: Column, after: Column) -> Column:
    """Whole percent lost from one run to the next, half to even."""
    return F.when(before > 0, F.bround((before - after) * 100.0 / before, 0).cast("int"))


def weekly_gate(attached: int, unresolved: int, before: int, after: int, most_unresolved: int = 200, most_drop: int = 60) -> list[str]:
    """Why a new run may not become current."""
    lost = round((before - after) * 100 / before) if before else 0
    return [why for why, bad in (("nothing_attached", attached == 0), ("too_many_unresolved", unresolved > most_unresolved), ("collapsed", before > 0 and after == 0),
        ("dropped", before > 0 and lost >= most_drop)) if bad]


def top_values(df: DataFrame, cols: list[str], n: int) -> DataFrame:
    """(column, value, n): the most frequent values of several columns in one pass; blanks are <empty>."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), F.lit("<empty>"))
        .alias("value")) for c in cols])).alias("x")).select("x.*")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return keep_top(counts, ["column"], n, F.desc("n"), "value")


def latest_texts(rows: DataFrame, raw: str, day: str, n: int = 20) -> DataFrame:
    """The rows with a text, newest first, ties by the text, as many as a look at them takes."""
    return rows.where(F.coalesce(raw, F.lit("")) != "").orderBy(F.col(day).desc_nulls_last(), raw).limit(n)


def availability_counts(rows: DataFrame, category: str, raw: Column, immediate: Column, date: Column) -> DataFrame:
    """Per category: rows, filled texts, inferred immediate ones and dates."""
    return rows.groupBy(F.coalesce(F.nullif(F.trim(category), F.lit("")), F.lit("(empty)")).alias("category")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(raw, F.lit("")) != "").alias("filled"), F.count_if(immediate).alias("immediate"),
            F.count_if(date.isNotNull()).alias("dated")
    )


def distinct_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of rows, of distinct pairs, and of rows that lack either part."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(F.struct(a, b)).alias("pairs"), F.count_if(F.coalesce(a, F.lit("")) == "").alias("no_a"),
        F.count_if(F.coalesce(b, F.lit("")) == "").alias("no_b"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows), one row for each table."""
    return reduce(DataFrame.unionByName, [d.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows") for n, d in tables.items()])


def same_build(a: DataFrame, b: DataFrame) -> DataFrame:
    """(key, left, right) where two one-row tables of counts differ."""
    cols = [c for c in a.columns if c in b.columns]
    left = a.select(F.explode(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("left")) for c in cols])).alias("x")).select("x.*")
    right = b.select(F.explode(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("right")) for c in cols])).alias("x")).select("x.*")
    return left.join(right, "key").where(~F.col("left").eqNullSafe(F.col("right")))


def drop_reasons(rows: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    """One row: `reason:count` of every reason for which rows are dropped, joined by commas."""
    counted = rows.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in reasons.items()])
    return counted.select(F.concat_ws(",", *[F.concat(F.lit(n + ":"), F.col(n).cast("string")) for n in reasons]).alias("reasons"))
