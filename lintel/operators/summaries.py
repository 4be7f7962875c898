"""One summary row per building from its listings, and the picks that summaries are made of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import built_age
from ..functions.text import normalize_text


def first_by(value: Column, order: Column) -> Column:
    """The value of the row with the highest order."""
    return F.max_by(value, order)


def sorted_set(col: Column) -> Column:
    """Distinct values in ascending order, without nulls."""
    return F.array_sort(F.collect_set(col))


def mode_text(col: Column) -> Column:
    """The most frequent non-empty text, of several the smallest."""
    return F.mode(F.nullif(col, F.lit("")), True)


def earliest_date(col: Column) -> Column:
    """The least ISO date among texts; others do not count."""
    return F.date_format(F.min(F.try_to_date(col, "yyyy-MM-dd")), "yyyy-MM-dd")


def mode_or_median(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """The mode of a whole-number column for each key; of several modes the median of all values, truncated.

    Values are counted first, so that what moves is one row for each key and value; the median is read
    off the counts. Keys without any value are missing from the result."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    g = counts.groupBy(*keys).agg(F.max("n").alias("top"), F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("v", "n"))).alias("vs"))
    modes = F.filter("vs", lambda x: x["n"] == F.col("top"))

    def nth(k: Column) -> Column:
        """The k-th smallest value (from 0), by running totals."""
        found = F.aggregate("vs", F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast(df.schema[value].dataType).alias("v")),
                            lambda a, x: F.struct((a["seen"] + x["n"]).alias("seen"),
                                F.when((a["seen"] <= k) & (k < a["seen"] + x["n"]), x["v"]).otherwise(a["v"]).alias("v")))
        return found["v"]

    low, high = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)
    median = ((nth(low).cast("double") + nth(high).cast("double")) / 2).cast("long")
    return g.select(*keys, F.when(F.size(modes) == 1, modes[0]["v"].cast("long")).otherwise(median).alias(out))


def availability_label(immediate: Column, raw: Column, date: Column, move_in: Column, order: Column) -> Column:
    """Aggregate: what to say about when a building is free.

    At once; else the nearest date; else the least move-in text; else the first notice of a planned
    move-out; else the first text that says something; else ''. "First" is by the highest order."""
    text = F.coalesce(raw, F.lit(""))
    return F.coalesce(
        F.when(F.bool_or((F.coalesce(immediate.cast("int"), F.lit(0)) == 1) | F.contains(text, F.lit("即入"))), "入居"),
        earliest_date(date),
        F.min(move_in),
        F.max_by(F.when(F.contains(text, F.lit("退去予定")), text), F.when(F.contains(text, F.lit("退去予定")), order)),
        F.max_by(text, F.when(~text.isin("", "-", "--", "- -", "なし"), order)),
        F.lit(""),
    )


LISTING_COLUMNS = ("id", "building_key", "name", "address", "rent_yen", "area_sqm", "layout", "move_in_date", "updated_at", "age_years", "structure", "availability_raw",
    "structure_raw", "built_year_month", "built_age_years", "availability_date", "availability_flag_immediate")


def prepared_listings(listings: DataFrame) -> DataFrame:
    """Listings with normalised texts: an empty layout or move-in text is null, one of blanks only is ''."""
    texts = {c: normalize_text(F.col(c)) for c in ("structure", "structure_raw", "built_year_month", "availability_raw", "availability_date")}
    sets = {c: F.when(F.coalesce(c, F.lit("")) != "", normalize_text(F.col(c))) for c in ("layout", "move_in_date")}
    return listings.withColumns({**texts, **sets})


def building_summaries(listings: DataFrame, buildings: DataFrame, as_of: Column) -> DataFrame:
    """Listings of the current runs (LISTING_COLUMNS, texts normalised, keys canonical) and buildings -> summaries.

    A full outer join keeps buildings without listings and listings of unknown buildings. Every value
    falls back from listings to the building; labels are blank for buildings for sale or without
    vacancies."""
    rows = listings.where("building_key is not null and building_key <> ''").select(*LISTING_COLUMNS)
    order = F.col("id")
    g = rows.groupBy("building_key").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("rent_yen").alias("rent_min"), F.max("rent_yen").alias("rent_max"), F.min("area_sqm").alias("area_sqm_min"), F.max("area_sqm").alias("area_sqm_max"),
        sorted_set(F.col("layout")).alias("layout_types"), sorted_set(F.col("move_in_date")).alias("move_in_dates"),
        mode_text(F.col("structure")).alias("l_structure"), mode_text(F.col("structure_raw")).alias("l_structure_raw"),
            mode_text(F.col("built_year_month")).alias("l_built"),
        F.max(F.nullif("updated_at", F.lit(""))).alias("last_updated"), first_by(F.struct("name", "address"), order).alias("first"),
        availability_label(F.col("availability_flag_immediate"), F.col("availability_raw"), F.col("availability_date"), F.col("move_in_date"), order).alias("label"),
    )
    for value, out in (("age_years", "l_age"), ("built_age_years", "l_built_age")):
        g = g.join(mode_or_median(rows, ["building_key"], value, out), "building_key", "left")
    b = buildings.withColumnRenamed("building_id", "building_key").withColumn("known", F.lit(True))
    j = g.join(b, "building_key", "full")
    sale = F.coalesce(F.col("property_kind"), F.lit("")) == "bunjo"
    vacancies = F.coalesce("n", F.lit(0)).cast("long")
    b_built = F.coalesce(F.nullif("built_year_month", F.lit("")), F.concat(F.col("built_year").cast("string"), F.lit("-01")))
    age = F.coalesce(built_age(F.col("l_built"), as_of), F.col("l_built_age"), built_age(b_built, as_of).cast("long"), F.col("age_years").cast("long"))
    b_structure = F.nullif("structure", F.lit(""))
    fallback_rent = F.when(~sale, F.col("avg_rent_yen"))
    return j.select(
        "building_key",
        F.when(F.col("known"), F.col("canonical_name")).otherwise(F.col("first.name")).alias("name"),
        F.when(F.col("known"), F.col("canonical_address")).otherwise(F.col("first.address")).alias("address"),
        F.coalesce("property_kind", F.lit("")).alias("property_kind"),
        F.coalesce("rent_min", fallback_rent).alias("rent_yen_min"), F.coalesce("rent_max", fallback_rent).alias("rent_yen_max"),
        "area_sqm_min", "area_sqm_max",
        F.coalesce("layout_types", F.array().cast("array<string>")).alias("layout_types"),
            F.coalesce("move_in_dates", F.array().cast("array<string>")).alias("move_in_dates"),
        F.coalesce(age, F.col("l_age")).alias("age_years"), F.coalesce("l_structure", b_structure).alias("structure"),
        F.coalesce("l_built", b_built).alias("building_built_year_month"), age.alias("building_built_age_years"),
        F.coalesce("l_structure_raw", "l_structure", b_structure).alias("building_structure"),
        F.when(sale | (vacancies <= 0), None).otherwise(F.coalesce(F.nullif("label", F.lit("")), F.nullif("availability_label", F.lit(""))))
            .alias("building_availability_label"),
        vacancies.alias("vacancy_count"), "sale_price_yen_min", "sale_price_yen_max", "sale_price_yen_avg", "sale_listing_count", "last_updated",
    )
