"""The served read model: union of summaries and buildings, payloads, search, sort orders, pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scores
from ..functions import text as tx
from ..functions.fields import built_age, maps_url, positive_or_null, summary_date

PAGE_ROWS, SEARCH_ROWS = 16, 200
SORTS = ("recommended", "updated_desc", "built_age_asc", "vacancy_desc", "rent_min_asc", "rent_min_desc")


def read_model(summaries: DataFrame, buildings: DataFrame) -> DataFrame:
    """Summaries with their building's values where they lack their own, and buildings without a summary.

    Buildings marked hidden are left out; a summary without a building stays. Newest first, unknown last."""
    cols = {"name": "canonical_name", "address": "canonical_address"}
    b = buildings.select(F.col("building_id").alias("building_key"), *[F.col(v).alias(f"b_{k}") for k, v in cols.items()], F.col("updated_at").alias("b_updated_at"),
        "hidden_from_public")
    shown = F.coalesce("hidden_from_public", F.lit(0)) == 0
    s = summaries.join(b, "building_key", "left").where(shown)
    s = s.select("building_key", *[F.coalesce(f"b_{k}", k).alias(k) for k in cols], F.coalesce("last_updated", "b_updated_at").alias("updated_at"),
        *[c for c in summaries.columns if c not in {"building_key", "name", "address", "last_updated"}])
    rest = b.where(shown).join(summaries.select("building_key"), "building_key", "left_anti").select("building_key", *[F.col(f"b_{k}").alias(k) for k in cols],
        F.col("b_updated_at").alias("updated_at"))
    return s.unionByName(rest, allowMissingColumns=True)


def newest_first(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("updated_at").desc_nulls_last(), F.col("building_key").asc_nulls_last())


def guarded_age(df: DataFrame, as_of: Column) -> DataFrame:
    """The built age worked out anew from the built month, else as stored."""
    return df.withColumn("building_built_age_years", F.coalesce(built_age(F.col("building_built_year_month"), as_of).cast("long"), F.col("building_built_age_years")
        .cast("long")))


def sanitized(df: DataFrame) -> DataFrame:
    """Room numbers out of every text and array of texts."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: tx.without_room(F.col(c)) if k == "string" else F.transform(c, tx.without_room) for c, k in kinds.items() if k
        in ("string", "array<string>")})


def scalar_or_null(col: Column) -> Column:
    """Trimmed text, null if nothing is left."""
    return F.nullif(tx.strip(col), F.lit(""))


def list_or_empty(col: Column) -> Column:
    """A JSON array of texts; anything else is empty."""
    return F.coalesce(F.from_json(col, "array<string>"), F.array().cast("array<string>"))


def epoch(col: Column) -> Column:
    """Seconds of a date text; the session's zone should be UTC."""
    return F.unix_timestamp(summary_date(col))


def payload(df: DataFrame, keys: list[str]) -> DataFrame:
    """(id, json): one compact object per row, keys in order, '' as null, nulls written; ordered by id.

    A sink writes the rows between [ and ]; nothing is gathered in one place."""
    kinds = dict(df.dtypes)
    fields = [(scalar_or_null(F.col(k)) if kinds[k] == "string" else F.col(k)).alias(k) for k in keys]
    return df.select(F.col(keys[0]).cast("string").alias("id"), F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("json")).orderBy(F.coalesce("id",
        F.lit("")))


# The keys of the published objects in order, with the columns that they are taken from.
V2MIN_KEYS = (
    ("id", "building_key"), ("name", "name"), ("address", "address"), ("vacancy_count", "vacancy_count"), ("rent_min", "rent_yen_min"), ("rent_max", "rent_yen_max"),
    ("sale_price_min", "sale_price_yen_min"), ("sale_price_max", "sale_price_yen_max"), ("sale_price_avg", "sale_price_yen_avg"), ("area_min", "area_sqm_min"),
        ("area_max", "area_sqm_max"),
    ("sale_area_min", "sale_area_sqm_min"), ("sale_area_max", "sale_area_sqm_max"), ("updated_at", "last_updated"), ("updated_epoch", "updated_epoch"),
        ("property_kind", "property_kind"),
    ("sale_listing_count", "sale_listing_count"), ("building_structure", "building_structure"), ("building_availability_label", "building_availability_label"),
    ("building_built_year_month", "building_built_year_month"), ("building_built_age_years", "derived_built_age_years"),
)
LEGACY_KEYS = (
    *V2MIN_KEYS[:15], ("google_maps_url", "address"), ("room_types", "layout_types"), ("sale_layout_types", "sale_layout_types_json"), ("property_kind", "property_kind"),
    ("sale_listing_count", "sale_listing_count"), ("structure", "structure"), ("built_year", "age_years"), ("building_structure", "building_structure"),
    ("building_built_year_month", "building_built_year_month"), ("building_built_age_years", "derived_built_age_years"),
        ("building_availability_label", "building_availability_label"),
)
#: Where the first column of a key is empty the second one is taken.
FALLBACKS = {"updated_at": "updated_at", "building_structure": "structure", "building_built_age_years": "age_years"}


def contract_payload(df: DataFrame, form: str) -> DataFrame:
    """(id, json) of the read model in one of the published forms, `legacy` (26 keys) or `v2min` (21 keys).

    Columns that the read model lacks are null; lists that are missing are empty; blank texts are null."""
    keys = {"legacy": LEGACY_KEYS, "v2min": V2MIN_KEYS}.get(form)
    if keys is None:
        raise ValueError(f"unsupported format: {form}")
    kinds = dict(df.dtypes)

    def column(name: str) -> Column:
        if name not in kinds:
            return F.lit(None).cast("string")
        return scalar_or_null(F.col(name)) if kinds[name] == "string" else F.col(name)

    def value(key: str, source: str) -> Column:
        if key == "google_maps_url":
            return maps_url(column(source))
        if key == "room_types":
            return F.coalesce(F.col(source), F.array().cast("array<string>")) if source in kinds else F.array().cast("array<string>")
        if key == "sale_layout_types":
            return list_or_empty(column(source))
        other = FALLBACKS.get(key)
        both = [c for c in (source, other) if c in kinds]
        return F.coalesce(*map(column, both)) if both else column(source)

    made = df.select(*[value(k, c).alias(k) for k, c in keys])
    return payload(made, [k for k, _ in keys])


def lookup(keys: DataFrame, buildings: DataFrame, summaries: DataFrame, key: str = "key") -> DataFrame:
    """(key, source, ...): for each key the building whose numeric id it is, else the summary of that key; others fall out.

    The columns are those of `buildings` and `summaries` as structs, one of which is null."""
    numeric = F.when(F.col(key).rlike("^[0-9]+$"), F.col(key).try_cast("long"))
    asked = keys.select(key, numeric.alias("_id")).distinct()
    b = buildings.select(F.col("id").alias("_id"), F.struct(*buildings.columns).alias("building"))
    s = summaries.select(F.col("building_key").alias(key), F.struct(*summaries.columns).alias("summary"))
    found = asked.join(b, "_id", "left").join(s, key, "left").where("building is not null or summary is not null")
    source = F.when(F.col("building").isNotNull(), "building").otherwise("summary")
    return found.select(key, source.alias("source"), "building", F.when(F.col("building").isNull(), F.col("summary")).alias("summary"))


def seeded(summaries: DataFrame, demo: DataFrame) -> DataFrame:
    """The summaries, or the demo rows where there are none."""
    return summaries if summaries.head(1) else demo.select(*summaries.columns)


def searched(df: DataFrame, query: str, name: str = "name", address: str = "address") -> DataFrame:
    """Rows that match a query, with their score; the score filters and does not order."""
    q = F.lit(" ".join(query.lower().split()))
    return df.withColumn("score", scores.relevance(F.lower(tx.spaced(F.col(name))), F.lower(tx.spaced(F.col(address))), q)).where("score > 0")


def order_by(sort: str, as_of_ym: int) -> list[Column]:
    """Keys of a user's sort; unknown values last, ties by original index."""
    if sort == "recommended":
        keys = [F.col("recommended_score").desc_nulls_last()]
    elif sort == "updated_desc":
        keys = [positive_or_null(F.col("updated_epoch")).desc_nulls_last()]
    elif sort == "built_age_asc":
        keys = scores.built_age_order(F.col("built_year_month"), F.col("built_age"), F.col("property_kind"), F.lit(as_of_ym))
    elif sort == "vacancy_desc":
        keys = [positive_or_null(F.col("vacancy_count")).desc_nulls_last()]
    elif sort in ("rent_min_asc", "rent_min_desc"):
        rent = F.when(F.coalesce("property_kind", F.lit("")) != "bunjo", positive_or_null(F.col("rent_min")))
        keys = [rent.asc_nulls_last() if sort.endswith("asc") else rent.desc_nulls_last()]
    else:
        raise ValueError(f"unknown sort: {sort}")
    return [*keys, F.col("original_index").asc()]


def sentinel_order(sort: str) -> list[Column]:
    """The older page's orders, with fixed values for unknown ones; ties by name in Japanese order, then index."""
    rent = F.when(F.col("rent_min") > 0, F.col("rent_min"))
    keys = {"rent_min_asc": F.coalesce(rent, F.lit(999_999_999)).asc(), "rent_min_desc": F.coalesce(rent, F.lit(-1)).desc(),
        "vacancy_desc": F.coalesce("vacancy_count", F.lit(-1)).desc(), "updated_desc": F.coalesce("updated_epoch", F.lit(-1)).desc()}
    return [keys[sort], F.collate("name", "ja").asc(), F.col("original_index").asc()]


def page(df: DataFrame, sort: list[Column], pages: int = 1, searching: bool = False) -> DataFrame:
    """The first rows of a sort, as many as are shown; a plan of top rows, not a full sort."""
    return df.orderBy(*sort).limit(min(PAGE_ROWS * pages, SEARCH_ROWS) if searching else PAGE_ROWS * pages)


def rest_page(df: DataFrame, limit: int = 50, offset: int = 0, by: str = "updated_at") -> DataFrame:
    if not 1 <= limit <= 100 or offset < 0:
        raise ValueError("limit must be 1 to 100, offset 0 or more")
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(df.columns[0]).asc()).offset(offset).limit(limit)


def rest_filter(df: DataFrame, q: str | None = None, box: tuple | None = None, name: str = "name", address: str = "address", lat: str = "lat",
        lng: str = "lng") -> DataFrame:
    """Substring in name or address without case; within (min lat, max lat, min lng, max lng), each optional."""
    if q:
        like = "%" + q + "%"
        df = df.where(F.col(name).ilike(like) | F.col(address).ilike(like))
    for col, low, high in ((lat, *(box or (None,) * 4)[:2]), (lng, *(box or (None,) * 4)[2:])):
        if low is not None:
            df = df.where(F.col(col) >= low)
        if high is not None:
            df = df.where(F.col(col) <= high)
    return df


def valid_places(df: DataFrame, lat: str = "lat", lng: str = "lng") -> tuple[DataFrame, DataFrame]:
    """Rows with possible coordinates, and the others."""
    ok = F.coalesce(F.col(lat).between(-90, 90) & F.col(lng).between(-180, 180), F.lit(False))
    return df.where(ok), df.where(~ok)


def kpis(df: DataFrame) -> DataFrame:
    """One row: buildings, vacancies, latest update."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.sum("vacancy_count"), F.lit(0)).alias("vacant"), F.max("updated_at").alias("latest"))


def shown_counts(df: DataFrame, sort: list[Column], n: int) -> DataFrame:
    """Buildings and vacancies among the first n rows of a sort."""
    return df.orderBy(*sort).limit(n).agg(F.count(F.lit(1)).alias("shown"), F.coalesce(F.sum(F.greatest("vacancy_count", F.lit(0))), F.lit(0)).alias("shown_vacant"))


def display_label(label: Column, kind: Column) -> Column:
    """What the page says about availability; nothing for buildings for sale."""
    return F.when(kind == "bunjo", None).when(label.isin("入居", "即入居"), "即入居").otherwise(F.nullif(label, F.lit("")))


def leaks(df: DataFrame, *cols: str) -> DataFrame:
    """Rows that may not be published."""
    bad = F.lit(False)
    for c in cols:
        bad = bad | F.coalesce(tx.forbidden_content(F.col(c)), F.lit(False))
    return df.where(bad)
