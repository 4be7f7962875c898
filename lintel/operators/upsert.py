"""Merging rows into a store without MERGE: frames in, a new frame out.

`seq` orders the incoming rows. Empty text and null are both missing; for numbers only null is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(df: DataFrame, col: str) -> Column:
    """The value, null if it is missing."""
    return F.nullif(F.col(col), F.lit("")) if isinstance(df.schema[col].dataType, T.StringType) else F.col(col)


def keep_top(df: DataFrame, keys: list, n: int, *order) -> DataFrame:
    """The first n rows of each key; null keys are equal. Spark keeps n rows a key before it shuffles."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_r") <= n).drop("_r")


def keep_first(df: DataFrame, keys: list, *order) -> DataFrame:
    return keep_top(df, keys, 1, *order)


def keep_last(df: DataFrame, keys: list, *order: str) -> DataFrame:
    return keep_first(df, keys, *[F.col(o).desc() for o in order])


def overwrite(existing: DataFrame, incoming: DataFrame, keys: list[str], seq: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Incoming rows replace stored ones of the same key, the last of a key counts; columns in `keep` stay as stored."""
    new = keep_last(incoming, keys, seq).drop(seq)
    if keep:
        old = existing.select(*keys, F.lit(True).alias("_old"), *[F.col(c).alias(f"_{c}") for c in keep])
        new = new.join(old, keys, "left").withColumns({c: F.when(F.col("_old"), F.col(f"_{c}")).otherwise(F.col(c)) for c in keep}).drop("_old", *[f"_{c}" for c in keep])
    return existing.join(new.select(*keys), keys, "left_anti").unionByName(new.select(*existing.columns))


def coalesce_newest(existing: DataFrame, incoming: DataFrame, keys: list[str], seq: str, stamp: str | None = None) -> DataFrame:
    """For each column the last value that is not missing; the stamp column takes its greatest text.

    One aggregation over stored and incoming rows; stored ones come before all others."""
    rows = existing.withColumn(seq, F.lit(-1).cast(incoming.schema[seq].dataType)).unionByName(incoming.select(*existing.columns, seq))
    aggs = []
    for c in existing.columns:
        if c not in keys:
            v = present(existing, c)
            aggs.append((F.max(v) if c == stamp else F.max_by(v, F.when(v.isNotNull(), F.col(seq)))).alias(c))
    return rows.groupBy(*keys).agg(*aggs).select(*existing.columns)


def _merged(existing: DataFrame, incoming: DataFrame, keys: list[str], pick) -> DataFrame:
    cols = [c for c in incoming.columns if c not in keys and c in existing.columns]
    new = incoming.select(*keys, *[F.col(c).alias(f"_{c}") for c in cols], F.lit(True).alias("_hit"))
    j = existing.join(new, keys, "left")
    return j.withColumns({c: pick(j, c) for c in cols}).select(*existing.columns)


def _value(df: DataFrame, c: str) -> Column:
    return present(df, c)


def fill_only(existing: DataFrame, incoming: DataFrame, keys: list[str], derived: str | None = None) -> DataFrame:
    """Only what the store lacks is taken; the derived column, where given, always wins."""
    return _merged(existing, incoming, keys, lambda j, c: F.coalesce(F.col(f"_{c}"), F.col(c)) if c == derived else F.coalesce(_value(j, c), F.col(f"_{c}"), F.col(c)))


def overwrite_present(existing: DataFrame, incoming: DataFrame, keys: list[str], protected: tuple[str, ...] = ()) -> DataFrame:
    """What the incoming row has replaces the stored value; protected columns are only filled."""
    def pick(j: DataFrame, c: str) -> Column:
        new = _value(j, f"_{c}")
        return F.coalesce(_value(j, c), F.col(f"_{c}"), F.col(c)) if c in protected else F.coalesce(new, F.col(c))

    return _merged(existing, incoming, keys, pick)


def facts_policy(source: Column, kind: Column, overwrite: bool) -> dict[str, Column]:
    """May a fact row overwrite, and may it set more than structure, age, built month and kind?"""
    review = F.startswith(source, F.lit("mansion_review"))
    return {"may_overwrite": F.lit(overwrite) & ~review, "may_set_all": ~review | (kind == "bunjo")}


def apply_facts(existing: DataFrame, facts: DataFrame, key: str, overwrite: bool,
        always: tuple[str, ...] = ("structure", "age_years", "built_year_month", "property_kind")) -> DataFrame:
    """Facts (key, source, property_kind, values) into buildings by the policy of their source."""
    p = facts_policy(F.col("source"), F.col("property_kind"), overwrite)
    cols = [c for c in facts.columns if c in existing.columns and c != key]
    f = facts.withColumns(p)
    f = f.withColumns({c: F.when(F.col("may_set_all"), F.col(c)) for c in cols if c not in always})
    new = f.select(key, "may_overwrite", *[F.col(c).alias(f"_{c}") for c in cols])
    j = existing.join(new, key, "left")
    return j.withColumns({c: F.when(F.col("may_overwrite"), F.coalesce(_value(j, f"_{c}"), F.col(c))).otherwise(F.coalesce(_value(j, c), F.col(f"_{c}"), F.col(c))) for c
        in cols}).select(*existing.columns)
