"""Rows of extracted documents: words into lines, lines into building context, context carried forward."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.quality import looks_like_address, noise_line, structure_or_age


def lines(words: DataFrame, keys: list[str], top: str, left: str, text: str, grid: float = 4.0) -> DataFrame:
    """(keys, line, text): words whose tops fall into one grid row, from left to right."""
    line = F.rint(F.col(top) / grid).cast("long")
    w = words.select(*keys, line.alias("line"), F.struct(F.col(left).alias("x"), F.col(text).alias("t")).alias("w"))
    return w.groupBy(*keys, "line").agg(F.array_join(F.transform(F.array_sort(F.collect_list("w")), lambda w: w["t"]), " ").alias("text"))


def carried_forward(rows: DataFrame, keys: list, order: list, *cols: str) -> DataFrame:
    """Missing values taken from the last row before that has one."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def line_kind(text: Column) -> Column:
    return F.when(noise_line(text), "noise").when(structure_or_age(text), "structure").when(looks_like_address(text), "address").otherwise("name")


def context(rows: DataFrame, keys: list[str], order: str, text: str) -> DataFrame:
    """(keys, name, address, structure): what the lines before a table say, the last of each kind."""
    k = rows.withColumn("kind", line_kind(F.col(text)))

    def last(kind: str) -> Column:
        hit = F.col("kind") == kind
        return F.max_by(F.when(hit, F.col(text)), F.when(hit, F.col(order))).alias(kind)

    g = k.groupBy(*keys).agg(*[last(x) for x in ("name", "address", "structure")])
    return g.withColumn("address", F.trim(F.regexp_replace("address", "[/／].*$", "")))


def document_kind(text: Column, signs: dict[str, tuple[str, ...]], least: int = 4) -> Column:
    """The one kind of which a text holds enough signs; none or several are ambiguous."""
    fits = F.filter(F.array(*[F.when(sum([F.contains(text, F.lit(t)).cast("int") for t in ts], F.lit(0)) >= min(least, len(ts)), F.lit(k)) for k, ts in signs.items()]),
        lambda x: x.isNotNull())
    return F.when(F.size(fits) == 1, fits[0]).when(F.size(fits) > 1, "ambiguous").otherwise("other")


def cell_by_header(cells: Column, *patterns: str) -> Column:
    """The value of the first header (array of key, value) that contains a pattern; '' if none does."""
    hit = F.filter(cells, lambda c: c["key"].rlike("|".join(patterns)))
    return F.coalesce(F.get(hit, F.lit(0))["value"], F.lit(""))
