"""URL rules by a sort-merge range join, with Spark expressions only.

The canonical key of a URL is its reversed host and its path. A rule fits the host and its subdomains, so
a URL has a key for each suffix of its host, and a rule those keys that begin with its own: the interval
[key, key + 0xFF). Intervals of different hosts are apart, those of one host nest by path. Starts and ends
of rules and URL keys are sorted together by host, and a sweep keeps a stack of the active nested rules:
a start pushes its rule, an end pops it, and a URL gets the rule on top. In terms of windows, starts less
ends so far are the height of the stack, and its slot of a height holds the rule last pushed there.

Hosts that no rule names are left out before the sort. A host with very many URLs (such as a top-level
domain) is dealt into salted sweeps, which have its rules each; rules of other hosts are not copied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: URL keys of a host in one sweep, about, or as many as the host has rules: rules are copied no more than there are URLs.
SWEEP_ROWS = 1 << 12
#: Copies of a row that one array holds.
COPIES = 4096


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; '' for null or without ://."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def suffixes(host: Column) -> Column:
    """The reversed suffixes of a host: com, com,example, com,example,www."""
    labels = F.reverse(F.split(host, r"\."))
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, 1, n), ","))


def _rules(rules: DataFrame) -> DataFrame:
    """(suffix, path, rule, verdict): rules with the reversed host; of equal ones that with verdict block wins."""
    named = rules.select(F.lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").where("host is not null and verdict is not null")
    one = named.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    return one.select(F.element_at(suffixes(F.col("host")), -1).alias("suffix"), "path", F.concat("host", "path").alias("rule"), "verdict")


def judge_urls(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Each row's host, path, the longest rule that fits (null if none) and the verdict (else `default`).

    Of fitting rules of equal length that of the longer host wins. Repeated rows stay repeated, null urls
    have empty host and path, null ids are kept, an empty rule table judges all rows by the default,
    further columns are ignored. Rules may be any number; they are neither collected nor broadcast by
    order, and are sorted with the URLs."""
    r = _rules(rules)
    rows = urls.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    keys = rows.select("*", F.explode(suffixes(F.col("host"))).alias("suffix"))
    asked = keys.groupBy("suffix").agg(F.count(F.lit(1)).alias("n"))
    named = r.groupBy("suffix").agg(F.count(F.lit(1)).alias("rules"))
    sweeps = asked.join(named, "suffix").select("suffix", F.ceil(F.col("n") / F.greatest(F.lit(SWEEP_ROWS), F.col("rules"))).cast("int").alias("sweeps"))

    # kind 0 pushes, 1 looks, 2 pops
    looks = keys.join(sweeps, "suffix").select(
        "suffix", F.pmod(F.xxhash64("id", "host", "path", F.spark_partition_id()), F.col("sweeps")).cast("int").alias("salt"), F.encode("path", "UTF-8").alias("at"),
        F.lit(1).alias("kind"), F.lit(0).alias("step"), F.lit(None).cast("struct<rule:string,verdict:string>").alias("active"),
        F.struct("id", "host", "path").alias("row"),
    )
    begin, end = F.encode("path", "UTF-8"), F.concat(F.encode("path", "UTF-8"), F.unhex(F.lit("FF")))
    edges = F.array(
        F.struct(begin.alias("at"), F.lit(0).alias("kind"), F.lit(1).alias("step"), F.struct("rule", "verdict").alias("active")),
        F.struct(end.alias("at"), F.lit(2).alias("kind"), F.lit(-1).alias("step"), F.lit(None).cast("struct<rule:string,verdict:string>").alias("active")),
    )
    pushed = r.join(sweeps, "suffix").select("suffix", "sweeps", F.explode(edges).alias("e"))
    marks = pushed.select("suffix", F.explode(F.sequence(F.lit(0), F.col("sweeps") - 1)).alias("salt"), "e.*")
    running = (Window.unboundedPreceding, Window.currentRow)
    sweep = Window.partitionBy("suffix", "salt").orderBy("at", "kind").rowsBetween(*running)
    slot = Window.partitionBy("suffix", "salt", "height").orderBy("at", "kind").rowsBetween(*running)
    events = looks.unionByName(marks, allowMissingColumns=True).repartition("suffix", "salt")  # else a shuffle by suffix would do
    swept = events.withColumn("height", F.sum("step").over(sweep)).where("kind < 2 and height > 0")
    top = swept.withColumn("top", F.last("active", ignorenulls=True).over(slot)).where("kind = 1").select("row.*", "top", "suffix", F.lit(0).alias("n"))

    every = rows.select("*", F.lit(None).cast("struct<rule:string,verdict:string>").alias("top"), F.lit(None).cast("string").alias("suffix"), F.lit(1).alias("n"))
    rank = F.when(F.col("top").isNotNull(), F.struct(F.length("top.rule"), F.length("suffix")))
    best = every.unionByName(top).groupBy("id", "host", "path").agg(F.max_by("top", rank).alias("best"), F.sum("n").alias("n"))
    parts = best.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES))).alias("part"))
    copies = F.array_repeat(F.lit(0), F.least(F.lit(COPIES), F.col("n") - F.col("part") * COPIES).cast("int"))
    return parts.select("id", "host", "path", "best", F.explode(copies)).select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
