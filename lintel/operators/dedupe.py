"""Groups of duplicate buildings: connected components, safe merges, and their application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shared_folder(spark) -> None:
    """checkpoint() writes to spark.checkpoint.dir; only without that setting a local folder is used."""
    sc = spark.sparkContext
    if not (sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()):
        import tempfile

        sc.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='lintel-')}")


def components(nodes: DataFrame, node: str, keys: list[Column]) -> DataFrame:
    """(node, component): nodes that share any non-null key, transitively; the component is its least node.

    Labels spread through keys: each key takes the least label of its nodes, each node the least of its
    keys, and labels are shortened by one jump (the label of the label), so that long chains need a
    logarithmic number of rounds in practice. A round aggregates before it joins, and is checkpointed;
    so are the least labels of keys, which lets Spark split the join of a key with very many nodes."""
    shared_folder(nodes.sparkSession)
    pairs = nodes.select(F.col(node).alias("node"),
        F.explode(F.filter(F.array(*[F.when(k.isNotNull(), F.concat(F.lit(f"{i}:"), k.cast("string"))) for i, k in enumerate(keys)]), lambda x: x.isNotNull()))
        .alias("key")).distinct()
    often = pairs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = pairs.join(often.select("key"), "key").checkpoint()
    labels = pairs.select("node", F.col("node").alias("label")).distinct()
    while True:
        by_key = pairs.join(labels, "node").groupBy("key").agg(F.min("label").alias("label")).checkpoint()
        spread = pairs.join(by_key, "key").groupBy("node").agg(F.min("label").alias("label"))
        jump = spread.select(F.col("node").alias("label"), F.col("label").alias("to"))
        new = spread.join(jump, "label", "left").select("node", F.least(F.col("label"), F.coalesce("to", "label")).alias("label")).checkpoint()
        if not new.join(labels, ["node", "label"], "left_anti").head(1):
            break
        labels = new
    return nodes.select(F.col(node).alias("node")).distinct().join(new, "node", "left").select("node", F.coalesce("label", "node").alias("component"))


def merge_plan(buildings: DataFrame, listing_counts: DataFrame) -> DataFrame:
    """One row per group of duplicates: keep, drop, decision and why.

    Buildings are duplicates by (norm name, norm address) or by canonical address. Only pairs can be
    merged: into the one that has listings, or, if none has and they are the same up to case and blanks,
    into the older one. All else is ambiguous."""
    pair = F.when((F.col("norm_name") != "") & (F.col("norm_address") != ""), F.concat_ws("|", "norm_name", "norm_address"))
    place = F.nullif("canonical_address", F.lit(""))
    comp = components(buildings, "building_id", [pair, place]).withColumnRenamed("node", "building_id")
    folded = F.lower(F.regexp_replace("canonical_name", r"(?U)\s+", ""))
    rows = buildings.join(comp, "building_id").join(listing_counts, "building_id", "left").select(
        "component", F.struct(F.col("building_id").alias("id"), F.coalesce("n_listings", F.lit(0)).alias("n"), F.coalesce("canonical_address", F.lit("")).alias("place"),
            folded.alias("name"), F.col("created_at").alias("at")).alias("b")
    )
    # the least and the greatest member are both members of a pair; of larger groups none is merged
    g = rows.groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.min("b").alias("a"), F.max("b").alias("b")).where("size > 1")
    a, b = F.col("a"), F.col("b")
    a_old = (a["at"] < b["at"]) | (a["at"].eqNullSafe(b["at"]) & (a["id"] < b["id"])) | (a["at"].isNotNull() & b["at"].isNull())
    same = (a["place"] == b["place"]) & (a["name"] == b["name"])
    keep = F.when((a["n"] > 0) & (b["n"] == 0), a["id"]).when((b["n"] > 0) & (a["n"] == 0), b["id"]).when((a["n"] == 0) & (b["n"] == 0) & same,
        F.when(a_old, a["id"]).otherwise(b["id"]))
    why = F.when(F.col("size") != 2, "size").when((a["n"] > 0) & (b["n"] > 0), "both_listed").when((a["n"] == 0) & (b["n"] == 0) & ~same,
        "different").when((a["n"] == 0) & (b["n"] == 0), "same_unlisted").otherwise("one_listed")
    g = g.withColumn("keep", F.when(F.col("size") == 2, keep)).withColumn("why", why)
    return g.select("component", "size", "keep", F.when(F.col("keep").isNotNull(), F.when(F.col("keep") == a["id"], b["id"]).otherwise(a["id"])).alias("drop"),
        F.when(F.col("keep").isNull(), "ambiguous").otherwise("merge").alias("decision"), "why")


def apply_merges(plan: DataFrame, buildings: DataFrame, listings: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, bool]:
    """Buildings, listings and aliases after the merges, and whether they were applied: one ambiguous group stops all."""
    if plan.where("decision = 'ambiguous'").head(1):
        return buildings, listings, aliases, False
    moves = plan.where("decision = 'merge'").select(F.col("drop").alias("old"), F.col("keep").alias("new"))
    left = buildings.join(moves.select(F.col("old").alias("building_id")), "building_id", "left_anti")
    moved = listings.join(moves.withColumnRenamed("old", "building_key"), "building_key", "left").withColumn("building_key",
        F.coalesce("new", "building_key")).select(*listings.columns)
    named = moves.select(F.col("old").alias("alias_key"), F.col("new").alias("canonical_key"))
    kept = aliases.select("alias_key", "canonical_key").join(named.select("alias_key"), "alias_key", "left_anti")
    return left, moved, kept.unionByName(named), True
