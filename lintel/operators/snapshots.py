"""Runs of a source, and the pointer that says which of them is current."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_current_runs(rows: DataFrame, current: DataFrame, run: str = "ingest_run_id") -> DataFrame:
    """Rows of a current run; where no pointer exists at all, the rows without a run.

    The pointer table has a row for each source, so one look at it decides the form of the plan."""
    if current.head(1):
        runs = current.select(F.col("ingest_run_id").alias(run)).distinct()
        return rows.join(runs, run, "left_semi")
    return rows.where(F.col(run).isNull())


def switched(current: DataFrame, runs: DataFrame, source: str, run_id) -> DataFrame:
    """The pointer table after a switch; only a completed run may become current."""
    status = runs.where((F.col("id") == run_id) & (F.col("source") == source)).select("status").head()
    if status is None or status[0] != "completed":
        raise ValueError(f"run is not completed: {run_id}")
    moved = current.sparkSession.createDataFrame([(source, run_id)], current.select("source", "ingest_run_id").schema)
    return current.select("source", "ingest_run_id").where(F.col("source") != source).unionByName(moved)


def started(runs: DataFrame, source: str, snapshot: str) -> tuple[DataFrame, int]:
    """The run table with a running run of (source, snapshot), and its id: the old one if it ran before."""
    old = runs.where((F.col("source") == source) & (F.col("snapshot_key") == snapshot)).select("id").head()
    run_id = old[0] if old else (runs.agg(F.max("id")).first()[0] or 0) + 1
    row = runs.sparkSession.createDataFrame([(run_id, source, snapshot, "running")], runs.select("id", "source", "snapshot_key", "status").schema)
    return runs.select("id", "source", "snapshot_key", "status").where(F.col("id") != run_id).unionByName(row), run_id


def finished(runs: DataFrame, run_id: int, status: str = "completed") -> DataFrame:
    return runs.withColumn("status", F.when(F.col("id") == run_id, status).otherwise(F.col("status")))


def resolved(rows: DataFrame, aliases: DataFrame, key: str = "building_key", legacy: str | None = None) -> DataFrame:
    """Keys replaced by their canonical ones, one hop only; a legacy key is looked up where the key is unknown."""
    names = aliases.groupBy("alias_key").agg(F.min("canonical_key").alias("canonical_key"))

    def hop(df: DataFrame, col: str, out: str) -> DataFrame:
        return df.join(names.withColumnsRenamed({"alias_key": col, "canonical_key": out}), col, "left")

    out = hop(rows, key, "c1")
    if legacy:
        out = hop(out, legacy, "c2").withColumn("c1", F.coalesce("c1", "c2")).drop("c2")
    return out.withColumn(key, F.coalesce("c1", key)).drop("c1").select(*rows.columns)


def listed_counts(listings: DataFrame, buildings: DataFrame) -> DataFrame:
    """One row: all buildings, all listings, and the buildings that have a listing."""
    keys = listings.where("coalesce(building_key, '') <> ''").join(buildings.select(F.col("building_id").alias("building_key")), "building_key", "left_semi")
    counts = [buildings.agg(F.count(F.lit(1)).alias("buildings")), listings.agg(F.count(F.lit(1)).alias("listings")),
        keys.agg(F.count_distinct("building_key").alias("with_listings"))]
    return counts[0].join(counts[1]).join(counts[2])  # three single rows


def orphans(listings: DataFrame, buildings: DataFrame) -> DataFrame:
    """Listings of unknown buildings."""
    return listings.join(buildings.select(F.col("building_id").alias("building_key")), "building_key", "left_anti")
