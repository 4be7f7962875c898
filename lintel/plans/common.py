"""Input tables of the queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators.dedupe import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share."""
    shared_folder(spark)
    sc = spark.sparkContext
    return f"{(sc.getConf().get('spark.checkpoint.dir') or sc.getCheckpointDir()).rstrip('/')}/lintel/{what}-{uuid.uuid4().hex}"
