"""Incremental upserts: micro-batches of rows merged into a versioned store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.upsert import coalesce_newest, overwrite
from ..sources.store import Store

#: Column that deals the rows of a table into buckets; no table has one of this name.
BUCKET = "_bucket"


def upsert_stream(rows: DataFrame, store: Store, table: str, keys: list[str], seq: str, checkpoint: str, policy: str = "overwrite", buckets: int = 64):
    """Start a query that merges each micro-batch; batches that were merged before are not merged again.

    The table is dealt into buckets by its keys. A batch reads and writes the buckets that it has rows for, so that its
    cost follows the batch and not the table. The number of the last batch is kept beside the table and published with
    it in one move of the pointer. The number of buckets of a table cannot be changed by a later stream."""
    merge = {"overwrite": overwrite, "coalesce": coalesce_newest}[policy]
    mark = f"{table}_batch"
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if store.parts(mark):
            last, dealt = store.read(mark).first()
            if dealt != buckets:
                raise ValueError(f"{table} has {dealt} buckets, not {buckets}")
            if last >= number:
                return
        batch = batch.persist()
        changed = sorted(r[0] for r in batch.select(bucket).distinct().collect())
        try:
            old = store.read(table, changed)
        except KeyError:
            old = spark.createDataFrame([], batch.drop(seq).schema)
        merged = merge(old, batch, keys, seq).withColumn(BUCKET, bucket)
        store.publish({mark: spark.createDataFrame([(number, buckets)], "batch long, buckets int")}, buckets={table: (merged, BUCKET, changed)} if changed else None)
        batch.unpersist()

    return rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
