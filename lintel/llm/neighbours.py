"""Approximate nearest neighbours by cross-polytope hashing.

Unit vectors go through three rounds of random signs and a fast Hadamard transform; the hash is the
signed axis that is then nearest. Each of `tables` tables concatenates `hashes` of them. Queries
probe the buckets of the nearest axes in each table, and candidates are ranked by the exact distance
inside their bucket, in blocks. Equal vectors are one candidate that carries its smallest ids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Every table holds a copy of each vector, so few tables with more probes move less.
TABLES = 4
#: Rows of a bucket that one task ranks at a time, and queries likewise; larger buckets are split.
BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024
#: The number of probes is chosen on at most so many vectors to reach this recall; every row is indexed.
SAMPLE, SAMPLE_QUERIES, TARGET, MAX_PROBES = 8192, 128, 0.97, 2048


#: Relative error that the quick distance of a block may have.
SLACK = 1e-12


@dataclass(frozen=True)
class Index:
    hashes: int
    probes: int
    #: Vectors of unequal norms get one more component that lifts them to a sphere of this radius.
    radius: float | None
    tables: int = TABLES
    seed: int = 20

    def rotated(self, x: np.ndarray, table: int, h: int) -> np.ndarray:
        """Pseudo-rotated unit vectors, padded to a power of two."""
        if self.radius is not None:
            rest = np.sqrt(np.maximum(self.radius**2 - (x * x).sum(1, keepdims=True), 0))
            x = np.concatenate([x, rest], 1)
        d = 1 << max(1, math.ceil(math.log2(x.shape[1])))
        y = np.zeros((len(x), d))
        y[:, : x.shape[1]] = x / np.linalg.norm(x, axis=1, keepdims=True)
        signs = np.random.default_rng((self.seed, table, h, d))
        for _ in range(3):
            y *= signs.choice([-1.0, 1.0], d)
            step = 1
            while step < d:
                y = y.reshape(len(x), -1, 2, step)
                y = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2)
                step *= 2
            y = y.reshape(len(x), d) / math.sqrt(d)
        return y

    def codes(self, x: np.ndarray, table: int) -> np.ndarray:
        code = np.zeros(len(x), np.int64)
        for h in range(self.hashes):
            y = self.rotated(x, table, h)
            axis = np.abs(y).argmax(1)
            code = code * (2 * y.shape[1]) + 2 * axis + (y[np.arange(len(x)), axis] < 0)
        return code

    def probe_codes(self, x: np.ndarray, table: int) -> np.ndarray:
        """The `probes` buckets of each query, the likeliest first."""
        code, loss = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
        for h in range(self.hashes):
            y = self.rotated(x, table, h)
            signed = np.stack([y, -y], 2).reshape(len(x), -1)
            order = np.argsort(-signed, 1, kind="stable")[:, : self.probes]
            value = np.take_along_axis(signed, order, 1)
            cost = value[:, :1] - value
            code = (code[:, :, None] * signed.shape[1] + order[:, None, :]).reshape(len(x), -1)
            loss = (loss[:, :, None] + cost[:, None, :] ** 2).reshape(len(x), -1)
            best = np.argsort(loss, 1, kind="stable")[:, : self.probes]
            code, loss = np.take_along_axis(code, best, 1), np.take_along_axis(loss, best, 1)
        return code


def fit(x: np.ndarray, n: int, k: int) -> Index:
    """Hashes by the number of rows (buckets keep their size), probes by recall on a sample.

    A sample is sparser than all rows, its neighbours are farther, and so its recall is the lower."""
    norms = np.linalg.norm(x, axis=1)
    radius = float(norms.max()) if norms.max() - norms.min() > 1e-3 * norms.max() else None
    d = 1 << max(1, math.ceil(math.log2(x.shape[1] + (radius is not None))))
    for hashes in range(max(1, int(math.log(max(n / BLOCK_ROWS, 1)) / math.log(2 * d))), 0, -1):
        q = np.arange(0, len(x), max(1, len(x) // SAMPLE_QUERIES))
        gap = (x * x).sum(1)[None] - 2 * x[q] @ x.T
        gap[np.arange(len(q)), q] = np.inf
        near = np.argsort(gap, 1)[:, : min(k, len(x) - 1)]
        top = 2 * d if hashes == 1 else min((2 * d) ** hashes, MAX_PROBES)
        index = Index(hashes, top, radius)
        first = np.full(near.shape, top)  # the first probe that finds a neighbour, over all tables
        for t in range(index.tables):
            code, probes = index.codes(x, t), index.probe_codes(x[q], t)
            for i in range(len(q)):
                at = {c: r for r, c in enumerate(probes[i].tolist())}
                first[i] = np.minimum(first[i], [at.get(c, top) for c in code[near[i]].tolist()])
        need = int(np.quantile(first, TARGET, method="higher")) + 1 if first.size else 1
        if need <= top or hashes == 1:
            return Index(hashes, min(need, top), radius)
    raise AssertionError


def _matrix(column: pa.ChunkedArray, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width).astype(np.float64)


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row of `queries`, by Euclidean distance.

    Rows with a null id, and vectors that are null, empty, zero or hold null or non-finite components,
    take no part; vectors of other lengths are never compared. Ties go to the smaller id. A row is no
    neighbour of its own id; repeated rows count once. Empty tables give no rows."""
    good = f"{id_col} is not null and size({vector_col}) > 0 and forall({vector_col}, x -> x is not null and abs(x) < double('infinity') and not isnan(x)) and exists({vector_col}, x -> x <> 0)"
    single = dict(vectors.dtypes)[vector_col] == dict(queries.dtypes)[vector_col] == "array<float>"
    v, kind = (F.col(vector_col), "<f4") if single else (F.col(vector_col).cast("array<double>"), "<f8")
    rows = vectors.where(good).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    asked = queries.where(good).select(F.col(id_col).cast("long").alias("query_id"), v.alias("v"))
    spark = vectors.sparkSession
    by_vector = Window.partitionBy("v").orderBy("vec_id")
    # k + 1 smallest ids of each vector are enough, one may be the query itself
    points = rows.distinct().withColumn("r", F.row_number().over(by_vector)).where(F.col("r") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_list("vec_id"))
        .alias("ids"))
    points = written(points, "points")
    kinds = points.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not kinds:
        return empty
    width, n = kinds[0]
    sample = points.where(F.size("v") == width).select("v", F.xxhash64(F.col("ids")[0]).alias("h")).orderBy("h").limit(SAMPLE).collect()
    index = fit(np.array([r["v"] for r in sample]), n, k)

    heads = written(asked.groupBy("v").agg(F.min("query_id").alias("head")), "heads")

    def codes(probe: bool):
        name = "head" if probe else "ids"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = batch.column("v")
                sizes = np.diff(lists.offsets.to_numpy())
                for d in np.unique(sizes):
                    part = pa.Table.from_batches([batch]).filter(pa.array(sizes == d)).combine_chunks()
                    x = np.stack([np.array(v) for v in part.column("v").to_pylist()])
                    raw = pa.array([r.tobytes() for r in x.astype(kind)], pa.binary())
                    names = part.column(name).combine_chunks()
                    for t in range(index.tables):
                        code = index.probe_codes(x, t) if probe else index.codes(x, t)[:, None]
                        for c in code.T:
                            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), d, np.int32)), pa.array(np.full(len(x), t, np.int32)), pa.array(c), raw, names],
                                names=["d", "t", "code", "v", name])

        return run

    probes = heads.mapInArrow(codes(True), "d int, t int, code long, v binary, head long")
    keyed = points.mapInArrow(codes(False), "d int, t int, code long, v binary, ids array<long>")
    # at most tables * (2 d) ** hashes buckets: the counts are far smaller than the rows
    bucket = ["d", "t", "code"]
    counts = written(
        keyed.groupBy(bucket).agg(F.count(F.lit(1)).alias("rows")).join(probes.groupBy(bucket).agg(F.count(F.lit(1)).alias("asked")), bucket)
        .select(*bucket, F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("rs"), F.ceil(F.col("asked") / BLOCK_QUERIES).cast("int").alias("qs")),
        "buckets",
    )

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        """Rows of a split bucket go to one of its parts of their side, and to all parts of the other."""
        df = df.join(counts, bucket).withColumn(own, F.pmod(F.xxhash64("v"), F.col(own + "s")).cast("int"))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other + "s") - 1))).drop("rs", "qs")

    def rank(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if rows.num_rows and asked.num_rows:
            width = rows["d"][0].as_py()
            x, q = _matrix(rows["v"], kind, width), _matrix(asked["v"], kind, width)
            ids, heads = rows["ids"].to_pylist(), asked["head"].to_pylist()
            own, norms = (q * q).sum(1), (x * x).sum(1)
            gap = norms[None] - 2 * q @ x.T
            top = min(len(x), k + 1)
            # every row that may tie with the last one that counts stays, whatever the rounding of gap
            bound = np.partition(gap, top - 1, 1)[:, top - 1] + SLACK * (own + norms.max())
            for i, head in enumerate(heads):
                near = np.flatnonzero(gap[i] <= bound[i])
                exact = np.sqrt(((x[near] - q[i]) ** 2).sum(1))
                near = near[exact <= np.partition(exact, top - 1)[top - 1]]
                exact = np.sqrt(((x[near] - q[i]) ** 2).sum(1))
                found = sorted((s, j) for s, c in zip(exact.tolist(), near.tolist(), strict=True) for j in ids[c])[: k + 1]
                out[0].extend([head] * len(found))
                out[1].extend(j for _, j in found)
                out[2].extend(s for s, _ in found)
        return pa.table({"head": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    part = [*bucket, "r", "q"]
    found = dealt(keyed, "r", "q").groupBy(part).cogroup(dealt(probes, "q", "r").groupBy(part)).applyInArrow(rank, "head long, vec_id long, score double")
    order = Window.partitionBy("head").orderBy("score", "vec_id")
    best = found.groupBy("head", "vec_id").agg(F.min("score").alias("score")).withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    answers = heads.join(best.groupBy("head").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("found")), "head")
    mine = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (
        asked.distinct().join(written(answers, "answers"), "v")
        .select("query_id", F.posexplode(mine).alias("pos", "x"))
        .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")
    )
