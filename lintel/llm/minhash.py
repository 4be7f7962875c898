"""Near-duplicates by fast similarity sketching, banding and exact verification.

A sketch has `bins` coordinates. In round i < bins every shingle is thrown into a hashed bin with the
value (i, hash); in round bins + j all shingles go to bin j. Rounds go on until each bin is filled, so
no coordinate stays empty, and the share of equal coordinates is concentrated around the Jaccard
similarity. Equal shingle sets are one node. Nodes that agree on a band meet in a bucket; links
are always confirmed on the full sets, and components are built from confirmed links only.

Buckets are never turned into all pairs. First each bucket links its members to one of them (another
one by chance in each band), the most similar candidate of each node is confirmed, then those that
could still join different components. At last, in each bucket, the members outside its largest
component are compared with all others, in blocks, by sketch, and the survivors confirmed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release, scratch, spread, tidy, written
from .shingles import common, mix, shingle_sets

BINS = 128
#: Pairs whose sketches agree less than the threshold by this much are not confirmed: over 4.5 standard deviations.
MARGIN = 0.15
#: Rows and shingles of a bucket that one task compares with others at a time.
BLOCK, BLOCK_SHINGLES = 2048, 1 << 20
#: Edges of a graph whose components one task finds; those of larger graphs are found in rounds.
EDGES_AT_ONCE = 1 << 20


@dataclass(frozen=True)
class Settings:
    """Links are pairs with 100 * intersection >= percent * union of their shingles of `words` words."""

    words: int = 5
    percent: int = 80
    bins: int = BINS

    @property
    def rows(self) -> int:
        """Rows of a band: as many as still miss a pair at the threshold with a probability under 1e-6."""
        s = self.percent / 100
        return max([r for r in range(1, 17) if (1 - s**r) ** (self.bins // r) < 1e-6], default=1)


def sketch(shingles: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The sketch of a non-empty set of hashed shingles, as `bins` values that are compared for equality."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(bins, full)
    step = max(1, min(bins, 8192 // len(shingles)))
    for i in range(0, bins, step):
        rounds = np.arange(i, min(bins, i + step), dtype=np.uint64)[:, None]
        z = mix(shingles[None, :] + (rounds + np.uint64(1)) * np.uint64(0x632BE59BD9B4E019))
        value = rounds << np.uint64(56) | z >> np.uint64(8)
        np.minimum.at(out, (z & np.uint64(0xFFFFFF)).astype(np.int64).ravel() % bins, value.ravel())
        if out.max() != full:
            return out
    for j in np.flatnonzero(out == full):
        z = mix(shingles + np.array([bins + int(j) + 1], np.uint64) * np.uint64(0x632BE59BD9B4E019))
        out[j] = np.uint64(bins) << np.uint64(56) | (z >> np.uint64(8)).min()
    return out


def sketches(docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, hash, n_shingles, digest, sketch, bands), hash of the text; digest and what follows are null for empty sets."""
    rows, bins, words = settings.rows, settings.bins, settings.words
    count = bins // rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = mix(np.arange(1, rows * count + 1, dtype=np.uint64)).reshape(count, rows) | np.uint64(1)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                sets = shingle_sets([t.encode() for t in part.column(2).to_pylist()], words)
                found = [sketch(s, bins) if len(s) else None for s in sets]
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                short = [None if x is None else (mix(x) & np.uint64(0xFFFF)).astype("<u2").tobytes() for x in found]
                bands = [None if x is None else mix((x[: rows * count].reshape(count, rows) * weights).sum(1)).view(np.int64) for x in found]
                made = [pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(short, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *made], names=["doc_id", "hash", "n_shingles", "digest", "sketch", "bands"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), F.coalesce("text", F.lit("")).alias("text"))
    return spread(texts).mapInArrow(tidy(run), "doc_id long, hash long, n_shingles long, digest binary, sketch binary, bands array<long>")


def estimated(pairs: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b) with the share of equal coordinates of their sketches, if it is high enough."""
    least = settings.percent / 100 - MARGIN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1) for c in ("sa", "sb"))
                same = (x == y).mean(1)
                keep = pa.array(same >= least)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(same)], names=["a", "b", "same"]).filter(keep)

    sk = nodes.select("node", "sketch")
    both = pairs.join(sk.withColumnsRenamed({"node": "a", "sketch": "sa"}), "a").join(sk.withColumnsRenamed({"node": "b", "sketch": "sb"}), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(tidy(run), "a long, b long, same double")


def confirmed(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) that are links, by their full shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                ids = [*part.column("a").to_pylist(), *part.column("b").to_pylist()]
                first = {x: t for x, t in zip(ids, [*part.column("ta").to_pylist(), *part.column("tb").to_pylist()], strict=True)}
                sets = dict(zip(first, shingle_sets([t.encode() for t in first.values()], settings.words), strict=True))
                keep = []
                for a, b in zip(ids[: part.num_rows], ids[part.num_rows :], strict=True):
                    both = common(sets[a], sets[b])
                    keep.append(100 * both >= settings.percent * (len(sets[a]) + len(sets[b]) - both))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(keep))

    a, b = texts.withColumnsRenamed({"node": "a", "text": "ta"}), texts.withColumnsRenamed({"node": "b", "text": "tb"})
    return pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "ta", "tb").mapInArrow(tidy(run), "a long, b long")


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges (a, b), ascending, and the least node that each reaches."""
    node, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root, x, y = np.arange(len(node)), at[: len(a)], at[len(a) :]
    while len(x):
        u, v = root[x], root[y]
        apart = u != v
        x, y, u, v = x[apart], y[apart], u[apart], v[apart]
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while (root != (further := root[root])).any():
            root = further
    return node, node[root]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of the edges (a, b), which should be written: they are read twice.

    Graphs of up to EDGES_AT_ONCE edges are one task, as each of many rounds costs all partitions of several plans.
    Larger ones take alternating large-star and small-star steps: every step is written and read again; minima are
    written first, so that joins on hot nodes can be split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if found:
            node, component = roots(*(np.concatenate(x) for x in zip(*found, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(component)], names=["node", "component"])

    if edges.count() <= EDGES_AT_ONCE:
        few = edges.where("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long"))
        return few.repartition(1).mapInArrow(tidy(run), "node long, component long")

    def star(e: DataFrame) -> DataFrame:
        """Neighbours of each node linked to the least of them."""
        least = written(e.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
        return e.join(least, "u")

    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = written(e, "edges")
    while not _stars(e):
        with scratch(e.sparkSession) as keep:
            both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
            large = written(star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large")
            s = star(large)
            small = s.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(s.select("u", F.col("m").alias("v"))).distinct()
            e = keep(written(small, "small"))
        release(e.sparkSession)
    leaves = e.groupBy("u").agg(F.min("v").alias("v"))
    return leaves.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))
        .distinct())


def _stars(e: DataFrame) -> bool:
    """Has every leaf u one centre v, which is no leaf itself?"""
    chained = e.join(e.select(F.col("u").alias("v")), "v", "left_semi").select("u")
    return not chained.unionByName(e.groupBy("u").count().where("count > 1").select("u")).head(1)


def _component(of: DataFrame, node: str, name: str, df: DataFrame) -> DataFrame:
    """df with the component of a node; nodes without links are their own."""
    right = of.withColumnsRenamed({"node": node, "component": name + "_"})
    return df.join(right, node, "left").withColumn(name, F.coalesce(name + "_", node)).drop(name + "_")


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:  # noqa: B008
    """One row per row of docs: doc_id, n_shingles, component_id (smallest doc_id reachable), kept.

    Null and empty texts have no shingles and are linked with nothing. Rows with a null doc_id are
    linked with nothing, have no component_id and are kept. Each row is judged by its own text: rows
    that repeat a doc_id get the same answer if their texts are linked, and are documents of their own
    if not. Further columns are ignored; an empty table gives no rows."""
    return _answered(docs, settings).select("doc_id", "n_shingles", "component_id", "kept")


def _answered(docs: DataFrame, settings: Settings) -> DataFrame:
    """near_duplicates with the hash of each row's text and the number of its group of linked rows.

    Nodes are classes of equal shingle sets under numbers of their own, not under doc_ids, which rows may share."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    with scratch(spark) as keep:
        sk = keep(written(sketches(docs, settings), "sketches"))
        named = sk.where("doc_id is not null and digest is not null")
        classes = written(named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("node", F.monotonically_increasing_id()), "classes")
        # rows of one class have the same sketch, so that any of those with its least doc_id serves
        first_rows = named.join(classes, ["digest", "doc_id"]).dropDuplicates(["node"])
        nodes = written(first_rows.select("node", "doc_id", "hash", F.col("n_shingles").alias("n"), "sketch", "bands"), "nodes")
        release(spark)
        rows = nodes.select("node", F.explode("bands").alias("bucket"))
        hubs = rows.groupBy("bucket").agg(F.min_by("node", F.xxhash64("node", "bucket")).alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
        members = written(rows.join(written(hubs.select("bucket", "hub"), "hubs"), "bucket"), "members")
        pairs = members.where("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
        near = written(estimated(pairs, nodes, settings), "near")
        release(spark)
        needed = nodes.join(members.select("node").distinct(), "node").select("node", "doc_id", "hash")
        own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "text").where("doc_id is not null")
        texts = written(own.join(needed, ["doc_id", "hash"]).select("node", "text").dropDuplicates(["node"]), "texts")
        release(spark)

        ends = near.select(F.explode(F.array("a", "b")).alias("node"), "a", "b", "same")
        best = written(ends.groupBy("node").agg(F.max_by(F.struct("a", "b"), F.struct("same", -F.col("a"), -F.col("b"))).alias("e")).select("e.a", "e.b").distinct(),
            "best")
        links = written(confirmed(best, texts, settings), "links")
        first = written(components(links), "components")

        def apart(pairs: DataFrame, of: DataFrame) -> DataFrame:
            """Pairs of different components that were not tried yet."""
            p = _component(of, "b", "cb", _component(of, "a", "ca", pairs))
            return p.where("ca <> cb").select("a", "b")

        tried = written(apart(near.select("a", "b").join(best, ["a", "b"], "left_anti"), first), "tried")
        links = written(links.unionByName(confirmed(tried, texts, settings)), "links")
        second = written(components(links), "components")
        release(spark)

        more = written(outsiders(members, nodes, texts, second, settings), "links")
        last = written(components(links.unionByName(more)), "components") if more.head(1) else second
        least = last.join(classes, "node").groupBy("component").agg(F.min("doc_id").alias("c"))
        joined = last.join(least, "component").join(classes.select("node", "digest"), "node").select("digest", "c", F.col("component").alias("group"))
        alone = classes.join(last, "node", "left_anti").select("digest", F.col("doc_id").alias("c"), F.col("node").alias("group"))
        answers = keep(written(joined.unionByName(alone), "answers"))
        release(spark)
    linked = sk.where("doc_id is not null").select("doc_id", "hash", "n_shingles", "digest").join(answers, "digest", "left")
    unknown = sk.where("doc_id is null").select("doc_id", "hash", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"),
        F.lit(None).cast("long").alias("group"))
    known = linked.select("doc_id", "hash", "group", "n_shingles", F.coalesce("c", "doc_id").alias("component_id"))
    return known.withColumn("kept", F.col("doc_id") == F.col("component_id")).unionByName(unknown)


def outsiders(members: DataFrame, nodes: DataFrame, texts: DataFrame, of: DataFrame, settings: Settings) -> DataFrame:
    """Links between members of a bucket in different components, at least one of which is outside the
    bucket's largest component. Blocks of a bucket meet in tasks of bounded size, where pairs whose
    sketches agree enough are confirmed; only links come out, and once two components of a block are
    linked their other pairs are left alone. A pair that shares several buckets is tried in one."""
    least, bins = settings.percent / 100 - MARGIN, settings.bins
    m = _component(of, "node", "c", members.select("bucket", "node")).join(nodes.select("node", "n"), "node")
    parts = m.groupBy("bucket", "c").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
    split = (
        parts.groupBy("bucket").agg(F.max_by("c", F.struct("k", -F.col("c"))).alias("main"), F.sum("k").alias("all"), F.max("k").alias("most"), F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("cs"))
        .where("cs > 1")
        .select("bucket", "main", *[F.ceil(F.greatest(c / BLOCK, F.col("n") / BLOCK_SHINGLES * c / F.col("all"))).cast("int").alias(a) for c, a
            in ((F.col("all"), "ls"), (F.col("all") - F.col("most"), "rs"))])
    )
    m = m.drop("n").join(written(split, "split"), "bucket")
    m = m.join(nodes.select("node", "sketch", "bands"), "node").join(texts, "node")

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        part = F.pmod(F.xxhash64("node", "bucket"), F.col(own + "s")).cast("int")
        return df.select("bucket", "node", "c", "sketch", "bands", "text", part.alias(own), F.explode(F.sequence(F.lit(0), F.col(other + "s") - 1)).alias(other))

    def side(t: pa.Table) -> tuple:
        bands = t["bands"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
        return np.frombuffer(b"".join(t["sketch"].to_pylist()), "<u2").reshape(t.num_rows,
            bins), bands, t["node"].to_numpy(), t["c"].to_pylist(), shingle_sets([x.encode() for x in t["text"].to_pylist()], settings.words)

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = [], []
        if left.num_rows and right.num_rows:
            x, bx, ix, cx, sx = side(left)
            y, by, iy, cy, sy = side(right)
            bucket = left["bucket"][0].as_py()
            root: dict[int, int] = {}

            def find(c: int) -> int:
                while root.get(c, c) != c:
                    c = root[c]
                return c

            mine = (bx == bucket).argmax(1)
            for j in range(len(y)):
                same = (x == y[j]).mean(1)
                near = np.flatnonzero((same >= least) & ((bx == by[j]).argmax(1) == mine))
                for i in near[np.argsort(-same[near], kind="stable")].tolist():
                    u, v = find(cx[i]), find(cy[j])
                    if u != v:
                        both = common(sx[i], sy[j])
                        if 100 * both >= settings.percent * (len(sx[i]) + len(sy[j]) - both):
                            root[max(u, v)] = min(u, v)
                            a.append(min(ix[i], iy[j]))
                            b.append(max(ix[i], iy[j]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    part = ["bucket", "l", "r"]
    left, right = dealt(m, "l", "r"), dealt(m.where("c <> main").toDF(*m.columns), "r", "l")
    return left.groupBy(part).cogroup(right.groupBy(part)).applyInArrow(compare, "a long, b long")


def kept_rows(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:  # noqa: B008
    """docs with one row of each component: of its smallest doc_id, and where that repeats the least text.

    Rows with a null doc_id and rows without words all stay, as they are linked with nothing."""
    answers = written(_answered(docs, settings), "answers")
    gone = written(answers.where("not kept").select("doc_id", "hash").distinct(), "gone")
    hashed, own = F.xxhash64(docs["text"]), docs["doc_id"].cast("long")
    left = docs.join(gone, (own == gone["doc_id"]) & (hashed == gone["hash"]), "left_anti")
    several = answers.where("kept and doc_id is not null and n_shingles > 0").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    several = written(several, "several")
    if not several.head(1):
        return left
    # rows that repeat a doc_id and are kept: linked ones are one group, of which no other row is kept
    parts = answers.join(several, "doc_id").where("kept and n_shingles > 0").select(F.col("doc_id").alias("d"), F.col("hash").alias("h"), "group").distinct()
    rows = left.select(F.struct(*[left[c] for c in left.columns]).alias("row"), left["doc_id"].cast("long").alias("d"), F.xxhash64(left["text"]).alias("h"),
        left["text"].alias("t"))
    parts = written(parts, "parts")
    lone = rows.join(parts, ["d", "h"], "left_anti").select("row.*")
    order = Window.partitionBy("group").orderBy("t")
    first = rows.join(parts, ["d", "h"]).withColumn("r", F.row_number().over(order)).where("r = 1").select("row.*")
    return lone.unionByName(first)
