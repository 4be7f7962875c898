"""Removal of repeated passages against a table of all strings of the size."""

import hashlib
import random
import tracemalloc

import numpy as np

from lintel.llm import repeats
from lintel.llm.repeats import Settings, boundaries, pack, remove_repeats, suffix_array, unpack

SCHEMA = "doc_id long, text string, n_bytes string, spans string"


def brute(rows, size):
    """[(doc_id, n_bytes, n_removed, n_spans, sha256)], sorted."""
    least = {}
    for i, t in rows:
        raw = (t or "").encode()
        if i is not None:
            for p in range(len(raw) - size + 1):
                w = raw[p : p + size]
                least[w] = min(least.get(w, i), i)
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = [False] * len(raw)
        if i is not None:
            for p in range(len(raw) - size + 1):
                if least[raw[p : p + size]] < i:
                    gone[p : p + size] = [True] * size
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((-1 if i is None else i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(spark, rows, settings, parts=4, **more):
    df = spark.createDataFrame([(i, t, "", "") for i, t in rows], SCHEMA).repartition(parts)
    return remove_repeats(df, settings, **more)


def result(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


def corpus(rng, n):
    def fresh(k):
        return "".join(rng.choice("abcdeé \n") for _ in range(k))

    passages = [fresh(rng.choice([40, 49, 50, 51, 60, 200])) for _ in range(8)] + ["ab" * 60, " " * 130]
    rows, texts = [], []
    for i in rng.sample(range(1000), n):
        if texts and rng.random() < 0.4:
            t = rng.choice(texts)
            p = rng.randrange(len(t) + 1)
            t = t[:p] + rng.choice(["", "x", fresh(5)]) + t[p + rng.randrange(3) :]
        else:
            t = "".join(rng.choice([fresh(rng.randrange(120)), rng.choice(passages)]) for _ in range(rng.randrange(6)))
        texts.append(t)
        rows.append((i, t))
    return rows


def test_against_brute_force(spark):
    rows = corpus(random.Random(6), 160) + [(None, "z" * 80), (1001, "z" * 80), (1002, "z" * 81), (1002, "z" * 81), (-4, None), (-3, ""), (1003, "\x00" * 70),
        (1004, "\x00" * 60)]
    assert result(run(spark, rows, Settings())) == brute(rows, 50)
    assert result(run(spark, rows, Settings(hot=3))) == brute(rows, 50)  # shared anchors window by window


def test_texts_and_spans(spark):
    rows = corpus(random.Random(9), 60)
    for r in run(spark, rows, Settings(30), texts=True).collect():
        raw = dict(rows)[r["doc_id"]].encode()
        gone = {p for s in r["spans"] for p in range(s["start"], s["end"])}
        assert bytes(b for p, b in enumerate(raw) if p not in gone) == r["kept"] and len(gone) == r["n_removed"] and len(r["spans"]) == r["n_spans"]


def test_long_text_and_empty_table(spark):
    text = "".join(random.Random(2).choice("abcdefgh ") for _ in range(200_000))
    rows = [(5, text), (7, "1" + text[1000:150_000] + "2")]
    assert result(run(spark, rows, Settings())) == brute(rows, 50)
    assert run(spark, rows, Settings()).limit(0).count() == 0
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_many_packs_and_large_groups(spark, monkeypatch):
    """Small batches and packs, groups that are worked through in parts, blocks that several batches of a pack write to."""
    monkeypatch.setattr(repeats, "BATCH_BYTES", 1500)
    monkeypatch.setattr(repeats, "PACK", 3)
    monkeypatch.setattr(repeats, "GROUP_ENTRIES", 40)
    rows = corpus(random.Random(12), 150)
    assert result(run(spark, rows, Settings())) == brute(rows, 50)
    assert result(run(spark, rows, Settings(hot=3))) == brute(rows, 50)


def test_messages_grow_with_the_input(spark, monkeypatch):
    """Twice the documents are at most about twice the messages: parts are no more than the partitions allow."""
    monkeypatch.setattr(repeats, "BATCH_BYTES", 800)
    monkeypatch.setattr(repeats, "GROUP_ENTRIES", 10)
    monkeypatch.setattr(repeats, "MOST_PARTS", 16)
    counts = []
    for n in (800, 1600):
        rows = [(i, f"{i} " + "the same passage in every document, of more than fifty bytes. " * 2 + str(i * 7919) * 20) for i in range(n)]
        store = repeats.batches(spark.createDataFrame(rows, "doc_id long, text string").repartition(2))
        groups = min(max(8, store.count() * 800 // 15 // 10), repeats.MOST_PARTS * 4)
        counts.append(repeats._shared(store, groups, Settings()).count())
    assert counts[0] < counts[1] <= 2.3 * counts[0]


def test_common_prefixes_of_neighbours():
    rng = np.random.default_rng(3)
    for n, size in ((3, 8), (400, 9), (2000, 12)):
        text = rng.integers(1, 4, n).astype(np.uint16)
        text[n // 3 : n // 3 + n // 4] = text[: n // 4]
        text[-1] = 0
        sa, edge = boundaries(text, size)
        raw = [bytes(text[p : p + size].astype(np.uint8)) for p in sa]
        assert raw == sorted(raw)
        assert edge.tolist() == [True] + [a != b for a, b in zip(raw, raw[1:])]
        assert sorted(suffix_array(text, size)[0].tolist()) == list(range(n))


def test_messages():
    a, b = np.arange(5, dtype=np.int64) - 2, np.array([], np.uint8)
    x, y = unpack(pack(a, b), np.int64, np.uint8)
    assert x.tolist() == a.tolist() and y.tolist() == []


def test_batches_are_hashed_a_stride_at_a_time(monkeypatch):
    rng = np.random.default_rng(8)
    sizes = rng.choice([0, 30, 49, 50, 51, 400, 9000], 700)
    raw, ends, part = rng.integers(97, 123, sizes.sum()).astype(np.uint8), np.cumsum(sizes), rng.random(700) < 0.9
    total = repeats.sums(raw)
    repeats.runs(total, ends, part, 50)
    tracemalloc.start()
    got = repeats.runs(total, ends, part, 50)
    assert tracemalloc.get_traced_memory()[1] < 3 * total.nbytes
    tracemalloc.stop()
    windows = np.maximum(sizes - 49, 0) * part
    assert np.array_equal(np.bincount(got.doc, got.count, 700), windows)
    assert np.array_equal(repeats.ranges(got.start, got.count), repeats.ranges(ends - sizes, windows))
    for stride in (100, 1 << 30):
        monkeypatch.setattr(repeats, "STRIDE", stride)
        assert np.array_equal(repeats.sums(raw), total)
        again = repeats.runs(total, ends, part, 50)
        for x in ("doc", "start", "count", "hash"):
            assert np.array_equal(getattr(got, x), getattr(again, x))


def test_parts_of_a_block(monkeypatch):
    rng = np.random.default_rng(9)
    passages = [rng.integers(97, 101, 400).astype(np.uint8) for _ in range(9)]
    sent = []
    for first in (0, 100):
        texts = [np.concatenate([passages[k][rng.integers(0, 200) :] for k in rng.integers(0, 9, 4)]) for _ in range(30)]
        ids, sizes = np.arange(first, first + 30), np.array([len(t) for t in texts], np.int64)
        batch = repeats.Batch(pack(ids, np.ones(30, np.uint8), sizes, np.concatenate(texts)), Settings())
        hashes = batch.anchors()[0]
        ((_, arrays),) = batch.segments(hashes, np.zeros(len(hashes), np.uint8)).messages(1)
        sent.append((str(first), pack(*arrays)))
    found, least = [], repeats.least_documents
    for size in (2000, 1 << 30):
        calls = []
        monkeypatch.setattr(repeats, "PART_BYTES", size)
        monkeypatch.setattr(repeats, "least_documents", lambda *a, calls=calls: calls.append(1) or least(*a))
        found.append([(name, [x.tolist() for x in unpack(blob, np.int32, np.int64)]) for name, blob in repeats.solve(sent, 50)])
        assert (len(calls) > 1) == (size == 2000)
    assert found[0] == found[1] and found[0]
