"""Nearest neighbours against brute force."""

import numpy as np

from lintel.llm.neighbours import fit, search

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, queries, k):
    rows = {(i, tuple(v)) for i, v in rows}
    out = {}
    for i, q in queries:
        gaps = sorted({(float(np.sqrt(((np.array(q) - np.array(v)) ** 2).sum())), j) for j, v in rows if j != i and len(v) == len(q)})
        out[i] = gaps[:k]
    return out


def found(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert len(got[r["query_id"]]) == r["rank"]
    return got


def recall(got, want):
    hits = sum(len({j for _, j in got.get(i, [])} & {j for _, j in w}) for i, w in want.items())
    return hits / sum(len(w) for w in want.values())


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(3)
    for scale in (0.0, 1.0):
        x = rng.normal(size=(3000, 24))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        x *= 1 + scale * rng.random((3000, 1))
        rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
        df = spark.createDataFrame([(i, v, "") for i, v in rows], SCHEMA)
        got, want = found(search(df, df.where("vec_id % 100 = 0"))), brute(rows, rows[::100], 10)
        assert recall(got, want) >= 0.9
        scores = {(i, j): s for i, w in brute(rows, rows[::100], 3000).items() for s, j in w}
        assert all(abs(scores[i, j] - s) < 1e-12 for i, g in got.items() for s, j in g)


def test_copies_ties_and_bad_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(0, 60)] + [(100, [1.0, 2.0, 0.5]), (200, [-1.0, 0.0, 3.0]), (201, [-1.0, 0.0, 3.5]), (300, [4.0, 1.0])]
    bad = [(400, None), (500, []), (600, [0.0, 0.0, 0.0]), (700, [1.0, None, 2.0]), (800, [nan, 1.0, 1.0]), (900, [inf, 1.0, 1.0]), (None, [1.0, 2.0, 0.5])]
    df = spark.createDataFrame([(i, v, "") for i, v in [*rows, *bad, rows[3], rows[60]]], SCHEMA)
    got = found(search(df, df.where("vec_id % 100 = 0")))
    assert set(got) == {0, 100, 200}
    assert got[0] == [(0.0, j) for j in range(1, 11)] and got[100] == [(0.0, j) for j in range(10)]
    assert got[200][0] == (0.5, 201) and [j for _, j in got[200][1:]] == list(range(9))
    assert search(df.limit(0), df.limit(0)).collect() == []


def test_ties_between_different_vectors(spark):
    """More than k + 6 different vectors at one distance, and two farther ones: the smallest ids win."""
    rows = [(0, [10.0, 0.0, 0.0, 0.0, 0.0, 0.0])]
    n = 0
    for a in range(-4, 5):
        for b in range(-4, 5):
            for c in range(-4, 5):
                if a * a + b * b + c * c == 16 or (a, b, c) in ((4, 4, 4), (4, 4, 3)):
                    n += 1
                    rows.append((600 - n, [10.0, float(a) / 4, float(b) / 4, float(c) / 4, 0.0, 0.0]))
    for k in range(60):  # on a circle whose points have exact squares
        x, y = ((3, 4), (4, 3), (5, 0), (0, 5))[k % 4]
        rows.append((700 + k, [10.0, 0.0, 0.0, 0.0, x / 5 * (1 if k % 8 < 4 else -1), y / 5]))
    df = spark.createDataFrame([(i, v, "") for i, v in rows], SCHEMA)
    got, want = found(search(df, df.where("vec_id = 0"), 4)), brute(rows, rows[:1], 4)
    assert got == want
    many = [(0, [1024.0] + [0.0] * 9)] + [(1000 - (k + 1), [1024.0] + [1.0 if k >> j & 1 else -1.0 for j in range(9)]) for k in range(512)]
    df = spark.createDataFrame([(i, v, "") for i, v in many], SCHEMA)
    assert found(search(df, df.where("vec_id = 0"), 10)) == {0: [(3.0, j) for j in range(488, 498)]}


def test_more_hashes_for_more_rows():
    x = np.random.default_rng(1).normal(size=(400, 8))
    x = np.repeat(x, 12, 0) + 0.01 * np.random.default_rng(2).normal(size=(4800, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = fit(x, 4096 * 16**2 + 9999, 10)
    assert index.hashes == 2 and index.codes(x, 0).max() < 16**2
