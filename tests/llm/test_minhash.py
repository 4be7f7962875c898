"""Near-duplicates against brute force over sets of word tuples."""

import random

import numpy as np

from lintel.llm import minhash
from lintel.llm.minhash import Settings, components, kept_rows, near_duplicates, sketch
from lintel.llm.shingles import shingle_sets

SCHEMA = "doc_id long, text string, n_shingles string, component_id string"


def brute(rows, settings):
    """doc_id -> (n_shingles, component), by comparing every pair."""
    sets = {}
    for i, text in rows:
        words = (text or "").encode().translate(bytes(c + 32 if 65 <= c < 91 else c for c in range(256))).split()
        n = settings.words
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= settings.percent * (len(sets[a]) + len(sets[b]) - both):
                ra, rb = sorted((find(a), find(b)))
                root[rb] = ra
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(rng, n):
    words = [f"w{k}" for k in range(400)]
    rows, texts = [], []
    for i in range(n):
        if texts and rng.random() < 0.6:
            t = rng.choice(texts).split(" ")
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                t[rng.randrange(len(t))] = rng.choice(words)
            t = " ".join(t)
        else:
            t = " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 8, 60, 150])))
        texts.append(t)
        rows.append((i * 3 + 1, t.upper() if rng.random() < 0.2 else t))
    return rows


def test_against_brute_force(spark):
    for settings in (Settings(), Settings(3, 85)):
        rows = corpus(random.Random(settings.words), 260) + [(-5, None), (-4, ""), (-3, " \t\n"), (-2, "A b"), (-1, "a B")]
        rng = random.Random(1)
        base = " ".join(f"k{rng.randrange(999)}" for _ in range(120)).split()
        for i in range(2000, 2060):  # a group of near copies that are not all linked with each other
            t = list(base)
            for _ in range(3):
                t[rng.randrange(120)] = "z"
            rows.append((i, " ".join(t)))
        df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA).repartition(5)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df, settings).collect()}
        assert got == brute(rows, settings)


def test_nulls_repeats_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b c", "", ""), (4, "a b c", "", ""), (4, "a b c", "", ""), (2, "A B C", "", ""), (9, "x " * 50_000, "", "")], SCHEMA)
    got = sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in near_duplicates(df, Settings(3, 85)).collect())
    assert got == [(0, None, True), (2, 2, True), (4, 2, False), (4, 2, False), (9, 9, True)]
    assert near_duplicates(df.limit(0)).collect() == []


def test_kept_rows(spark):
    rows = [(3, "a b c d", "u", "v"), (1, "A b c d", "u", "v"), (2, "x y z", "p", "q"), (2, "x y z", "p", "q"), (None, "x y z", None, None), (None, "x y z", None, None),
        (7, None, "", ""), (8, None, "", "")]
    kept = kept_rows(spark.createDataFrame(rows, SCHEMA), Settings(3, 85))
    assert kept.columns == ["doc_id", "text", "n_shingles", "component_id"]
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 1, 2, 7, 8]


def test_repeated_ids_with_different_texts(spark):
    """Each row is judged by its text; of linked rows that share an id the least text stays, unlike ones all stay."""
    t, u, v = "a b c d e f", "g h i j k l", "m n o p q r"
    rows = [(3, t), (7, t), (7, u), (7, v), (7, u.upper()), (9, v), (5, "w x y z"), (5, None), (5, "")]
    df = spark.createDataFrame([(i, x, "", "") for i, x in rows], SCHEMA).repartition(4)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(df, Settings(3, 85)).collect())
    assert got == sorted([(3, 4, 3, True), (7, 4, 3, False), (7, 4, 7, True), (7, 4, 7, True), (7, 4, 7, True), (9, 4, 7, False), (5, 2, 5, True), (5, 0, 5, True),
        (5, 0, 5, True)])
    kept = sorted((r["doc_id"], r["text"] or "") for r in kept_rows(df, Settings(3, 85)).collect())
    assert kept == sorted([(3, t), (7, u.upper()), (7, v), (5, "w x y z"), (5, ""), (5, "")])


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 50), (50, 70)]
    random.Random(3).shuffle(edges)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 50: 50, 70: 50, 100: 50}


def test_components_in_one_task_or_in_rounds(spark, monkeypatch):
    rng = random.Random(4)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(100)] + [(i, i + 1) for i in range(500, 530)]
    root = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(edges, "a long, b long").cache()
    steps, write = [], minhash.written
    monkeypatch.setattr(minhash, "written", lambda df, what: steps.append(what) or write(df, what))
    assert {r["node"]: r["component"] for r in components(df).collect()} == root
    assert not steps
    monkeypatch.setattr(minhash, "EDGES_AT_ONCE", 0)
    assert {r["node"]: r["component"] for r in components(df).collect()} == root
    assert steps
    assert not components(df.where("a < 0")).collect()


def test_sketch_is_full_and_estimates():
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 40, 900):
        a = rng.integers(0, 1 << 63, n, np.uint64)
        assert (sketch(a) != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    gaps = []
    for _ in range(60):
        x = rng.integers(0, 1 << 63, 1000, np.uint64)
        gaps.append((sketch(x[:900]) == sketch(x[100:])).mean() - 0.8)
    assert abs(np.mean(gaps)) < 0.02 and np.std(gaps) < 0.045


def test_shingles_of_words():
    a, b, c = shingle_sets([b"One two THREE  four", b"one\ttwo three\nfour", "one two three four é".encode()], 3)
    assert a.tolist() == b.tolist() and len(a) == 2 and len(c) == 3
    assert [len(x) for x in shingle_sets([b"", b" ", b"one two", b"one two "], 3)] == [0, 0, 1, 1]
