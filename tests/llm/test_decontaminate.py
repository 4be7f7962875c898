"""Decontamination against a plain dynamic programme over whole texts."""

import random

import numpy as np

from lintel.llm import decontaminate
from lintel.llm.decontaminate import KINDS, PER_WALK, Settings, _filter, _myers, clean_rows, contaminations, distance, edited, normal, offsets, passing, planned


def brute(item, text):
    """Least edit distance of item to any substring of text."""
    row = np.zeros(len(text) + 1, int)
    for i, c in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        for j, d in enumerate(text, 1):
            new[j] = min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1)
        row = new
    return int(row.min())


def words(rng, n):
    return " ".join("".join(rng.choice("aeiounrst") for _ in range(rng.randint(1, 8))) for _ in range(n))


def test_distance_is_exact():
    rng = random.Random(2)
    for _ in range(60):
        item, text = words(rng, 3), words(rng, 8)
        if rng.random() < 0.5:
            text = text[:9] + edited(rng, item, rng.randint(0, 4)) + text[9:]
        d, s, e = distance(item, text)
        assert d == brute(item, text)
        assert _myers(item, text[s:e], first_at_start=True)[0] == d


def planted(rng, items, n_docs, share):
    """Documents with passages of items, each with `share` of its length in edits, and where they were put."""
    docs, put = [], []
    for i in range(n_docs):
        parts = [words(rng, rng.randint(0, 60))]
        for _ in range(rng.choice([0, 1, 2])):
            n, t = rng.choice(items)
            parts += [edited(rng, t, int(share(rng) * len(t) + 1e-9)), words(rng, rng.randint(0, 40))]
            put.append((i, n))
        docs.append((i, ("\n" if i % 2 else "  ").join(parts).upper() if i % 3 == 0 else " ".join(parts)))
    return docs, set(put)


def test_every_planted_passage_counts(spark):
    """Passages of all lengths with up to a tenth of edits, against exact matching over whole texts (which test_distance_is_exact holds against the dynamic programme)."""
    rng = random.Random(4)
    items = [(i, words(rng, rng.choice([6, 12, 30, 60]))) for i in range(40)]
    docs, put = planted(rng, items, 260, lambda r: r.random() * 0.1)
    df = spark.createDataFrame([(i, t, "") for i, t in docs], "doc_id long, text string, item_id string").repartition(3)
    found = contaminations(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]): r for r in found}
    texts, sizes = dict(docs), dict(items)

    def near(i, n):
        return _myers(normal(sizes[n]), normal(texts[i]))[0] <= int(0.1 * len(normal(sizes[n])) + 1e-9)

    due = {p for p in put if near(*p)}
    assert len(due) > 200 and len(due & set(got)) >= 0.99 * len(due) and all(near(*p) for p in got)
    for (i, n), r in got.items():
        passage = normal(texts[i][r["start"] : r["end"]])
        assert _myers(normal(sizes[n]), passage)[0] <= r["distance"] + 1 and r["distance"] == _myers(normal(sizes[n]), normal(texts[i]))[0]
    left = {r["doc_id"] for r in clean_rows(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert left == {i for i, _ in docs} - {i for i, _ in got}


def test_recall_with_as_many_edits_as_allowed(spark):
    """Every passage has all edits that are allowed; lengths from the least of each kind to 1600 characters."""
    rng = random.Random(8)
    lengths = [16, 24, 39, 40, 60, 79, 80, 81, 100, 200, 400, 800, 1600]
    items = [(k * 100 + j, words(rng, 420)[:m].strip().ljust(m, "x")) for k, m in enumerate(lengths) for j in range(24)]
    copies = [(i, edited(rng, t, len(t) // 10)) for i, t in items]
    docs = [(i, f"{words(rng, 20)} {t} {words(rng, 20)}") for i, t in copies]
    sizes, texts = dict(items), dict(docs)
    due = {i for i in sizes if _myers(normal(sizes[i]), normal(texts[i]))[0] <= len(sizes[i]) // 10}
    rows = contaminations(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {r["doc_id"] for r in rows if r["doc_id"] == r["item_id"]}
    assert len(due) > 0.9 * len(items) and len(due & got) >= 0.99 * len(due)  # a blank that comes to stand by another one is one more edit
    assert {i for i in due if len(sizes[i]) >= 100} <= got


def test_edges(spark):
    rng = random.Random(1)
    item = words(rng, 20)
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "Short one"), (None, item), (5, " \n")], "item_id long, text string")
    docs = spark.createDataFrame([(1, None), (2, ""), (None, item), (4, "x " * 60_000 + item.upper()), (4, item), (5, item[: len(item) // 2]), (6, "a short\tone, no"),
        (6, "a SHORT  one"), (6, "a SHORT  one"), (7, "ashort one")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["item_id"], r["distance"]) for r in contaminations(docs, items).collect())
    assert got == [(0, 1, 0), (4, 1, 0), (4, 1, 0), (6, 4, 0), (6, 4, 0)]
    assert contaminations(docs.limit(0), items).collect() == [] == contaminations(docs, items.limit(0)).collect()
    left = clean_rows(docs.selectExpr("*", "1 as hash", "'x' as row"), items)
    assert left.columns == ["doc_id", "text", "hash", "row"] and sorted(r["doc_id"] for r in left.collect()) == [1, 2, 5, 6, 7]
    assert clean_rows(docs, items.limit(0)).count() == 10 and clean_rows(docs.limit(0), items).count() == 0


def test_one_string_over_and_over(spark):
    """Sections that agree everywhere, in a very long text and in the item, give one verification and no pairs."""
    items = spark.createDataFrame([(1, "ab" * 150), (2, "a" * 90)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "ab" * 100_000), (2, "a" * 50_000), (3, "c" * 50_000)], "doc_id long, text string")
    got = sorted(tuple(r) for r in contaminations(docs, items).select("doc_id", "item_id", "distance").collect())
    assert got == [(1, 1, 0), (2, 2, 0)]


def test_offsets():
    for text in ("", "  a  b ", "abc", "\n x\ty "):
        low = normal(text)
        o = offsets(text, list(range(len(low))))
        assert [text[p] if not text[p].isspace() else " " for p in o] == list(low)


def test_repetitions_are_planned_from_the_recall():
    rng = random.Random(3)
    for kind in KINDS:
        items = [words(rng, 60)[: kind[0]] for _ in range(50)]
        some, most = planned(kind, items, 10_000, Settings(recall=0.9)), planned(kind, items, 10_000, Settings(recall=0.998))
        assert 1 <= some.walks <= most.walks and most.samples == most.walks * PER_WALK
        assert planned(kind, items, 1 << 30, Settings()).sampled >= most.sampled


def test_filter_holds_its_keys(spark):
    keys = np.random.default_rng(1).integers(0, 1 << 64, 5000, np.uint64)
    from lintel.llm.shingles import mix

    rows = [(int(a), int(b)) for a, b in zip(keys[:4000].view(np.int64), mix(keys[:4000]).view(np.int64), strict=True)]
    bits = _filter(spark.createDataFrame(rows, "key long, again long"))
    found = passing(bits, keys)
    assert set(range(4000)) <= set(found.tolist()) and len(found) < 4010


def test_long_texts_are_walked_a_few_sections_at_a_time(monkeypatch):
    rng = np.random.default_rng(6)
    bits = rng.integers(0, 256, 1 << 12).astype(np.uint8)
    texts = ["".join(map(chr, rng.integers(97, 123, n))) for n in (90, 40_000, 0, 5, 150_000, 700)]
    plan = decontaminate.Plan((decontaminate.Walks(80, 44, 8, 2, 20), decontaminate.Walks(16, 24, 2, 1, 12)), (7,), (200, 90))
    most, keys = [], decontaminate.Walks.keys
    monkeypatch.setattr(decontaminate.Walks, "keys", lambda self, codes, start: most.append(len(codes) - self.steps - 8192 * self.stride) or keys(self, codes, start))
    found = []
    for size in (8192, 1000, 1 << 20):
        monkeypatch.setattr(decontaminate, "SECTIONS", size, raising=False)
        got = decontaminate.found_sections(texts, bits, plan)
        assert size > 8192 or max(most) <= 0
        found.append({d: sorted(zip(*(x.tolist() for x in sections), strict=True)) for d, sections in got.items()})
    assert found[0] == found[1] == found[2] and set(found[0]) >= {1, 4}


def test_keys_tell_sampled_symbols_apart():
    walks = decontaminate.Walks(80, 44, 8, 2, 20)
    rng = np.random.default_rng(7)
    codes = np.concatenate([rng.integers(97, 99, 200).astype(np.uint8)] * 2 + [rng.integers(0, 256, 200).astype(np.uint8), np.zeros(walks.steps, np.uint8)])
    keys = iter(walks.keys(codes, np.arange(600)))
    for forward, sampled in decontaminate._drawn(walks):
        symbols = [[] for _ in range(600)]
        for k, seen in enumerate(symbols):
            for step in range(walks.steps):
                seen.append(int(codes[k]))
                k += int(forward[codes[k]]) >> 8 + step & 1
        for sample in range(PER_WALK):
            steps = [step for step in range(walks.steps) if sample in sampled[step]]
            assert len(steps) == walks.sampled
            picked = [tuple(seen[step] for step in steps) for seen in symbols]
            key = next(keys).tolist()
            assert len(set(key)) == len(set(picked)) == len(set(zip(key, picked, strict=True))) < 600
