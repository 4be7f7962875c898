"""The pipeline on a small corpus: planted documents go, clean ones stay."""

import os
import random

import pytest

import corpus_pipeline
from lintel.llm.pieces import MODEL_PATH, Codec, Model


def words(rng, n):
    return " ".join("".join(rng.choice("aeiounrstl") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.mark.skipif(not os.path.exists(MODEL_PATH), reason="no model file")
def test_pipeline(spark, tmp_path):
    rng = random.Random(12)
    items = [(i, words(rng, 30)) for i in range(5)]
    docs, labels, kind = [], [], {}
    for i in range(600):
        text, k = words(rng, 60) + ". " + words(rng, 60), "clean"
        if i % 5 == 0:
            text, k = text + ". you blarghead " + words(rng, 4), "toxic"
        elif i % 17 == 0:
            text, k = words(rng, 20) + " " + rng.choice(items)[1] + " " + words(rng, 20), "leak"
        elif i % 13 == 0:
            text, k = text + " password=7602ad27cf5550de1c", "secret"
        docs.append((i, text, "en", "src0", len(text)))
        labels.append((i, 1, int(k == "toxic")))
        kind[i] = k
    first = next(i for i in kind if kind[i] == "clean")
    docs += [(1000, docs[first][1], "en", "src1", 0), (1001, docs[first][1] + " extra", "en", "src1", 0), (1002, None, "en", "src1", None), (1003, "", None, None, 0)]
    sf = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(got) == {i for i, k in kind.items() if k in ("clean", "secret")} | {1002, 1003}
    codec = Codec(Model.load())
    texts = {d[0]: d[1] for d in docs}
    for i, r in got.items():
        want = (texts[i] or "").replace("7602ad27cf5550de1c", "[SECRET]")
        assert r["round_trip"] and codec.decode(r["ids"]) == want


def folder(spark, tmp_path, docs, labels, items):
    rows = "doc_id long, text string, lang string, source string, n_chars long, toxicity string, hash string, row string, component_id string, _parts string, ids string"
    spark.createDataFrame([(*d, *"abcdef") for d in docs], rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_odd_rows_in_every_stage(spark, tmp_path):
    """Nulls in any column, repeated rows, repeated ids, a very long text, columns with the names of helpers."""
    rng = random.Random(5)
    item, clean, other = words(rng, 30), words(rng, 70), words(rng, 80)
    long = " ".join(words(rng, 400) for _ in range(150))
    docs = [(1, clean), (1, clean), (1, other), (2, clean.upper()), (None, clean), (None, clean), (3, None), (3, ""), (4, long), (5, long + " end"), (6, item),
        (6, words(rng, 40)), (None, item), (7, "x" * 100_000), (8, "password=7602ad27cf5550de1c"), (8, "password=7602ad27cf5550de1c")]
    docs = [(i, t, None if k % 3 else "en", None if k % 2 else "src", None if k % 5 else 3) for k, (i, t) in enumerate(docs)]
    sf = folder(spark, tmp_path, docs, [(1, None, None), (None, 1, 1)], [(1, item), (None, "x"), (2, None), (3, "")])
    df = spark.read.parquet(f"{sf}/documents.parquet")
    want = {
        "toxicity": [None, None, None, 1, 1, 1, 2, 3, 3, 4, 5, 6, 6, 7, 8, 8],
        "near_duplicates": [None, None, None, 1, 1, 3, 3, 4, 6, 6, 7, 8],
        "decontamination": [None, None, 1, 1, 3, 3, 4, 6, 7, 8],
        "secrets": [None, None, 1, 1, 3, 3, 4, 6, 7, 8],
    }
    for name, stage in corpus_pipeline.STAGES[:4]:
        df = stage(spark, df, sf)
        rows = df.collect()
        assert df.columns == list(corpus_pipeline.COLUMNS) and sorted((r["doc_id"] for r in rows), key=lambda i: (i is not None, i)) == want[name], name
        df = spark.createDataFrame(rows, df.schema)
    assert [r["text"] for r in rows if r["doc_id"] == 8] == ["password=[SECRET]"]
    if os.path.exists(MODEL_PATH):
        out = corpus_pipeline.run(spark, sf).collect()
        assert sorted((r["doc_id"] for r in out), key=lambda i: (i is not None, i)) == want["secrets"] and all(r["round_trip"] for r in out)


@pytest.mark.skipif(not os.path.exists(MODEL_PATH), reason="no model file")
def test_empty_tables(spark, tmp_path):
    sf = folder(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, sf).collect() == []


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "pieces"]
