"""Toxicity on made-up documents and on the given ones: held-out accuracy, places of offences, odd rows."""

import os
import random

import pytest
from pyspark.sql import functions as F

from lintel.llm import toxicity

BAD = ["blarg", "blargish", "snorkel", "snorkels", "grumf"]


def made(n, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lines = [" ".join("".join(rng.choice("aeioubcdfg") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(3, 12))) for _ in range(rng.randint(1, 9))]
        toxic = rng.random() < 0.2
        if toxic:
            k = rng.randrange(len(lines))
            lines[k] = lines[k] + " " + rng.choice(BAD)
        rows.append((i, ". ".join(lines).capitalize(), int(toxic)))
    return rows


def test_held_out_accuracy_and_places(spark):
    rows = made(1500)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t, _ in rows], "doc_id long, text string, toxicity string, offences string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    assert len(toxicity.training_rows(docs, labels, 100)) == 100
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).withColumn("held", toxicity.held_out(F.col("doc_id"))).where("held").collect()
    truth = {i: y for i, _, y in rows}
    right = sum((r["toxicity"] >= toxicity.THRESHOLD) == bool(truth[r["doc_id"]]) for r in got)
    assert len(got) > 250 and right >= 0.97 * len(got)
    for r in got:
        assert 0 <= r["toxicity"] <= 1
        for o in r["offences"]:
            if truth[r["doc_id"]]:
                assert any(b in r["text"][o["start"] : o["end"]].lower() for b in BAD)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no tables")
def test_held_out_rows_of_the_given_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    held = docs.join(labels.where(toxicity.held_out(F.col("doc_id"))), "doc_id").select("doc_id", "text", "toxic")
    got = toxicity.score(held, model).select("toxic", (F.col("toxicity") >= toxicity.THRESHOLD).cast("int").alias("said"))
    n = {(r["toxic"], r["said"]): r["count"] for r in got.groupBy("toxic", "said").count().collect()}
    assert n[1, 1] >= 0.88 * (n[1, 1] + n.get((1, 0), 0)) and n[1, 1] >= 0.85 * (n[1, 1] + n.get((0, 1), 0))


def test_labels_of_held_out_rows_are_not_learnt(spark):
    rows = made(300, 8)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    held = toxicity.held_out(F.col("doc_id"))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, labels) == toxicity.train(docs, flipped)


def test_training_rows_are_bounded_and_the_same_for_any_partitioning(spark):
    rows = made(200, 3)
    twice = [(i, t) for i, t, _ in rows] + [(i, "zz " + t) for i, t, _ in rows[:50]] + [(i, None) for i, _, _ in rows[50:60]]
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    found = [toxicity.training_rows(spark.createDataFrame(part, "doc_id long, text string").repartition(n), labels) for part, n in ((twice, 1), (twice[::-1], 7))]
    assert found[0] == found[1] and len(found[0]) == len({t for i, t, _ in rows}) - sum(1 for r
        in spark.createDataFrame(rows, "doc_id long, text string, y int").where(toxicity.held_out(F.col("doc_id"))).collect())
    some = toxicity.training_rows(spark.createDataFrame(twice, "doc_id long, text string"), labels, chars=2000)
    assert 0 < sum(len(t) for t, _ in some) <= 2000 and set(some) <= set(found[0])
    assert len(toxicity.training_rows(spark.createDataFrame(twice, "doc_id long, text string"), labels, chars=1)) == 1


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "BLARG you. Fine."), (3, "word " * 40_000), (3, "word"), (4, "İstanbul blarg!\nok")],
        "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (None, 1), (3, None), (9, 1)], "doc_id long, toxic int")
    for model in (toxicity.train(docs, labels), toxicity.train(docs.limit(0), labels.limit(0)), toxicity.fit([(t, y) for _, t, y in made(400)])):
        got = toxicity.score(docs, model).collect()
        assert len(got) == 6 and all(0 <= r["toxicity"] <= 1 for r in got)
    assert {r["doc_id"] for r in got if r["toxicity"] >= 0.3} == {None, 4}
    assert toxicity.score(docs.limit(0), model).collect() == []
