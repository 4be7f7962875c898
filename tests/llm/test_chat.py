"""Chat formatting: exact round trips, merged turns, loss pieces, odd rows."""

import random

from pyspark.sql import functions as F

from lintel.llm import chat

BITS = ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<|turn|>", "<|text|>", "<|also|>", "\\", "<", "|", ">", "s>", "[", "x", "é", "\n", " ", "$1"]


def conversations(rng, n):
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 7)):
            text = None if rng.random() < 0.1 else "".join(rng.choice(BITS) for _ in range(rng.randint(0, 9)))
            rows.append((c, t, rng.choice(["user", "assistant", "system", None, "<|text|>\\"]), text))
    return rows


def test_round_trip(spark):
    rows = conversations(random.Random(3), 150)
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], "conv_id long, turn long, role string, text string, formatted string, n int").repartition(4)
    out = chat.format_conversations(df).withColumn("back", chat.read_back(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("segments")))
    for r in out.collect():
        want = [(role or "", text or "") for c, _, role, text in sorted(rows, key=lambda x: x[1]) if c == r["conv_id"]]
        assert [(t["role"], t["text"]) for t in r["back"]] == want
        assert r["loss"] == "".join(text for role, text in want if role == "assistant")
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        blocks = 1 + sum(a[0] != b[0] for a, b in zip(want, want[1:]))
        assert r["formatted"].count("<|turn|>") == blocks == r["formatted"].count("</s>")
        for control in ("<s>", "[INST]", "[/INST]", "<<SYS>>"):
            assert control not in r["formatted"]


def test_order_ties_and_edges(spark):
    rows = [(None, 2, "user", "b"), (None, 1, "user", "a"), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "system", "first"),
        (2, 0, "assistant", "w " * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["back"]] for r in chat.format_conversations(df).select("conv_id", chat.read_back(F.col("formatted"))
        .alias("back")).collect()}
    assert got[None] == [("user", "a"), ("user", "b")] and got[1] == [("system", "first"), ("user", "a"), ("user", "a"), ("user", "b")]
    d = {r["conv_id"]: r for r in chat.digest(chat.format_conversations(df)).collect()}
    assert d[2]["loss_chars"] == 100_000 and d[1]["n_turns"] == 4
    assert chat.digest(chat.format_conversations(df.limit(0))).collect() == []


def test_ties_are_ordered_by_the_texts_as_they_are(spark):
    rows = [(1, 0, "user", "<s>"), (1, 0, "user", "<a"), (1, 0, "user", "\\"), (1, 0, "user", "]")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = chat.format_conversations(df).select(chat.read_back(F.col("formatted")).alias("back")).first()["back"]
    assert [t["text"] for t in back] == sorted(r[3] for r in rows)


def test_plan_is_native(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = chat.digest(chat.format_conversations(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
