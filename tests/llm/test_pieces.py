"""Piece encoding against a plain dynamic programme; decoding gives every text back."""

import os
import random

import pytest

from lintel.llm import pieces
from lintel.llm.pieces import MARK, MODEL_PATH, Codec, Model, encode

TINY = Model(("<unk>", "a", "b", "ab", "aba", f"{MARK}a", MARK, f"{MARK}{MARK}", "ba", "<0x41>"), (0, -2.0, -2.5, -3.0, -4.0, -2.2, -1.0, -1.5, -3.5, 0),
    (2, 1, 1, 1, 1, 1, 1, 1, 1, 6))


def best_score(model, text):
    """Score of the best segmentation, by trying every piece at every place."""
    usable = {p: s for p, s, k in zip(model.pieces, model.scores, model.kinds) if k in (1, 4)}
    unknown = min(usable.values()) - 10
    best = [0.0] + [None] * len(text)
    longest = max(map(len, usable))
    for e in range(1, len(text) + 1):
        found = [best[b] + usable[text[b:e]] for b in range(max(0, e - longest), e) if text[b:e] in usable]
        if text[e - 1] not in usable:
            found.append(best[e - 1] + unknown)
        best[e] = max(found)
    return best[-1]


def score(codec, ids):
    m = codec.model
    low = codec.unknown_score
    return sum(m.scores[i] if m.kinds[i] in (1, 4) else 0 for i in ids), low


@pytest.mark.parametrize("seed", range(3))
def test_tiny_model_is_optimal(seed):
    codec, rng = Codec(TINY), random.Random(seed)
    for _ in range(400):
        text = "".join(rng.choice("aab ") for _ in range(rng.randint(0, 40)))
        ids = codec.encode(text)
        assert codec.decode(ids) == text
        if text:
            marked = (" " + text).replace(" ", MARK)
            assert abs(sum(TINY.scores[i] for i in ids) - best_score(TINY, marked)) < 1e-9


@pytest.mark.skipif(not os.path.exists(MODEL_PATH), reason="no model file")
def test_model_file_against_brute_force_and_round_trip(spark):
    model = Model.load()
    codec, rng = Codec(model), random.Random(2)
    alphabet = "the and of ing tion aeiou é ß 日本 \n\t▁ 😀 xyz.,!? \uffff\ufffe\ue000"
    for n in range(200):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60)))
        ids = codec.encode(text)
        assert codec.decode(ids) == text
        plain = "".join(c for c in text if c.isascii() and c not in "\n\t")
        if plain:
            assert abs(sum(model.scores[i] for i in codec.encode(plain)) - best_score(model, (" " + plain).replace(" ", MARK))) < 1e-6
        word = text.replace(MARK, pieces.LITERAL).replace(" ", MARK)
        codec.cache.clear()
        codec._encode_words([word])
        assert codec._encode_long(word) == codec.cache[word]
    for text in ("a\uffffb", "\uffff", "a▁b\uffff▁", "\U0010ffff ▁ \ue000"):
        assert codec.decode(codec.encode(text)) == text
    texts = [(1, None), (2, ""), (5, "a\uffff▁b"), (None, "a b"), (3, "x" * 30_000), (3, "word " * 30_000), (4, "  two  blanks ▁ \x00 end ")]
    df = spark.createDataFrame([(i, t, "z") for i, t in texts], "doc_id long, text string, ids string")
    got = encode(df, model).collect()
    assert len(got) == 7 and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in got)
    assert sorted(codec.decode(r["ids"]) for r in got) == sorted(t or "" for _, t in texts)
    assert encode(df.limit(0), model).collect() == []
