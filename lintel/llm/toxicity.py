"""Toxicity by multiple-instance learning.

A document is a bag of sentences and is toxic if any of them is. A linear model gives each sentence
a probability, noisy-or combines them, p(document) = 1 - (1 - leak) * prod(1 - p(sentence)), and the
model is trained from document labels alone. The sentence probabilities then say where the offence is.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import spread, tidy

#: The model is fitted on at most so many labelled documents, chosen by a hash of their id ...
TRAIN_DOCS = 8000
#: ... of at most so many characters, which bounds what the driver holds ...
TRAIN_CHARS = 32_000_000
#: ... and on the features in at least MIN_DOCS of them, at most MAX_FEATURES, those that tell the labels apart best.
MIN_DOCS, MAX_FEATURES = 3, 3000
#: Features are known by a hash to so many values, which bounds what the driver holds while it counts them.
BUCKETS = 1 << 20
#: Beginnings of words of these lengths are features beside the words, since insults are inflected.
PREFIXES = range(4, 9)
#: Words whose weight a worker remembers.
CACHE_WORDS = 100_000
STEPS, RATE, L1, L2 = 250, 0.15, 2e-4, 1e-5
THRESHOLD = 0.3

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> tuple[int, ...]:
    """The word itself and its beginnings, hashed."""
    return tuple({zlib.crc32(f.encode()) % BUCKETS for f in (word, *(f"{word[:k]}*" for k in PREFIXES if k < len(word)))})


class Remembered(dict):
    """A bounded cache of what is worked out for words."""

    def __init__(self, work):
        super().__init__()
        self.work = work

    def __missing__(self, word: str):
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = found = self.work(word)
        return found


@dataclass(frozen=True)
class Model:
    weights: dict[int, float]
    bias: float
    leak: float

    def words(self) -> Remembered:
        """Weight of a word, the sum over its features."""
        return Remembered(lambda w: sum(self.weights.get(f, 0.0) for f in sorted(features(w))))

    def scores(self, text: str, words: Remembered) -> tuple[float, list[tuple[int, int, float]]]:
        """Score of the text, and (start, end, probability) of each sentence that is likelier toxic than not.

        words: self.words(), kept between calls."""
        spans, plain, low = [], 0, text.lower()
        if len(low) != len(text):  # a few capitals change their length
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        keep = 1 - self.leak
        for m in SENTENCE.finditer(low):
            if z := sum(sorted(map(words.__getitem__, set(WORD.findall(m[0]))))):
                p = 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + z))))
                keep *= 1 - p
                if p >= 0.5:
                    spans.append((m.start(), m.end(), p))
            else:
                plain += 1
        keep *= (1 - 1 / (1 + math.exp(-self.bias))) ** plain
        return min(1.0, max(0.0, 1 - keep)), spans


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS, chars: int = TRAIN_CHARS) -> list[tuple[str, int]]:
    """At most `limit` (text, label) rows, not held out, of at most `chars` characters altogether, in the order of a
    hash of doc_id; a longer first text is taken alone. A document labelled twice counts as its highest label, of
    rows that repeat a doc_id the least text counts."""
    chosen = (
        labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.max(F.length("text")).alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    total = np.cumsum([r["n"] for r in order])
    some = order[: max(1, int((total <= chars).sum()))]
    if not some:
        return []
    wanted = docs.sparkSession.createDataFrame([(r["doc_id"], r["toxic"]) for r in some], "doc_id long, toxic int")
    rows = texts.join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return [(r["text"], r["toxic"]) for r in sorted(rows.toLocalIterator(), key=lambda r: r["doc_id"])]


def fit(rows: list[tuple[str, int]]) -> Model:
    """Proximal gradient (Adam) on the noisy-or likelihood; without both labels every score is the leak."""
    y = np.array([t for _, t in rows], float)
    if not len(y) or y.min() == y.max():
        return Model({}, -30.0, float(y.mean()) if len(y) else 0.0)
    known = Remembered(features)
    seen, toxic = np.zeros(BUCKETS, np.int32), np.zeros(BUCKETS, np.int32)
    for (text, _), t in zip(rows, y, strict=True):
        of = np.array(sorted({f for w in set(WORD.findall(text.lower())) for f in known[w]}), np.int64)
        seen[of] += 1
        if t:
            toxic[of] += 1
    base = y.mean()
    gain = np.where(seen >= MIN_DOCS, np.abs(toxic - seen * base) / np.sqrt(seen * base * (1 - base) + 1), -1)
    words = np.sort(np.argsort(-gain, kind="stable")[:MAX_FEATURES])
    words = words[gain[words] >= 0]
    index = {f: i for i, f in enumerate(words.tolist())}
    columns, sentence_of, doc_of = array("i"), array("i"), array("i")
    for d, (text, _) in enumerate(rows):
        for s in SENTENCE.findall(text.lower()):
            of = sorted({index[f] for w in set(WORD.findall(s)) for f in known[w] if f in index})
            sentence_of.extend([len(doc_of)] * len(of))
            columns.extend(of)
            doc_of.append(d)
    col, row, doc = np.array(columns), np.array(sentence_of), np.array(doc_of)
    n_docs, n_rows, n_words = len(y), len(doc), len(words)
    w, bias, leak = np.zeros(n_words + 2), 0, 0
    w[n_words], w[n_words + 1] = -6.0, -4.0  # bias of a sentence, logit of the leak
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        z = np.clip(w[n_words] + np.bincount(row, w[col], n_rows), -30, 30)
        p = 1 / (1 + np.exp(-z))
        leak = 1 / (1 + np.exp(-w[n_words + 1]))
        clean = np.clip((1 - leak) * np.exp(np.bincount(doc, np.log1p(-p), n_docs)), 1e-9, 1 - 1e-9)  # p(document is clean)
        outer = np.where(y > 0, -clean / (1 - clean), 1.0) / n_docs  # d loss / d -log(clean)
        g_row = outer[doc] * p
        g = np.concatenate([np.bincount(col, g_row[row], n_words) + L2 * w[:n_words], [g_row.sum(), (outer * leak).sum()]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w[:n_words] = np.sign(w[:n_words]) * np.maximum(np.abs(w[:n_words]) - RATE * L1 * 10, 0)
    bias = float(w[n_words])
    return Model({x: float(a) for x, a in zip(words.tolist(), w[:n_words], strict=True) if abs(a) > 0.05}, bias, float(leak))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of docs and `toxicity` (0 to 1), `offences` array<struct<start,end,p>> (code points).

    Columns of these names in docs are replaced. Only `text` is looked at; null and empty texts have the score of a document without sentences."""
    docs = docs.drop("toxicity", "offences")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    offence = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])
    schema = T.StructType(list(docs.schema.fields)).add("toxicity", "double").add("offences",
        T.ArrayType(T.StructType().add("start", "long").add("end", "long").add("p", "double")))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = sent.value.words()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                found = [sent.value.scores(t or "", words) for t in part.column(at).to_pylist()]
                spans = [[{"start": a, "end": b, "p": p} for a, b, p in s] for _, s in found]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([x for x, _ in found], pa.float64()), pa.array(spans, pa.list_(offence))],
                    names=[*part.schema.names, "toxicity", "offences"])

    return spread(docs).mapInArrow(tidy(run), schema)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    return fit(training_rows(docs, labels))
