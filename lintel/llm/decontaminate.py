"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

The CGK random walk copies a string into a longer one, advancing by a random bit that depends on the
step and the character; strings at a small edit distance come to a small Hamming distance. The item
and the item-sized window of a document are embedded in sections, each walked afresh, because a walk
that has lost step with its twin rarely finds back within a long item. A section's key is a sample of
its walk's symbols. In each of many repetitions (walks, and samples of a walk) a section of a document
and one of an item that have the same key share a bucket, and the item is a candidate there. Candidates
are verified exactly (Myers): a match is an edit distance of at most `rate` times the item's length.

Items have sections at every character, documents at every `stride`-th, so that some sections of a
copied passage always begin at the same character in both. How many walks are needed for the target
recall is measured on edited passages of a bounded sample of the items. Symbols sampled for a key grow
with the logarithm of the items' size, so that sections meet by chance as rarely for a large benchmark.

The documents are read once. Their keys are looked up in a Bloom filter of the items' keys, which has a
fixed greatest size and is all that is broadcast; what passes it is joined with the items' keys by a
shuffle, together with the stretch of text that an item can cover there. A larger benchmark fills the
filter, so that more rows are shuffled, but nothing else changes. Items never go through the driver.

Items too short for sections (under EXACT characters) are looked for exactly, at word borders.
"""

from __future__ import annotations

import random
import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, spread, tidy, written
from .shingles import mix

#: Items of fewer characters are looked for exactly.
EXACT = 16
#: Kinds of items: least characters, steps of a walk (two a character on average, at most 56), stride of the documents' sections.
KINDS = ((80, 44, 8), (40, 40, 4), (EXACT, 24, 2))
#: Samples that are taken from one walk, and the fewest symbols of a sample.
PER_WALK, SYMBOLS = 8, 12
#: Walks are added until this share of passages of the least length with all edits allowed is found, at most MAX_WALKS.
RECALL, MAX_WALKS = 0.995, 24
#: Items, and edited passages of them, on which the walks are counted.
SAMPLE_ITEMS, TRIALS = 256, 1500
#: The filter has at least FILTER_BITS bits a key, of which six are set, but at most 1 << MOST_BITS in all (64 MB).
FILTER_BITS, MOST_BITS = 32, 29
#: Bits of a key, and of a hash of it, from these on are its places in the filter.
SHIFTS = (0, 17, 34)
#: Characters of the q-grams that a candidate must share before it is verified.
GRAM = 5
#: Characters of documents that are embedded together.
CHUNK = 1 << 17
#: Sections that are walked together, few enough for the processor's cache.
SECTIONS = 1 << 13

#: Which characters are blanks to str.split; none is behind the last of the table.
_BLANK = np.array([chr(c).isspace() for c in range(0x3001)] + [False])

#: A factor for each step of a walk.
_ODD = mix(np.arange(1, 57, dtype=np.uint64)) | np.uint64(1)

SCHEMA = "doc_id long, item_id long, start long, end long, distance long"
#: A stretch of a document with sections that passed the filter: begin and text as in the document, places of keys in its normal form.
_FOUND = "row string, doc_id long, hash long, start long, text string, keys array<struct<key:long,low:int,high:int>>"


@dataclass(frozen=True)
class Settings:
    """A passage matches an item if their edit distance is at most rate * length of the item.

    Lower case and single blanks are compared."""

    rate: float = 0.1
    recall: float = RECALL

    def edits(self, size: int) -> int:
        return int(size * self.rate + 1e-9)


def normal(text: str) -> str:
    """Lower case, single blanks; characters whose lower case is longer are kept."""
    low = text.replace("Σ", "σ").lower()  # the one letter whose lower case depends on its place
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text.replace("Σ", "σ"))
    return " ".join(low.split())


def offsets(text: str, places: list[int]) -> list[int]:
    """The places of normal(text) as places of text. Works through the text in blocks, whatever its length."""
    out, done, spaced = [len(text)] * len(places), 0, True
    for begin in range(0, len(text), CHUNK):
        codes = np.frombuffer(text[begin : begin + CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
        blank = _BLANK.take(np.minimum(codes, len(_BLANK) - 1))
        before = np.concatenate([[spaced], blank[:-1]])
        kept = np.flatnonzero(~blank | ~before)  # words, and the first blank after each
        for k, p in enumerate(places):
            if done <= p < done + len(kept):
                out[k] = begin + int(kept[p - done])
        done, spaced = done + len(kept), bool(blank[-1])
    return out


# embedding ------------------------------------------------------------------------------------


def symbols(text: str) -> np.ndarray:
    """The characters as one of 256 classes each."""
    return (np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) * np.uint32(2654435761) >> np.uint32(24)).astype(np.uint8)


@dataclass(frozen=True)
class Walks:
    """Walks and samples for the items of one kind."""

    least: int
    steps: int
    stride: int
    walks: int
    sampled: int

    @property
    def samples(self) -> int:
        return self.walks * PER_WALK

    def room(self, size: int) -> int:
        """Sections of an item of so many characters: the last ones may run out of it by an eighth of their steps."""
        return max(1, size - self.steps // 2 + self.steps // 8)

    def keys(self, codes: np.ndarray, start: np.ndarray) -> Iterator[np.ndarray]:
        """For each sample the keys of the sections that begin at `start`. codes end in `steps` further symbols."""
        now, product = np.empty(len(start), np.uint64), np.empty(len(start), np.uint64)
        for walk, (forward, sampled) in enumerate(_drawn(self)):
            at, text = start.astype(np.int64), forward.take(codes)
            totals = [np.full(len(start), (1 + walk * PER_WALK + sample + (self.least << 16)) * 0x9E3779B97F4A7C15 % (1 << 64), np.uint64) for sample in range(PER_WALK)]
            for step in range(self.steps):
                text.take(at, out=now, mode="clip")
                # a symbol's word is random, and odd multiples of it tell the steps apart
                np.multiply(now, _ODD[step], out=product)
                for sample in sampled[step]:
                    totals[sample] += product
                now >>= np.uint64(8 + step)
                now &= np.uint64(1)
                at += now.view(np.int64)
            yield from map(mix, totals)


@lru_cache(64)
def _drawn(walks: Walks) -> list[tuple[np.ndarray, list[list[int]]]]:
    """For each walk a word for each symbol, which holds the symbol and whether it advances the walk at each step, and
    for each step the samples that it is in. More walks begin like fewer."""
    rng, out = np.random.default_rng((5, walks.least, walks.steps)), []
    for _ in range(walks.walks):
        forward = rng.integers(0, 1 << 56, 256, np.uint64) << np.uint64(8) | np.arange(256, dtype=np.uint64)
        picks = [set(rng.permutation(walks.steps)[: walks.sampled].tolist()) for _ in range(PER_WALK)]
        out.append((forward, [[sample for sample, pick in enumerate(picks) if step in pick] for step in range(walks.steps)]))
    return out


def exact_keys(codes: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """Keys of the strings of `size` characters that begin at `start`."""
    key = np.full(len(start), size, np.uint64)
    for k in range(size):
        key = mix(key) + np.take(codes, start + k, mode="clip")
    return mix(key)


def edited(rng: random.Random, text: str, edits: int) -> str:
    """text after so many edits, of all kinds or of one."""
    kind, out = rng.choice(("sdi", "sdi", "s", "d", "i")), list(text)
    for _ in range(edits):
        p, k = rng.randrange(len(out)), rng.choice(kind)
        if k == "d" and len(out) > 1:
            del out[p]
        else:
            out[p : p + (k == "s")] = chr(rng.randrange(97, 123))
    return "".join(out)


def planned(kind: tuple[int, int, int], items: list[str], chars: int, settings: Settings) -> Walks:
    """Walks for the items of a kind, of `chars` characters altogether: as many as find `recall` of the passages that
    are made of a sample of them with all edits that are allowed. The sample is cut to the least length of the kind:
    longer items have more sections and are found more often."""
    least, steps, stride = kind
    most = Walks(least, steps, stride, MAX_WALKS, min(steps // 2, max(SYMBOLS, chars.bit_length() + 4)))
    rng = random.Random(len(items))
    pad = np.zeros(steps, np.uint8)
    tries = [rng.choice(items) for _ in range(TRIALS)]
    copies = [edited(rng, t, settings.edits(len(t))) for t in tries]
    # both sides one after another; a key is told apart by the trial it belongs to
    sizes, lengths = [most.room(len(t)) for t in tries], [len(c) for c in copies]
    skip = [rng.randrange(stride) for _ in tries]
    a = np.concatenate([np.concatenate([symbols(t), pad]) for t in tries])
    b = np.concatenate([np.concatenate([symbols(c), pad + 1]) for c in copies])
    at_a = np.cumsum([0, *(len(t) + steps for t in tries)])
    at_b = np.cumsum([0, *(n + steps for n in lengths)])
    start_a = np.concatenate([at_a[k] + np.arange(n) for k, n in enumerate(sizes)])
    start_b = np.concatenate([at_b[k] + np.arange(skip[k], max(n, skip[k] + 1), stride) for k, n in enumerate(lengths)])
    of_a, of_b = np.searchsorted(at_a, start_a, "right").astype(np.uint64), np.searchsorted(at_b, start_b, "right").astype(np.uint64)
    first = np.full(TRIALS, MAX_WALKS * PER_WALK)
    for sample, (x, y) in enumerate(zip(most.keys(a, start_a), most.keys(b, start_b), strict=True)):
        hit = np.isin(mix(y + of_b * np.uint64(0x9E3779B97F4A7C15)), mix(x + of_a * np.uint64(0x9E3779B97F4A7C15)))
        which = np.unique(of_b[hit]).astype(np.int64) - 1
        first[which] = np.minimum(first[which], sample)
        if (first < MAX_WALKS * PER_WALK).mean() >= settings.recall and sample % PER_WALK == PER_WALK - 1:
            return Walks(least, steps, stride, sample // PER_WALK + 1, most.sampled)
    return most


# verification ---------------------------------------------------------------------------------


def distance(item: str, text: str) -> tuple[int, int, int]:
    """Least edit distance of item to a substring of text, with the substring's start and end."""
    at = text.find(item)
    if at >= 0:
        return 0, at, at + len(item)
    d, end = _myers(item, text)
    back, length = _myers(item[::-1], text[max(0, end - len(item) - d) : end][::-1], first_at_start=True)
    return d, end - length, end


def near_enough(item: str, text: str, edits: int) -> bool:
    """False only if no substring of text is within the edits: each edit spoils at most GRAM of the item's q-grams."""
    need = len(item) - GRAM + 1 - GRAM * edits
    if need <= 0:
        return True
    have = {text[k : k + GRAM] for k in range(len(text) - GRAM + 1)}
    return sum(item[k : k + GRAM] in have for k in range(len(item) - GRAM + 1)) >= need


def _myers(item: str, text: str, first_at_start: bool = False) -> tuple[int, int]:
    """Bit-parallel matching: least distance of item to a substring that ends at the returned place (the first such).

    first_at_start: the substring begins where the text begins."""
    m = len(item)
    peq: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        peq[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv) & full, pv & xh
        if ph & top:
            score += 1
        if mh & top:
            score -= 1
        ph = ph << 1 & full | first_at_start
        mh = mh << 1 & full
        pv, mv = mh | ~(xv | ph) & full, ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


def at_borders(item: str, text: str, low: int, high: int) -> int:
    """The first place from low to high where item stands in text as whole words, or -1."""
    at = text.find(item, low)
    while 0 <= at <= high:
        if (at == 0 or text[at - 1] == " ") and text[at + len(item) : at + len(item) + 1] in ("", " "):
            return at
        at = text.find(item, at + 1)
    return -1


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


# index of the items ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Plan:
    """What the workers need to know besides the filter: walks, lengths of exact items, reach of a section."""

    kinds: tuple[Walks, ...]
    exact: tuple[int, ...]
    #: Characters before and after the begin of a section that an item of each kind can cover.
    reach: tuple[int, ...]

    def kind(self, size: int) -> int:
        return next(k for k, w in enumerate(self.kinds) if size >= w.least)


def _texts(items: DataFrame) -> DataFrame:
    """(n, item_id, text): items in normal form with a number each, equal rows once; null ids and empty texts left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [normal(t) for t in batch.column(1).to_pylist()]
            made = pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["item_id", "text"])
            yield made.filter(pa.array([bool(t) for t in texts], pa.bool_()))

    rows = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    return written(rows.mapInArrow(tidy(run), "item_id long, text string").distinct().withColumn("n", F.monotonically_increasing_id()), "items")


def _plan(texts: DataFrame, settings: Settings) -> Plan:
    size = F.length("text")
    exact = sorted(r[0] for r in texts.select(size.alias("s")).where(F.col("s") < EXACT).distinct().collect())
    kinds, reach, above = [], [], None
    for kind in KINDS:
        mine = texts.where(size >= kind[0])
        mine = mine if above is None else mine.where(size < above)
        above = kind[0]
        chars, longest = mine.agg(F.sum(size), F.max(size)).first()
        if chars:
            sample = [r["text"] for r in mine.orderBy(F.xxhash64("text"), "text").limit(SAMPLE_ITEMS).select(F.substring("text", 1, kind[0]).alias("text")).collect()]
            kinds.append(planned(kind, sample, chars, settings))
            reach.append(longest + 2 * settings.edits(longest) + 2)
    return Plan(tuple(kinds), tuple(exact), tuple(reach))


def _item_keys(texts: DataFrame, plan: Plan) -> DataFrame:
    """(key, again, n, low, high): the first and the last section of item n that has the key; again: a hash of the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                codes = symbols(text)
                if len(text) < EXACT:
                    key, low, high = exact_keys(codes, np.zeros(1, np.int64), len(text)), np.zeros(1, np.int64), np.zeros(1, np.int64)
                else:
                    walks = plan.kinds[plan.kind(len(text))]
                    at = np.arange(walks.room(len(text)))
                    found = np.concatenate(list(walks.keys(np.concatenate([codes, np.zeros(walks.steps, np.uint8)]), at)))
                    key, low, high = bounds(found, np.tile(at, walks.samples))
                for k in range(0, len(key), 1 << 16):
                    part = slice(k, k + (1 << 16))
                    columns = (key[part].view(np.int64), mix(key[part]).view(np.int64), np.full(len(key[part]), n), low[part].astype(np.int32),
                        high[part].astype(np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "again", "n", "low", "high"])

    return written(texts.select("n", "text").mapInArrow(tidy(run), "key long, again long, n long, low int, high int"), "item-keys")


def bounds(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, with the least and the greatest place of each."""
    order = np.lexsort((at, key))
    key, at = key[order], at[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
    return key[first], at[first], at[np.append(first[1:], len(key))[: len(first)] - 1]


def _filter(keys: DataFrame) -> np.ndarray:
    """Bloom filter of the keys with six bits each, as bytes: a power of two of bits, at most 1 << MOST_BITS."""
    count = keys.count()
    power = min(MOST_BITS, max(18, (FILTER_BITS * max(count, 1) - 1).bit_length()))
    mask = F.lit((1 << power) - 1)
    spots = keys.select(F.explode(F.array(*(F.shiftrightunsigned(c, n).bitwiseAND(mask) for c in ("key", "again") for n in SHIFTS))).alias("p"))
    made = spots.groupBy(F.shiftright("p", 15).alias("bucket")).agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit(32767))).alias("bits"))
    out = np.zeros((1 << power) // 8, np.uint8)
    for row in made.toLocalIterator():
        out[row["bucket"] * 4096 : (row["bucket"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    return out


def held(bits: np.ndarray, key: np.ndarray, shift: int = 0) -> np.ndarray:
    """Is the bit set whose place the keys hold from `shift` on?"""
    byte = key >> np.uint64(3 + shift)
    byte &= np.uint64(len(bits) - 1)
    found, place = bits.take(byte.view(np.int64)), (key >> np.uint64(shift) if shift else key).astype(np.uint8)
    place &= np.uint8(7)
    found >>= place
    found &= np.uint8(1)
    return found.view(bool)


def passing(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Places of the keys that the filter may hold."""
    which = np.flatnonzero(held(bits, key))
    for again in (False, True):
        for n in SHIFTS:
            some = mix(key[which]) if again else key[which]
            which = which[held(bits, some, n)]
    return which


def met(bits: np.ndarray, keys: Iterator[np.ndarray], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of arrays of keys, each of the sections that begin at `at`, those that the filter may hold, and their sections.

    The first bit leaves few keys of each array; the other bits of all are looked up together."""
    few = [(key[which], at[which]) for key in keys for which in [np.flatnonzero(held(bits, key))]]
    key, begin = (np.concatenate(c) for c in zip(*few, strict=True))
    which = passing(bits, key)
    return key[which], begin[which]


# documents ------------------------------------------------------------------------------------


def found_sections(texts: list[str], bits: np.ndarray, plan: Plan) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each of the (normal) texts that has any: keys that passed the filter, place and reach of their sections."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    codes = symbols("\x00".join(texts) + "\x00" * (1 + max([w.steps for w in plan.kinds], default=EXACT)))
    got: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for walks, reach in zip(plan.kinds, plan.reach, strict=True):
        span = SECTIONS * walks.stride
        for begin in range(0, int(begins[-1]), span):
            at = np.arange(0, min(span, int(begins[-1]) - begin), walks.stride)
            key, at = met(bits, walks.keys(codes[begin : begin + span + walks.steps], at), at)
            got.append((key, at + begin, np.full(len(key), reach)))
    if plan.exact:
        blank = np.concatenate([[True], (codes == symbols(" ")[0])[:-1] | (codes == symbols("\x00")[0])[:-1]])
        at = np.flatnonzero(blank[: begins[-1]])
        for size in plan.exact:
            key = exact_keys(codes, at, size)
            which = passing(bits, key)
            got.append((key[which], at[which], np.full(len(which), EXACT + 1)))
    if not got:
        return {}
    key, at, reach = (np.concatenate(c) for c in zip(*got, strict=True))
    doc = np.searchsorted(begins, at, "right") - 1
    order = np.argsort(doc, kind="stable")
    cuts = np.flatnonzero(np.diff(doc[order])) + 1
    return {int(doc[w[0]]): (key[w], at[w] - begins[doc[w[0]]], reach[w]) for w in np.split(order, cuts) if len(w)}


def stretches(raw: str, text: str, key: np.ndarray, at: np.ndarray, reach: np.ndarray) -> Iterator[tuple[int, str, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """(start, text, keys) of the parts of a document (text: its normal form) that an item can cover; start and text
    as in the document, keys with their first and last section in the normal form of the part."""
    around = {(max(0, a - r), min(len(text), a + r)) for a, r in set(zip(at.tolist(), reach.tolist(), strict=True))}
    spans = [(a - (text[a : a + 1] == " "), b) for a, b in merged(list(around))]  # a blank at the begin would be lost
    places = offsets(raw, [p for span in spans for p in span])
    part = np.searchsorted([a for a, _ in spans], at, "right") - 1
    for k, (a, _) in enumerate(spans):
        mine = part == k
        yield places[2 * k], raw[places[2 * k] : places[2 * k + 1]], bounds(key[mine].view(np.int64), at[mine] - a)


def _found(docs: DataFrame, bits: np.ndarray, plan: Plan) -> DataFrame:
    """Stretches of the documents that hold keys of items, one pass over the documents."""
    sent = docs.sparkSession.sparkContext.broadcast((bits, plan))
    names = ("row", "doc_id", "hash", "start", "text")
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, plan = sent.value
        for batch in batches:
            sizes, k = batch.column("size").to_pylist(), 0
            while k < batch.num_rows:
                n, chars = k + 1, sizes[k]
                while n < batch.num_rows and chars + sizes[n] <= CHUNK:
                    chars, n = chars + sizes[n], n + 1
                rows, out = batch.slice(k, n - k), []
                raw = rows.column("text").to_pylist()
                clean = [normal(t) for t in raw]
                for d, sections in found_sections(clean, known, plan).items():
                    own = (uuid.uuid4().hex, rows.column("doc_id")[d].as_py(), rows.column("hash")[d].as_py())
                    out += [(*own, *stretch) for stretch in stretches(raw[d], clean[d], *sections)]
                if out:
                    columns = [pa.array(c, t) for c, t in zip(zip(*(o[:5] for o in out), strict=True), kinds, strict=True)]
                    key, low, high = (np.concatenate(c) for c in zip(*(o[5] for o in out), strict=True))
                    places = pa.StructArray.from_arrays([pa.array(key), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], ["key", "low", "high"])
                    ends = np.cumsum([0, *(len(o[5][0]) for o in out)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(ends), places)], names=[*names, "keys"])
                k = n

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), F.length("text").cast("long").alias("size"),
        "text").where("size > 0")
    return written(spread(rows).mapInArrow(tidy(run), _FOUND), "stretches")


def _verified(found: DataFrame, keys: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """(row, doc_id, hash, item_id, start, end, distance): the best passage of each item in each document row."""
    met = found.select("row", "start", F.explode("keys").alias("k")).select("row", "start",
        "k.*").join(keys.drop("again").withColumnsRenamed({"low": "first", "high": "last"}), "key")
    pairs = met.groupBy("row", "start", "n").agg(F.min(F.col("low") - F.col("last")).alias("low"), F.max(F.col("high") - F.col("first")).alias("high"))
    rows = pairs.join(found.drop("keys"), ["row", "start"]).join(texts.withColumnRenamed("text", "item"), "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits: list[tuple[int, int, int, int]] = []
            columns = (batch.column(c).to_pylist() for c in ("text", "item", "low", "high", "start"))
            for k, (text, item, low, high, start) in enumerate(zip(*columns, strict=True)):
                clean, e = normal(text), settings.edits(len(item))
                if len(item) < EXACT:
                    at = at_borders(item, clean, max(0, low), high)
                    d, s, t = (0, at, at + len(item)) if at >= 0 else (e + 1, 0, 0)
                else:
                    at = max(0, low - e)
                    part = clean[at : high + len(item) + 2 * e]
                    d, s, t = distance(item, part) if near_enough(item, part, e) else (e + 1, 0, 0)
                    s, t = s + at, t + at
                if d <= e:
                    first, last = offsets(text, [s, t - 1])
                    hits.append((k, start + first, start + last + 1, d))
            own = [batch.column(c).take(pa.array([h[0] for h in hits], pa.int64())) for c in ("row", "doc_id", "hash", "item_id")]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array([h[k] for h in hits], pa.int64()) for k in (1, 2, 3))],
                names=["row", "doc_id", "hash", "item_id", "start", "end", "distance"])

    columns = ("row", "doc_id", "hash", "item_id", "text", "item", "low", "high", "start")
    hits = rows.select(*columns).mapInArrow(tidy(run), "row string, doc_id long, hash long, item_id long, start long, end long, distance long")
    best = F.min(F.struct("distance", "start", "end")).alias("b")
    return hits.groupBy("row", "doc_id", "hash", "item_id").agg(best).select("row", "doc_id", "hash", "item_id", "b.start", "b.end", "b.distance")


def _matches(docs: DataFrame, items: DataFrame, settings: Settings) -> DataFrame | None:
    """_verified of all, materialised; None if there is nothing to look for."""
    with scratch(docs.sparkSession) as keep:
        texts = _texts(items)
        plan = _plan(texts, settings)
        if not plan.kinds and not plan.exact:
            return None
        keys = _item_keys(texts, plan)
        return keep(written(_verified(_found(docs, _filter(keys), plan), keys, texts, settings), "matches"))


def contaminations(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:  # noqa: B008
    """(doc_id, item_id, start, end, distance): the best passage of every item found in every document.

    Null and empty texts match nothing; rows with a null doc_id are reported under null, repeated
    rows repeatedly. Items with a null id or without text are left out. Items that share an id are
    searched for apart, the best one counts for each document row. Further columns are ignored;
    empty tables give no rows."""
    found = _matches(docs, items, settings)
    return docs.sparkSession.createDataFrame([], SCHEMA) if found is None else found.drop("row", "hash")


def clean_rows(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:  # noqa: B008
    """docs, with all columns, without the rows that hold a passage of an item.

    Rows are told by doc_id and a hash of the text, so that of rows which share a doc_id only those with
    such a text go. Null and empty texts stay; empty tables change nothing."""
    found = _matches(docs, items, settings)
    if found is None:
        return docs
    gone = written(found.select("doc_id", "hash").distinct(), "contaminated")
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["doc_id"]) & (F.xxhash64(docs["text"]) == gone["hash"]), "left_anti")
