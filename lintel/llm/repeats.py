"""Removal of repeated passages with suffix arrays.

Each byte covered by a string of `size` bytes that also starts in a document with a smaller doc_id
goes. Common prefixes come from threshold-bounded interval expansion: on the Burrows-Wheeler transform
of a block of text, intervals of equal prefixes are extended backwards, breadth first, which yields
the longest common prefixes of neighbouring suffixes by increasing value; it stops at `size`, and
what is still undivided then are groups of equal strings.

One suffix array over all texts is not needed to find equal strings of `size` bytes, as long as equal
ones meet in one block. Every window of that many bytes has an anchor, its smallest hashed k-gram,
which depends on the window alone. Runs of windows with one anchor go to the block of the anchor's hash:

1. Texts are packed into batches of bounded size, which are written once.
2. Batches send the hashes of their anchors, once each; hashes in a single document are done with.
3. Batches send the byte strings of the other runs, equal ones once, to blocks; a block finds the
   smallest doc_id that each window starts in, and returns it.
4. Batches mark what is covered.

Messages are sent by packs, a few batches that one task made, so that there are as many as packs times blocks; and
groups and blocks are as many as keep them small, but no more than a multiple of the shuffle partitions, so that
messages grow in proportion to the input. Beyond that a group or block is worked through in parts.

Anchors in very many documents would overload a block by their differing surroundings, so their runs
are sent window by window, dealt by the window's own hash. Messages are compressed arrays, a row for
each pack and block.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, shuffle_partitions, spread, tidy, written
from .shingles import _SYMBOL, mix, powers

#: Bytes of a k-gram; long enough to be rare by chance.
GRAM = 20
#: Bytes of text in a batch; a longer text is a batch of its own.
BATCH_BYTES = 3 << 20
#: Batches of a pack, and groups or blocks at most for each shuffle partition.
PACK, MOST_PARTS = 4, 256
#: Entries that a step-2 group, bytes that a block should have at most.
GROUP_ENTRIES, BLOCK_BYTES = 2_000_000, 2 << 20
#: Bytes of a part of a block that are sorted at a time, bytes of a batch that are hashed at a time.
PART_BYTES, STRIDE = 1 << 17, 1 << 14
#: Anchors in more documents than this are dealt by window.
HOT_DOCS = 20_000
HASH_BYTES = 6


@dataclass(frozen=True)
class Settings:
    size: int = 50
    hot: int = HOT_DOCS


# messages -------------------------------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as byte planes, compressed."""
    out = [np.array([len(a) for a in arrays], np.int64).tobytes()]
    for a in arrays:
        wide = np.ascontiguousarray(a)
        out.append(wide.view(np.uint8).reshape(len(a), wide.itemsize).T.tobytes() if wide.itemsize > 1 else wide.tobytes())
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(raw, np.int64, len(kinds))
    out, at = [], 8 * len(kinds)
    for n, kind in zip(sizes.tolist(), map(np.dtype, kinds), strict=True):
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind) if kind.itemsize > 1 else planes.reshape(-1))
        at += n * kind.itemsize
    return out


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (count[0] of them), start[1], ..."""
    ends = np.cumsum(count)
    return np.repeat(start - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


# runs of a batch ------------------------------------------------------------------------------


@dataclass
class Runs:
    """Runs of windows with one anchor: document, first window, number of windows, hash of the anchor."""

    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray
    hash: np.ndarray

    def take(self, which: np.ndarray) -> Runs:
        return Runs(self.doc[which], self.start[which], self.count[which], self.hash[which])


def sums(raw: np.ndarray) -> np.ndarray:
    out, power = np.zeros(len(raw) + 1, np.uint64), powers(len(raw))
    for k in range(0, len(raw), STRIDE):
        part = _SYMBOL[raw[k : k + STRIDE]]
        part *= power[k : k + STRIDE]
        part[:1] += out[k : k + 1]
        np.cumsum(part, out=out[k + 1 : k + 1 + len(part)])
    return out


def substring_hash(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of raw[start:end], from sums(raw)."""
    return mix((total[end] - total[start]) * powers(len(total), "inverse")[start] + (end - start).astype(np.uint64))


def runs(total: np.ndarray, ends: np.ndarray, part: np.ndarray, size: int) -> Runs:
    """All runs of the texts that lie one after another up to `ends`; part: which texts take part."""
    empty = np.zeros(0, np.int64)
    n = len(total) - 1
    if n < size:
        return Runs(empty, empty, empty, empty.view(np.uint64))
    begins = np.concatenate([[0], ends[:-1]])
    inverse, width, last = powers(n + 1, "inverse"), size - GRAM + 1, n - size + 1
    places, hashes = [], []
    # a stride at a time, so that what is worked on stays in the processor's cache
    for k in range(0, last, STRIDE):
        low, high = max(k - 1, 0), min(k + STRIDE, last)  # windows; the one before tells whether an anchor is new
        to = high + width - 1
        gram = total[low + GRAM : to + GRAM] - total[low:to]
        gram *= inverse[low:to]
        gram += np.uint64(GRAM)
        gram = mix(gram)
        v = gram >> np.uint64(32)
        v <<= np.uint64(32)
        v |= np.arange(len(v), dtype=np.uint64)
        have = 1
        while have * 2 <= width:
            v, have = np.minimum(v[:-have], v[have:]), have * 2
        if have < width:
            v = np.minimum(v[: len(v) - (width - have)], v[width - have :])
        new = np.concatenate([[k == 0], v[1:] != v[:-1]])
        new[begins[slice(*np.searchsorted(begins, [k, high]))] - low] = True
        at = np.flatnonzero(new)
        places.append(at + low)
        hashes.append(gram[(v[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)])
    start, h = np.concatenate(places), np.concatenate(hashes)
    doc = np.repeat(np.arange(len(ends)), np.diff(np.searchsorted(start, np.append(begins, n))))
    limit = (ends - size + 1)[doc]
    inside = (start < limit) & part[doc]
    start, h, doc, limit = start[inside], h[inside], doc[inside], limit[inside]
    return Runs(doc, start, np.minimum(limit, np.append(start[1:], n)) - start, h >> np.uint64(64 - 8 * HASH_BYTES))


class Batch:
    """Texts of one batch as they were packed."""

    def __init__(self, blob: bytes, settings: Settings):
        ids, known, sizes, self.raw = unpack(blob, np.int64, np.uint8, np.int64, np.uint8)
        self.settings, self.ids, self.known, self.ends = settings, ids, known > 0, np.cumsum(sizes)
        self.sizes = sizes
        self.total = sums(self.raw)
        self.runs = runs(self.total, self.ends, known > 0, settings.size)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashes, ascending, and in how many documents of the batch each occurs."""
        h, d = self.runs.hash, self.runs.doc
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])[: len(h)]
        return np.unique(h[new], return_counts=True)

    def segments(self, shared: np.ndarray, hot: np.ndarray) -> Segments:
        """The byte strings of runs with shared anchors; those with hot ones window by window."""
        size = self.settings.size
        if not len(shared) or not len(self.runs.hash):
            some = np.zeros(0, np.int64)
            r = self.runs.take(some)
        else:
            at = np.searchsorted(shared, self.runs.hash)
            at[at == len(shared)] = 0
            mine = shared[at] == self.runs.hash
            r = self.runs.take(np.flatnonzero(mine))
            busy = hot[at[mine]] > 0
            if busy.any():
                b = r.take(np.flatnonzero(busy))
                s = ranges(b.start, b.count)
                alone = Runs(np.repeat(b.doc, b.count), s, np.ones(len(s), np.int64), substring_hash(self.total, s, s + size) >> np.uint64(64 - 8 * HASH_BYTES))
                r = r.take(np.flatnonzero(~busy))
                r = Runs(*(np.concatenate([getattr(r, f), getattr(alone, f)]) for f in ("doc", "start", "count", "hash")))
        key = substring_hash(self.total, r.start, r.start + r.count + size - 1)
        _, first, of = np.unique(key, return_index=True, return_inverse=True)
        return Segments(self, r, first, of)


@dataclass
class Segments:
    """Distinct byte strings of runs: of[i] is the string of run i, first[k] a run with string k."""

    batch: Batch
    runs: Runs
    first: np.ndarray
    of: np.ndarray

    def messages(self, blocks: int) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
        """For each block its strings, the least doc_id that they occur in, how far the greatest is from it,
        and a byte of the anchor's hash."""
        if not len(self.first):
            return
        ids = self.batch.ids[self.runs.doc]
        low, high = np.full(len(self.first), np.iinfo(np.int64).max), np.full(len(self.first), np.iinfo(np.int64).min)
        np.minimum.at(low, self.of, ids)
        np.maximum.at(high, self.of, ids)
        start, length = self.runs.start[self.first], self.runs.count[self.first] + self.batch.settings.size - 1
        h = self.runs.hash[self.first]
        block = (h % np.uint64(blocks)).astype(np.int64)
        for b, which in parts(block):
            text = self.batch.raw[ranges(start[which], length[which])]
            yield b, (text, length[which].astype(np.int32), low[which], (high - low)[which], (h[which] >> np.uint64(8 * HASH_BYTES - 8)).astype(np.uint8))

    def block_members(self, blocks: int) -> dict[int, np.ndarray]:
        return dict(parts((self.runs.hash[self.first] % np.uint64(blocks)).astype(np.int64)))


def parts(block: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each value with the ascending places where it stands."""
    order = np.argsort(block, kind="stable")
    cuts = np.flatnonzero(np.diff(block[order])) + 1
    for which in np.split(order, cuts):
        if len(which):
            yield int(block[which[0]]), which


# blocks ---------------------------------------------------------------------------------------


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Positions ordered by at least `depth` symbols (0 to 256), by prefix doubling from seven symbols;
    the last symbol must be 0. Also the boundaries of groups that agree on the first seven, and seven."""
    n, first = len(text), 7
    padded = np.concatenate([text, np.zeros(first, text.dtype)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(first):
        key = key << np.uint64(9) | padded[k : k + n]
    sa = np.argsort(key)
    sorted_key = key[sa]
    edge = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    begin = edge.copy()
    have = first
    while have < depth:
        group = np.cumsum(edge) - 1
        rank = np.empty(n + have, np.int64)
        rank[n:] = -1
        rank[sa] = group
        loose = ~edge
        loose[:-1] |= loose[1:]
        rows = np.flatnonzero(loose)  # rows of groups with more than one member
        if not len(rows):
            break
        pos = sa[rows]
        new = (group[rows].astype(np.uint64) << np.uint64(32)) | (rank[pos + have] + 1).astype(np.uint64)
        order = np.argsort(new)
        sa[rows] = pos[order]
        new = new[order]
        edge[rows] = np.concatenate([[True], new[1:] != new[:-1]])
        have *= 2
    return sa, begin, first


def boundaries(text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array, and before which of its rows the common prefix with the row above is under `size`.

    Intervals of strings of length l are extended backwards by each symbol that stands before them; an
    extension ends at a boundary, and where that was unknown its value is l and the extension goes on."""
    sa, known, l = suffix_array(text, size + 1)
    n = len(text)
    bwt = text[sa - 1]
    order = np.argsort(bwt, kind="stable")
    last_to_first = np.empty(n, np.int64)
    last_to_first[order] = np.arange(n)
    symbol = text[sa]
    lo = np.flatnonzero(known)
    hi = np.append(lo[1:], n)
    known = np.append(known, True)
    source = np.empty(n, np.int64)
    while l < size and len(lo):
        rows = ranges(lo, hi - lo)
        to = last_to_first[rows]
        source[to] = np.repeat(np.arange(len(lo)), hi - lo)
        to = np.sort(to)
        cut = np.concatenate([[True], (np.diff(to) != 1) | (source[to[1:]] != source[to[:-1]]) | (symbol[to[1:]] != symbol[to[:-1]])])
        begin = np.flatnonzero(cut)
        lo = to[begin]
        hi = to[np.append(begin[1:], len(to)) - 1] + 1
        fresh = ~known[hi]
        lo, hi = lo[fresh], hi[fresh]
        known[hi] = True
        l += 1
    return sa, known[:n]


def least_documents(text: np.ndarray, length: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """For the windows of all strings, one string after another, the least doc that an equal window has."""
    starts = np.cumsum(length) - length
    where = ranges(starts + np.arange(len(length)), length)
    joined = np.zeros(len(text) + len(length), np.uint16)
    joined[where] = text.astype(np.uint16) + 1
    sa, edge = boundaries(joined, size)
    spots = ranges(starts + np.arange(len(length)), length - size + 1)
    value = np.full(len(joined), np.iinfo(np.int64).max)
    value[spots] = np.repeat(doc, length - size + 1)
    begin = np.flatnonzero(edge)
    least = np.minimum.reduceat(value[sa], begin)
    out = np.empty(len(joined), np.int64)
    out[sa] = np.repeat(least, np.diff(np.append(begin, len(sa))))
    return out[spots]


def solve(messages: list[tuple[str, bytes]], size: int) -> list[tuple[str, bytes]]:
    """For each batch that sent strings to a block: the strings with an earlier window, and those windows' least doc_ids."""
    got = [(name, *unpack(blob, np.uint8, np.int32, np.int64, np.int64, np.uint8)) for name, blob in messages]
    text = np.concatenate([g[1] for g in got])
    length = np.concatenate([g[2] for g in got]).astype(np.int64)
    low, more, tag = (np.concatenate([g[k] for g in got]) for k in (3, 4, 5))
    high = low + more
    start = np.cumsum(length) - length
    total = sums(text)
    _, first, of = np.unique(substring_hash(total, start, start + length), return_index=True, return_inverse=True)
    least = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(least, of, low)
    windows = length[first] - size + 1
    at = np.cumsum(windows) - windows
    found = np.empty(int(windows.sum()), np.int64)
    # windows with different anchors differ, so that blocks are solved in parts, small enough for the processor's cache
    many = max(1, -(-int(length[first].sum()) // PART_BYTES))
    for _, which in parts(tag[first].astype(np.int64) % many):
        some = first[which]
        found[ranges(at[which], windows[which])] = least_documents(text[ranges(start[some], length[some])], length[some], least[which], size)
    earliest = np.minimum.reduceat(found, at) if len(at) else found
    out, k = [], 0
    for name, _, lengths, *_rest in got:
        mine = of[k : k + len(lengths)]
        back = np.flatnonzero(earliest[mine] < high[k : k + len(lengths)])
        if len(back):
            s = mine[back]
            out.append((name, pack(back.astype(np.int32), found[ranges(at[s], windows[s])])))
        k += len(lengths)
    return out


# steps ----------------------------------------------------------------------------------------

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_TOLD = "pack string, part int, shared binary, hot binary, n long"


def batches(docs: DataFrame) -> DataFrame:
    """(pack, batch, blob): the texts as UTF-8, packed; materialised, because the names are given at random."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        name, count, held = uuid.uuid4().hex, 0, 0

        def done() -> pa.RecordBatch:
            nonlocal name, count, held
            if count == PACK or held + size > PACK * BATCH_BYTES:
                name, count, held = uuid.uuid4().hex, 0, 0
            count, held = count + 1, held + size
            known = np.array([i is not None for i in ids], np.uint8)
            blob = pack(np.array([i or 0 for i in ids], np.int64), known, np.array([len(t) for t in texts], np.int64), np.frombuffer(b"".join(texts), np.uint8))
            return pa.RecordBatch.from_pydict({"pack": [name], "batch": [uuid.uuid4().hex], "blob": [blob]})

        for batch in it:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = t.as_buffer().to_pybytes() if t.is_valid else b""
                if texts and size + len(raw) > BATCH_BYTES:
                    yield done()
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(raw)
                size += len(raw)
        if texts:
            yield done()

    return written(spread(docs.select(F.col("doc_id").cast("long"), "text")).mapInArrow(tidy(run), "pack string, batch string, blob binary"), "batches")


def _messages(name: str, made: Iterator[tuple[int, bytes]]) -> pa.Table:
    rows = list(made)
    return pa.table({"pack": pa.array([name] * len(rows), pa.string()), "part": pa.array([g for g, _ in rows], pa.int32()), "blob": pa.array([m for _, m in rows], pa.binary())})


def _shared(store: DataFrame, groups: int, settings: Settings) -> DataFrame:
    """(pack, part, shared, hot, n): for each pack the hashes that several documents have."""

    def send(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, found = "", []

        def done() -> list[pa.RecordBatch]:
            if not found:
                return []
            h, of = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
            n = np.minimum(np.bincount(of, np.concatenate([f[1] for f in found]), len(h)), 1 << 30).astype(np.int32)
            return _messages(name, ((g, pack(h[w], n[w])) for g, w in parts((mix(h.copy()) % np.uint64(groups)).astype(np.int64)))).to_batches()

        for rows in it:
            for of, blob in zip(rows.column("pack").to_pylist(), rows.column("blob").to_pylist(), strict=True):
                if of != name:
                    yield from done()
                    name, found = of, []
                found.append(Batch(blob, settings).anchors())
        yield from done()

    def meet(table: pa.Table) -> pa.Table:
        names, blobs = table["pack"].to_pylist(), table["blob"].to_pylist()
        out: list[tuple] = []
        # a large group is worked through in parts, by bits of the hashes that did not choose the group
        many = max(1, -(-sum(map(len, blobs)) // (GROUP_ENTRIES * HASH_BYTES)))
        for k in range(many):
            got = [unpack(b, np.uint64, np.int32) for b in blobs]
            if many > 1:
                got = [(h[w], n[w]) for h, n in got for w in [np.flatnonzero((h >> np.uint64(5)) % np.uint64(many) == k)]]
            h, n = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
            values, of = np.unique(h, return_inverse=True)
            docs = np.bincount(of, n, len(values))
            at = 0
            for name, (mine, _) in zip(names, got, strict=True):
                count = docs[of[at : at + len(mine)]]
                at += len(mine)
                if (some := count > 1).any():
                    out.append((name, pack(mine[some]), pack((count[some] > settings.hot).astype(np.uint8)), int(some.sum())))
        part = table["part"][0].as_py() if len(names) else 0
        columns = list(zip(*out, strict=True)) or [()] * 4
        kinds = (pa.string(), pa.binary(), pa.binary(), pa.int64())
        pack_, shared, hot, n_ = (pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True))
        return pa.table({"pack": pack_, "part": pa.array([part] * len(out), pa.int32()), "shared": shared, "hot": hot, "n": n_})

    sent = store.select("pack", "blob").mapInArrow(tidy(send), "pack string, part int, blob binary")
    return written(sent.groupBy("part").applyInArrow(meet, _TOLD), "shared")


def _told(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The shared hashes of a pack, ascending, and which are hot."""
    rows = [(s, h) for s, h in zip(table["shared"].to_pylist(), table["hot"].to_pylist(), strict=True) if s is not None]
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint8)
    shared = np.concatenate([unpack(s, np.uint64)[0] for s, _ in rows])
    hot = np.concatenate([unpack(h, np.uint8)[0] for _, h in rows])
    order = np.argsort(shared)
    return shared[order], hot[order]


def _in_order(table: pa.Table) -> list[bytes]:
    """The blobs of a pack in the order of their batches' names, which counts strings for both sides of an answer."""
    return [blob for _, blob in sorted(zip(table["batch"].to_pylist(), table["blob"].to_pylist(), strict=True))]


def _answers(store: DataFrame, shared: DataFrame, blocks: int, settings: Settings) -> DataFrame:
    """(pack, part, answer): what the blocks found for each pack."""

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        told = _told(right)
        made: dict[int, list[tuple[np.ndarray, ...]]] = {}
        for blob in _in_order(left):
            for block, arrays in Batch(blob, settings).segments(*told).messages(blocks):
                made.setdefault(block, []).append(arrays)
        name = left["pack"][0].as_py() if left.num_rows else ""
        return _messages(name, ((block, pack(*(np.concatenate(c) for c in zip(*several, strict=True)))) for block, several in made.items()))

    def meet(table: pa.Table) -> pa.Table:
        out = solve(list(zip(table["pack"].to_pylist(), table["blob"].to_pylist(), strict=True)), settings.size) if table.num_rows else []
        part = table["part"][0].as_py() if table.num_rows else 0
        names, found = pa.array([n for n, _ in out], pa.string()), pa.array([a for _, a in out], pa.binary())
        return pa.table({"pack": names, "part": pa.array([part] * len(out), pa.int32()), "answer": found})

    sent = store.groupBy("pack").cogroup(shared.select("pack", "shared", "hot").groupBy("pack")).applyInArrow(send, "pack string, part int, blob binary")
    return written(sent.groupBy("part").applyInArrow(meet, "pack string, part int, answer binary"), "answers")


class Answers:
    """What the blocks found for the strings of a pack, taken out batch by batch in order."""

    def __init__(self, blobs: dict[int, bytes]):
        self.found = {part: unpack(blob, np.int32, np.int64) for part, blob in blobs.items()}
        self.strings, self.windows = dict.fromkeys(self.found, 0), dict.fromkeys(self.found, 0)

    def take(self, part: int, which: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of a batch's strings in a block those that were answered, and the least doc_ids of their windows.

        which: the strings of the batch in that block; count: the number of windows of each."""
        if part not in self.found:
            return which[:0], np.zeros(0, np.int64)
        back, least = self.found[part]
        begin = self.strings[part]
        low, high = np.searchsorted(back, [begin, begin + len(which)])
        some = back[low:high] - begin
        at = self.windows[part]
        end = at + int(count[some].sum())
        self.strings[part], self.windows[part] = begin + len(which), end
        return which[some], least[at:end]


def removed_mask(batch: Batch, shared: np.ndarray, hot: np.ndarray, answers: Answers, blocks: int) -> np.ndarray:
    """Which bytes of the batch go."""
    size = batch.settings.size
    change = np.zeros(len(batch.raw) + 1, np.int32)
    seg = batch.segments(shared, hot)
    found_at = np.full(len(seg.first), -1)
    found, base = [], 0
    for part, members in seg.block_members(blocks).items():
        which, least = answers.take(part, members, seg.runs.count[seg.first[members]])
        count = seg.runs.count[seg.first[which]]
        found_at[which] = base + np.cumsum(count) - count
        found.append(least)
        base += len(least)
    if base:
        least = np.concatenate(found)
        hit = np.flatnonzero(found_at[seg.of] >= 0)
        r = seg.runs.take(hit)
        window = ranges(r.start, r.count)
        earlier = least[ranges(found_at[seg.of[hit]], r.count)] < np.repeat(batch.ids[r.doc], r.count)
        window = window[earlier]  # each window is in one run
        change[window] += 1
        change[window + size] -= 1
    return np.cumsum(change[:-1]) > 0


def remove_repeats(docs: DataFrame, settings: Settings = Settings(), texts: bool = False) -> DataFrame:  # noqa: B008
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    texts: also `kept` (binary, the bytes that stay) and `spans` array<struct<start,end>> of removed bytes.
    Null and empty texts have no bytes. Rows with a null doc_id keep everything and remove nothing.
    Rows that repeat a doc_id are no earlier than one another. Further columns are ignored; an empty
    table gives no rows."""
    spark = docs.sparkSession
    store = batches(docs)
    n = store.count()
    per = shuffle_partitions(spark)
    groups = min(max(2 * per, -(-n * BATCH_BYTES // 15 // GROUP_ENTRIES)), MOST_PARTS * per)
    shared = _shared(store, groups, settings)
    release(spark)
    anchors = shared.agg(F.sum("n")).first()[0] or 0
    blocks = min(max(2 * per, -(-anchors * 2 * settings.size // (2 * BLOCK_BYTES))), MOST_PARTS * per)
    answers = _answers(store, shared, blocks, settings)
    release(spark)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        cols: dict[str, list] = {c: [] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(("kept", "spans") if texts else ()))}
        told = _told(right)
        answered = Answers({p: a for p, a in zip(right["part"].to_pylist(), right["answer"].to_pylist(), strict=True) if a is not None})
        for blob in _in_order(left):
            b = Batch(blob, settings)
            gone = removed_mask(b, *told, answered, blocks)
            begins = b.ends - b.sizes
            first = gone.copy()
            first[1:] &= ~gone[:-1]
            first[begins[begins < len(gone)]] = gone[begins[begins < len(gone)]]
            removed, spans = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, first))
            for k, (s, e) in enumerate(zip(begins.tolist(), b.ends.tolist(), strict=True)):
                kept = (b.raw[s:e][~gone[s:e]] if removed[e] - removed[s] else b.raw[s:e]).tobytes()
                cols["doc_id"].append(int(b.ids[k]) if b.known[k] else None)
                cols["n_bytes"].append(e - s)
                cols["n_removed"].append(int(removed[e] - removed[s]))
                cols["n_spans"].append(int(spans[e] - spans[s]))
                cols["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if texts:
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[s:e].view(np.int8), [0]])))
                    cols["kept"].append(kept)
                    cols["spans"].append([{"start": int(x), "end": int(y)} for x, y in edge.reshape(-1, 2)])
        kinds = [pa.int64()] * 4 + [pa.string()] + ([pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))] if texts else [])
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(cols.items(), kinds, strict=True)})

    told = shared.select("pack", "part", "shared", "hot", F.lit(None).cast("binary").alias("answer")).unionByName(
        answers.select("pack", "part", F.lit(None).cast("binary").alias("shared"), F.lit(None).cast("binary").alias("hot"), "answer")
    )
    schema = RESULT + (", kept binary, spans array<struct<start:long,end:long>>" if texts else "")
    return store.groupBy("pack").cogroup(told.groupBy("pack")).applyInArrow(finish, schema)
