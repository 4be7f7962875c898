"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over the pieces reads the text once; at each position the output links
give all pieces that end there, and the best score of the position is relaxed over them (Viterbi).
Ties go to the longer last piece. Characters in no piece fall back to byte pieces.

No piece of the usual models has a word mark after another character, so the best segmentation of a
text is that of its words put together: words are encoded side by side in numpy, and kept in a
bounded cache. Models without that property are encoded over whole texts.
"""

from __future__ import annotations

import re
import struct
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import spread, tidy

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Stands for a word mark that was in the text itself, which becomes bytes. Half of a surrogate pair, which no UTF-8 text can hold.
LITERAL = "\ud800"
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: The unknown character scores so much less than the worst piece.
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 200_000
LONG_WORD = 160


def _fields(buf: bytes) -> Iterator[tuple[int, object]]:
    """Number and value of each field of a protocol buffer message."""
    i = 0

    def varint(i: int) -> tuple[int, int]:
        x = shift = 0
        while True:
            b = buf[i]
            x, shift, i = x | (b & 127) << shift, shift + 7, i + 1
            if b < 128:
                return x, i

    while i < len(buf):
        tag, i = varint(i)
        kind = tag & 7
        if kind == 0:
            value, i = varint(i)
        elif kind == 2:
            n, i = varint(i)
            value, i = buf[i : i + n], i + n
        else:
            n = 8 if kind == 1 else 4
            value, i = struct.unpack("<d" if n == 8 else "<f", buf[i : i + n])[0], i + n
        yield tag >> 3, value


@dataclass(frozen=True)
class Model:
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    dummy_prefix: bool = True

    @staticmethod
    def load(path: str = MODEL_PATH) -> Model:
        """From a model file with identity normalisation; others are refused."""
        pieces, scores, kinds, prefix = [], [], [], True
        with open(path, "rb") as f:
            raw = f.read()
        for number, value in _fields(raw):
            if number == 1:
                one = dict(_fields(value))
                pieces.append(one[1].decode())
                scores.append(one.get(2, 0.0))
                kinds.append(one.get(3, NORMAL))
            elif number == 3:
                spec = dict(_fields(value))
                prefix = bool(spec.get(3, 1))
                if spec.get(2) or spec.get(4, 1):
                    raise ValueError("only models with identity normalisation are supported")
        return Model(tuple(pieces), tuple(scores), tuple(kinds), prefix)


class Codec:
    """Encoder and decoder of one model; built once in each worker."""

    def __init__(self, model: Model):
        self.model = model
        usable = [(p, i) for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k in (NORMAL, USER_DEFINED) and p]
        self.byte_ids = np.full(256, -1, np.int32)
        for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)):
            if k == BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
        self.unknown = next((i for i, k in enumerate(model.kinds) if k == UNKNOWN), 0)
        low = min((model.scores[i] for _, i in usable), default=0.0)
        self.unknown_score = low - UNKNOWN_PENALTY
        self.by_word = not any(re.search(f"[^{MARK}]{MARK}", p) for p, _ in usable)
        cut = "" if any("\n" in p for p, _ in usable) else "\\n"
        self.words = re.compile(f"{MARK}*[^{MARK}{cut}]+|{MARK}+" + ("|\\n" if cut else "")) if self.by_word else re.compile(r"(?s).+")
        self._automaton(usable)
        self.cache: dict[str, bytes] = {}
        self.surface = [self._bytes(i) for i in range(len(model.pieces))]

    def _bytes(self, i: int) -> bytes:
        kind, piece = self.model.kinds[i], self.model.pieces[i]
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        return b"" if kind in (CONTROL, UNKNOWN) else piece.replace(MARK, " ").encode()

    def _automaton(self, usable: list[tuple[str, int]]) -> None:
        """Trie edges, fail links, and for each state the piece that ends there and the next shorter one."""
        edges: list[dict[str, int]] = [{}]
        ends = [-1]
        depth = [0]
        for piece, i in usable:
            s = 0
            for ch in piece:
                if ch not in edges[s]:
                    edges[s][ch] = len(edges)
                    edges.append({})
                    ends.append(-1)
                    depth.append(depth[s] + 1)
                s = edges[s][ch]
            ends[s] = i
        fail, link = [0] * len(edges), [0] * len(edges)
        todo = deque(edges[0].values())
        while todo:
            s = todo.popleft()
            for ch, t in edges[s].items():
                f = fail[s]
                while f and ch not in edges[f]:
                    f = fail[f]
                fail[t] = edges[f].get(ch, 0)
                todo.append(t)
            link[s] = fail[s] if ends[fail[s]] >= 0 else link[fail[s]]
        self.edges, self.fail_, self.link_, self.ends_, self.depth_ = edges, fail, link, ends, depth
        keys = np.array([s << 21 | ord(ch) for s, e in enumerate(edges) for ch in e], np.int64)
        to = np.array([t for e in edges for t in e.values()], np.int32)
        order = np.argsort(keys)
        self.keys, self.to = keys[order], to[order]
        self.fail, self.link, self.ends, self.depth = (np.array(x, np.int32) for x in (fail, link, ends, depth))
        self.score = np.array([self.model.scores[e] if e >= 0 else 0.0 for e in ends])
        self.single = np.array(sorted(ord(p) for p, _ in usable if len(p) == 1), np.int64)

    def _step(self, state: np.ndarray, ch: np.ndarray) -> np.ndarray:
        """Goto, by fail links where there is no edge."""
        out, todo, s = np.zeros(len(state), np.int32), np.arange(len(state)), state
        while len(todo):
            key = s.astype(np.int64) << 21 | ch[todo]
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            hit = self.keys[at] == key
            out[todo[hit]] = self.to[at[hit]]
            rest = ~hit & (s > 0)
            todo, s = todo[rest], self.fail[s[rest]]
        return out

    def _encode_words(self, words: list[str]) -> None:
        """Ids of all words into the cache, one character of all words at a time."""
        words = sorted(words, key=len, reverse=True)
        n = np.array([len(w) for w in words])
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        start = np.concatenate([[0], np.cumsum(n)[:-1]])
        W, L = len(words), int(n[0])
        best = np.full((L + 1, W), -np.inf)
        best[0] = 0
        back = np.zeros((L + 1, W), np.int32)
        piece = np.zeros((L + 1, W), np.int32)
        state = np.zeros(W, np.int32)
        alive = np.searchsorted(-n, -np.arange(L), "left")  # words longer than i come first
        for i in range(L):
            w = int(alive[i])
            ch = flat[start[:w] + i]
            state = self._step(state[:w], ch)
            at = np.where(self.ends[state] >= 0, state, self.link[state])
            row = best[i + 1]
            who = np.flatnonzero(at)
            s = at[who]
            while len(who):
                d = self.depth[s]
                value = best[i + 1 - d, who] + self.score[s]
                up = value > row[who]
                u = who[up]
                row[u], back[i + 1, u], piece[i + 1, u] = value[up], d[up], self.ends[s[up]]
                s = self.link[s]
                who, s = who[s > 0], s[s > 0]
            spot = np.searchsorted(self.single, ch)
            spot[spot == len(self.single)] = 0
            lone = np.flatnonzero(self.single[spot] != ch) if len(self.single) else np.arange(w)
            value = best[i, lone] + self.unknown_score
            u = lone[value > row[lone]]
            row[u], back[i + 1, u], piece[i + 1, u] = best[i, u] + self.unknown_score, 1, -1
        pos, columns, counts = n.copy(), [], np.zeros(W, np.int64)
        live = np.arange(W)
        while len(live):
            ids = np.zeros(W, np.int32)
            ids[live] = np.where(piece[pos[live], live] >= 0, piece[pos[live], live], -flat[start[live] + pos[live] - 1] - 1)
            columns.append(ids)
            counts[live] += 1
            pos[live] -= back[pos[live], live]
            live = live[pos[live] > 0]
        table = np.ascontiguousarray(np.stack(columns, 1)[:, ::-1])
        odd = (table < 0).any(1)
        wide = table.shape[1]
        for k, word in enumerate(words):
            ids = table[k, wide - counts[k] :]
            self.cache[word] = self._fallback(ids) if odd[k] else ids.tobytes()

    def _fallback(self, ids: np.ndarray) -> bytes:
        """Unknown characters (-1 - code point) as byte pieces, or as the unknown piece without those."""
        out: list[int] = []
        for x in ids.tolist():
            if x >= 0:
                out.append(x)
            else:
                ch = MARK if chr(-1 - x) == LITERAL else chr(-1 - x)
                raw = [int(self.byte_ids[b]) for b in ch.encode("utf-8", "surrogatepass")]
                out += raw if min(raw) >= 0 else [self.unknown]
        return np.array(out, np.int32).tobytes()

    def _encode_long(self, word: str) -> bytes:
        """The same, character by character; memory grows with the word only."""
        edges, fail, link, ends, depth, score = self.edges, self.fail_, self.link_, self.ends_, self.depth_, self.score
        best, back, piece = [0.0], [0], [0]
        s = 0
        for i, ch in enumerate(word):
            while s and ch not in edges[s]:
                s = fail[s]
            s = edges[s].get(ch, 0)
            top, length, which, single = -np.inf, 1, -1, False
            t = s if ends[s] >= 0 else link[s]
            while t:
                d = depth[t]
                single |= d == 1
                value = best[i + 1 - d] + score[t]
                if value > top:
                    top, length, which = value, d, ends[t]
                t = link[t]
            if not single and best[i] + self.unknown_score > top:
                top, length, which = best[i] + self.unknown_score, 1, -1 - ord(ch)
            best.append(top)
            back.append(length)
            piece.append(which)
        out, i = [], len(word)
        while i:
            out.append(piece[i])
            i -= back[i]
        return self._fallback(np.array(out[::-1], np.int32))

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Piece ids (int32) of each text; an empty text has none."""
        split = [self.words.findall((" " * self.model.dummy_prefix + t).replace(MARK, LITERAL).replace(" ", MARK)) if t else [] for t in texts]
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        new = list({w for ws in split for w in ws} - self.cache.keys())
        for w in (w for w in new if len(w) > LONG_WORD):
            self.cache[w] = self._encode_long(w)
        short = sorted((w for w in new if len(w) <= LONG_WORD), key=len)
        for k in range(0, len(short), 8192):
            self._encode_words(short[k : k + 8192])
        cache = self.cache
        return [np.frombuffer(b"".join([cache[w] for w in ws]), np.int32) for ws in split]

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def decode(self, ids) -> str:
        """The text of piece ids; the blank that the encoder put first is taken off."""
        surface = self.surface
        raw = b"".join([surface[i] for i in ids])
        if self.model.dummy_prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "surrogatepass")


_codecs: dict[int, Codec] = {}


def _codec(model: Model) -> Codec:
    """One codec for each worker and model."""
    key = hash((model.pieces, model.scores))
    if key not in _codecs:
        _codecs[key] = Codec(model)
    return _codecs[key]


def encode(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, n_tokens, round_trip): whole texts encoded; round_trip says that decoding gives the text back.

    Null and empty texts have no tokens and round_trip true. Null ids and repeated rows are kept as
    they are; further columns are ignored. The model (bounded by its vocabulary) is sent to the workers."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    schema = T.StructType().add(id_col, "long").add("ids", T.ArrayType(T.IntegerType())).add("n_tokens", "long").add("round_trip", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent.value)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                texts = part.column(1).to_pylist()
                ids = codec.encode_batch(texts)
                same = [codec.decode(x.tolist()) == t for x, t in zip(ids, texts, strict=True)]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                values = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), values), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array(same)], names=[id_col, "ids", "n_tokens", "round_trip"])

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return spread(rows).mapInArrow(tidy(run), schema)
