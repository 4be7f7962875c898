"""Sets of word shingles as sorted 64-bit hashes, for whole batches of texts at once."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SYMBOL = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
#: Texts are hashed together up to so many bytes; a longer text is hashed alone.
CHUNK = 1 << 21
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64; x is not changed."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, name: str = "base") -> np.ndarray:
    """The first n powers of the base, or of its inverse, modulo 2 ** 64."""
    if name not in _powers or len(_powers[name]) < n:
        p = np.full(max(n, CHUNK + 4096), _BASE if name == "base" else _INVERSE, np.uint64)
        p[0] = 1
        if len(p) > 4 * CHUNK:
            return np.multiply.accumulate(p)[:n]
        _powers[name] = np.multiply.accumulate(p)
    return _powers[name][:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts one after another, and the number of words of each text.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = _SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_SYMBOL[_LOWER[raw]] * powers(len(raw)), out=total[1:])
    hashes = mix((total[end] - total[start]) * powers(len(raw), "inverse")[start])
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(start, bounds), prepend=0)


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The distinct shingles of each text, sorted: `words` words each; fewer words are one shingle, none give no shingle."""
    out: list[np.ndarray] = []
    k = 0
    while k < len(texts):
        size, j = 0, k
        while j < len(texts) and (j == k or size + len(texts[j]) < CHUNK):
            size, j = size + len(texts[j]) + 1, j + 1
        hashes, counts = word_hashes(texts[k:j])
        rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
        for w in range(words):
            rolled = rolled * _BASE + hashes[w : w + len(rolled)]
        rolled = mix(rolled)
        at = 0
        for n in counts.tolist():
            if n >= words:
                s = np.sort(rolled[at : at + n - words + 1])
                out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
            elif n:
                one = np.uint64(n)
                with np.errstate(over="ignore"):
                    for h in hashes[at : at + n]:
                        one = one * _BASE + h
                out.append(mix(np.array([one ^ np.uint64(0x5851F42D4C957F2D)], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
            at += n
        k = j
    return out


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if not len(a) or not len(b):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())
