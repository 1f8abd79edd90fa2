"""Words of whole texts as 64-bit hashes, found in flat byte arrays.

A word is a maximal run of bytes other than space and tab to carriage return;
A-Z count as a-z. All of it is byte arithmetic, so texts of any size take a few
array passes and no per-word Python.
"""

from __future__ import annotations

import numpy as np

from tablezones.llm.batches import PIECE_BYTES, worker_state

_RADIX = np.uint64(0x9E3779B97F4A7C15 | 1)
_BYTE = np.random.default_rng(17).integers(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
#: Byte values for hashes that tell A-Z from a-z, and for those that don't.
CASED = _BYTE.copy()
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: similar inputs give unrelated outputs."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the radix and of its inverse modulo 2**64."""
    state = worker_state()
    if "powers" not in state or len(state["powers"][0]) < n:
        size = max(n, PIECE_BYTES + 1)
        inverse = np.uint64(pow(int(_RADIX), -1, 1 << 64))
        both = []
        for base in (_RADIX, inverse):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        state["powers"] = tuple(both)
    return state["powers"]


#: For words of letters and digits only: ASCII punctuation separates too.
PUNCTUATED = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def word_spans(text: np.ndarray, at: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of all words, and each row's first word (one more than rows)."""
    if not len(text):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    word = ~space[text]
    joined = word[1:] & word[:-1]  # a word goes on from one byte to the next, in the same text
    bounds = at[1:-1]
    joined[bounds[(bounds > 0) & (bounds < len(text))] - 1] = False
    edge = np.ones(1, bool)
    starts = np.flatnonzero(word & np.concatenate([edge, ~joined]))
    ends = np.flatnonzero(word & np.concatenate([~joined, edge])) + 1
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, byte: np.ndarray = _BYTE) -> np.ndarray:
    power, inverse = _powers(len(text) + 1)
    total = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(byte[text] * power[: len(text)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def shingles(words: np.ndarray, at: np.ndarray, n: int) -> list[np.ndarray]:
    """Each row's set of ``n``-word shingles as sorted distinct hashes.

    A row of fewer words has its whole sequence as one; without words the set is empty."""
    out = []
    weights = np.random.default_rng(n).integers(0, 1 << 62, n, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    joined = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        joined += words[k : k + len(joined)] * weights[k]
    joined = mix(joined)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= n:
            s = np.sort(joined[a : b - n + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) > 1 else s)
        elif b > a:
            few = (words[a:b] * weights[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(mix(np.array([few], np.uint64))))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
