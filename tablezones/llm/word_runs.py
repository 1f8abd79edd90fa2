"""Periodic runs of words, found by string synchronising sets.

A run is a stretch of consecutive words with smallest period ``q`` and a length
of at least ``max(LEAST, EXPONENT * q)`` that no neighbouring word extends.

* *Small periods* (under ``FIRST``) are detected as such: neighbours at distance
  ``q`` are compared for every word, and long stretches of equal ones are regions
  of that period.
* *Larger periods* by scales. At scale ``t`` (a power of two) a position is
  synchronising if, of the hashes of the ``t``-word fragments that begin in the
  ``t + 1`` positions from it on, the least stands at the first or the last one.
  Fragments with a period of ``t / EXPONENT`` or less are left out, as their
  region is known from a smaller scale; so there are O(n / t) such positions,
  and the choice depends on ``2 t`` words of context alone. A run of period
  ``t <= q < 2 t`` then holds one in its first ``t`` words and the same one ``q``
  words on, in equal contexts, and no other between them has that context. So
  each pair of positions with equal contexts, next to each other among those of
  that context and at such a distance, proposes its distance as a period.

A proposal is extended both ways by comparing words, and kept if it is long
enough and not a repetition of a smaller period. All texts of a piece are worked
on at once; a longer scale keeps only texts that could hold such a run. The
hashes only propose: fragments are named by mixing the names of their halves, and
the runs themselves rest on comparing the words' 64-bit hashes.

Null, empty and blank texts have no words: no runs, four nulls and the hash of
an empty string. Repeated rows are each for themselves. A null doc_id is hashed
as an empty string. Ties between longest runs go to the smallest start, then the
smallest period. One very long text makes a piece of its own and takes time and
memory in proportion to its words, times the logarithm for time. An empty table
gives an empty result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablezones.llm.batches import pieces
from tablezones.llm.words import CASED, mix, word_hashes, word_spans

LEAST, EXPONENT = 6, 4
#: The first scale; smaller periods are compared directly.
FIRST = 4
#: Text bytes worked on at once.
PIECE = 512 << 10
SCHEMA = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
_OUT = np.uint64(0xFFFFFFFFFFFFFFFF)


def _stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of at least ``least`` true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], equal.view(np.int8), [0]])))
    starts, ends = edge[::2], edge[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def _extended(words: np.ndarray, low: int, high: int, at: int, d: int) -> tuple[int, int]:
    """The largest stretch of ``words[low:high]`` around ``at`` in which words ``d`` apart are equal."""
    end, step = at, 64
    while end < high - d:  # words[at:end] are known to equal their successors
        differ = np.flatnonzero(words[end : min(end + step, high - d)] != words[end + d : min(end + step, high - d) + d])
        if len(differ):
            end += int(differ[0])
            break
        end, step = min(end + step, high - d), step * 2
    start, step = at, 64
    while start > low:
        begin = max(low, start - step)
        differ = np.flatnonzero(words[begin:start] != words[begin + d : start + d])
        if len(differ):
            start = begin + int(differ[-1]) + 1
            break
        start, step = begin, step * 2
    return start, end + d


def _repeats_less(words: np.ndarray, start: int, d: int) -> bool:
    """Whether the ``d`` words at ``start`` are themselves a repetition, so that ``d`` is not the smallest period."""
    rest, p = d, 2
    while rest > 1:
        p = p if p * p <= rest else rest
        if rest % p == 0:
            q = d // p
            if np.array_equal(words[start : start + d - q], words[start + q : start + d]):
                return True
            while rest % p == 0:
                rest //= p
        p += 1
    return False


def _sync_positions(names: np.ndarray, t: int, regions: list[tuple[int, int]]) -> np.ndarray:
    """Synchronising positions at scale ``t``; ``names`` are of the ``t``-word fragments, ``_OUT`` where there is none.

    ``regions`` are start and end of the known stretches of a period of ``t / EXPONENT`` or less."""
    key = mix(names ^ np.uint64(t))
    if regions:
        change = np.zeros(len(key) + 1, np.int64)
        for start, end in regions:
            if end - start >= t:
                change[start] += 1
                change[end - t + 1] -= 1
        key = np.where(np.cumsum(change[:-1]) > 0, _OUT, key)
    key = np.where(names == _OUT, _OUT, key)
    least, width = key, 1
    while width < t:  # the least of a power of two of neighbours, by doubling
        least = np.minimum(least, np.concatenate([least[width:], np.full(width, _OUT, np.uint64)]))
        width *= 2
    last = np.concatenate([key[t:], np.full(t, _OUT, np.uint64)]) if len(key) > t else np.full(len(key), _OUT, np.uint64)
    least = np.minimum(least, last)
    return np.flatnonzero((least != _OUT) & ((key == least) | (last == least)))


def find_runs(words: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, end, smallest period) of texts that lie after one another, sorted by start, then period.

    ``words`` are hashes; text ``k`` has those from ``at[k]`` to ``at[k + 1]``."""
    n = len(words)
    runs: set[tuple[int, int, int]] = set()  # of any length from EXPONENT periods on
    if not n:
        return []
    text_of = np.repeat(np.arange(len(at) - 1), np.diff(at))
    for q in range(1, FIRST):
        if n <= q:
            break
        equal = (words[:-q] == words[q:]) & (text_of[:-q] == text_of[q:])
        for s, e in zip(*(x.tolist() for x in _stretches(equal, (EXPONENT - 1) * q))):
            if not _repeats_less(words, s, q):
                runs.add((s, e + q, q))
    # texts that a scale works on lie after one another in the arrays of that scale
    t, size = FIRST, np.diff(at)
    live = np.flatnonzero(size >= EXPONENT * t)
    if len(live):
        place = np.concatenate([np.arange(a, b) for a, b in zip(at[live].tolist(), at[live + 1].tolist())])
        own, left, names = words[place], (at[1:][text_of] - np.arange(n))[place], words[place]
        k = 1
        while k < t:
            names = _doubled(names, k, left)
            k *= 2
    while len(live):
        bounds = np.concatenate([[0], np.cumsum(size[live])])
        shift = at[live] - bounds[:-1]
        known: list[tuple[int, int]] = []
        covered: dict[int, list[tuple[int, int]]] = {}
        if runs:
            short = np.array([(s, e) for s, e, p in runs if p * EXPONENT <= t], np.int64).reshape(-1, 2)
            text = np.searchsorted(at, short[:, 0], "right") - 1
            spot = np.searchsorted(live, text)
            there = (spot < len(live)) & (live[np.minimum(spot, len(live) - 1)] == text)
            moved = short[there] - shift[spot[there]][:, None]
            known = [tuple(x) for x in moved.tolist()]
        positions = _sync_positions(names, t, known)
        doubled = _doubled(names, t, left)
        positions = positions[left[positions] >= 2 * t]
        context = doubled[positions]
        order = np.lexsort((positions, context))
        a, b = positions[order[:-1]], positions[order[1:]]
        gap = b - a
        good = (context[order[:-1]] == context[order[1:]]) & (gap >= t) & (gap < 2 * t)
        text = np.searchsorted(bounds, a[good], "right") - 1
        same = b[good] < bounds[text + 1]
        for i, d, x in sorted(zip(a[good][same].tolist(), gap[good][same].tolist(), text[same].tolist()), key=lambda c: (c[1], c[0])):
            done = covered.setdefault(d, [])
            if done and done[-1][0] <= i and i + d < done[-1][1]:
                continue  # inside the stretch of this period found last
            s, e = _extended(own, int(bounds[x]), int(bounds[x + 1]), i, d)
            done.append((s, e))
            if e - s >= EXPONENT * d and not _repeats_less(own, s, d):
                runs.add((s + int(shift[x]), e + int(shift[x]), d))
        t *= 2
        keep = size[live] >= EXPONENT * t
        rows = np.repeat(keep, size[live])
        live, own, left, names = live[keep], own[rows], left[rows], doubled[rows]
    return sorted((s, e, q) for s, e, q in runs if e - s >= LEAST)


def _doubled(names: np.ndarray, k: int, left: np.ndarray) -> np.ndarray:
    """Names of fragments of ``2 k`` words from those of ``k``; ``left`` counts the words to the end of the text."""
    out = np.full(len(names), _OUT, np.uint64)
    here = np.flatnonzero(left >= 2 * k)
    out[here] = mix(names[here] * np.uint64(0x9E3779B97F4A7C15) + mix(names[here + k] + np.uint64(k)))
    out[here] -= (out[here] == _OUT).astype(np.uint64)
    return out


def planted(doc_id, n: int) -> tuple[int, int] | None:
    """Where the query makes a text of ``n`` words periodic, and with which period; None for most texts."""
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 or not n:
        return None
    a = h // 10 % n
    return a, 1 + (n - a) // (3 + h // 10 % 8)


def _searched(plant: bool):
    def search(batches):
        for batch in batches:
            for rows, text, byte_at in pieces(batch, "text", PIECE):
                starts, ends, at = word_spans(text, byte_at)
                hashes = word_hashes(text, starts, ends, CASED)
                ids = rows.column("doc_id").to_pylist()
                source: dict[int, np.ndarray] = {}
                for k, doc in enumerate(ids):
                    n = int(at[k + 1] - at[k])
                    if plant and (made := planted(doc, n)):
                        a, p = made
                        i = np.arange(n)
                        i[a:] = a + (i[a:] - a) % p
                        source[k] = i
                        hashes[at[k] : at[k + 1]] = hashes[at[k] : at[k + 1]][i]
                found: dict[int, list] = {}
                for s, e, q in find_runs(hashes, at):
                    k = int(np.searchsorted(at, s, "right") - 1)
                    found.setdefault(k, []).append((s - int(at[k]), e - s, q))
                out = []
                for k, doc in enumerate(ids):
                    runs, n = found.get(k, []), int(at[k + 1] - at[k])
                    words = text[byte_at[k] : byte_at[k + 1]].tobytes().split()  # at the same six characters
                    if k in source or runs:
                        drop = np.zeros(n + 1, np.int64)
                        for s, size, q in runs:
                            drop[s + q] += 1
                            drop[s + size] -= 1
                        kept = np.flatnonzero(np.cumsum(drop[:-1]) == 0)
                        words = [words[j] for j in (source[k][kept] if k in source else kept).tolist()]
                    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
                    milli = None if best[0] is None else 1000 * best[1] // best[2]
                    listed = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
                    out.append((doc, n, len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()))
                types = [pa.int64()] * 7 + [pa.string()] * 2
                names = [c.split()[0] for c in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return search


def periodic_runs(documents: DataFrame, plant: bool = False) -> DataFrame:
    """Every row's number of runs, its longest run, and digests of all runs and of the text without repetitions.

    ``plant`` first makes the texts periodic that ``planted`` names."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_searched(plant), SCHEMA)
