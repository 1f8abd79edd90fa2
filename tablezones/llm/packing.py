"""Best-fit packing by linear grouping.

A document is its token ids and one end id. Only documents longer than a
sequence are cut, into full pieces; the first piece takes the remainder. Pieces
are then packed in three steps, all over counts by length, whose number is
bounded by the sequence length however many documents there are:

1. *Linear grouping.* The large lengths, in descending order, form groups of
   equal cardinality; each group's lengths are rounded up to its largest.
2. *Configurations.* For the few rounded sizes, the fullest configuration of the
   sizes still open that holds the largest one is found by a subset-sum table
   and used as often as the open counts allow, until no size is open.
3. *Substitution and best fit.* Actual lengths replace the rounded ones, group
   by group; the small lengths then go to the fullest sequence that takes them.

The plan is a table of runs: the documents of one length with ranks in a range
go to consecutive sequences at one offset. Spark numbers the pieces of each
length by counts per task and prefix sums, and looks the plan up.

Null texts are empty documents of one end id. Repeated rows are packed each for
itself; a null doc_id stays null. An empty table gives an empty result. Columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablezones.llm.batches import pieces
from tablezones.llm.staging import staged
from tablezones.llm.text_ids import PIECE, crc32, encoder, tokenizer_path

SEQUENCE = 1024
GROUPS = 2048  # of the large lengths
SMALL = 64  # lengths under this are best-fitted at the end
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def _grouped(large: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int]]]:
    """Groups of equal cardinality of (length, count), descending; a length may be in several."""
    total = sum(c for _, c in large)
    size = max(1, -(-total // groups))
    out: list[list[tuple[int, int]]] = [[]]
    room = size
    for length, count in large:
        while count:
            if not room:
                out.append([])
                room = size
            n = min(room, count)
            out[-1].append((length, n))
            room, count = room - n, count - n
    return out


def _fullest(sizes: list[int], open_counts: list[int], capacity: int) -> dict[int, int]:
    """The configuration of the largest open size that fills ``capacity`` best: {size index: times}."""
    first = next(i for i, c in enumerate(open_counts) if c)
    rest = capacity - sizes[first]
    mask = (1 << (rest + 1)) - 1
    reach, steps = 1, []
    for i in range(first, len(sizes)):
        n = open_counts[i] - (i == first)
        if n <= 0 or sizes[i] > rest:
            continue
        for _ in range(min(n, rest // sizes[i])):
            more = (reach | reach << sizes[i]) & mask
            if more == reach:
                break
            steps.append((i, reach))
            reach = more
        if reach >> rest & 1:
            break
    at, used = reach.bit_length() - 1, {first: 1}
    for i, before in reversed(steps):
        if not before >> at & 1:
            used[i] = used.get(i, 0) + 1
            at -= sizes[i]
    return used


def plan_packing(counts: dict[int, int], capacity: int = SEQUENCE, groups: int = GROUPS, small: int = SMALL) -> np.ndarray:
    """Runs (length, first rank, first sequence, offset), sorted, for all pieces of the given lengths."""
    large = sorted(((n, c) for n, c in counts.items() if n >= small and c), reverse=True)
    members = [list(g) for g in _grouped(large, groups) if g]
    sizes = [g[0][0] for g in members]
    open_counts = [sum(c for _, c in g) for g in members]
    rank = dict.fromkeys(counts, 0)
    runs: list[tuple[int, int, int, int]] = []
    # equal rounded sizes are one size
    merged: dict[int, list[tuple[int, int]]] = {}
    for size, group in zip(sizes, members):
        merged.setdefault(size, []).extend(group)
    sizes = list(merged)
    members = list(merged.values())
    open_counts = [sum(c for _, c in g) for g in members]
    rooms: list[tuple[int, int, int]] = []  # free room, first sequence, sequences
    sequence = 0
    while any(open_counts):
        used = _fullest(sizes, open_counts, capacity)
        times = min(open_counts[i] // n for i, n in used.items())
        blocks = [(sequence, times, 0)]
        for i, n in sorted(used.items()):
            open_counts[i] -= times * n
            for _ in range(n):  # one slot of the configuration: real lengths by runs
                filled = []
                for base, size, offset in blocks:
                    while size:
                        length, left = members[i][0]
                        took = min(size, left)
                        runs.append((length, rank[length], base, offset))
                        rank[length] += took
                        filled.append((base, took, offset + length))
                        base, size = base + took, size - took
                        if took == left:
                            members[i].pop(0)
                        else:
                            members[i][0] = (length, left - took)
                blocks = filled
        rooms += [(capacity - offset, base, size) for base, size, offset in blocks]
        sequence += times
    by_room: dict[int, list[tuple[int, int]]] = {}
    for room, base, size in rooms:
        by_room.setdefault(room, []).append((base, size))
    for length, left in sorted(((n, c) for n, c in counts.items() if n < small and c), reverse=True):
        while left:
            room = min((r for r in by_room if r >= length and by_room[r]), default=None)
            if room is None:
                by_room[capacity] = [(sequence, -(-left // (capacity // length)))]
                sequence += by_room[capacity][0][1]
                room = capacity
            base, size = by_room[room].pop()
            fit = room // length
            full = min(size, left // fit)  # sequences that take all they can
            for k in range(fit if full else 0):
                runs.append((length, rank[length], base, capacity - room + k * length))
                rank[length] += full
            left -= full * fit
            if full:
                by_room.setdefault(room - fit * length, []).append((base, full))
            elif left:  # fewer documents than one sequence takes
                for k in range(left):
                    runs.append((length, rank[length], base, capacity - room + k * length))
                    rank[length] += 1
                by_room.setdefault(room - left * length, []).append((base, 1))
                full, left = 1, 0
            if size > full:
                by_room[room].append((base + full, size - full))
    return np.array(sorted(runs), np.int64).reshape(-1, 4)


def _pieces_of(tokenizer: str, end_id: int, capacity: int):
    def cut(batches):
        from pyspark import TaskContext

        part, coder = TaskContext.get().partitionId(), encoder(tokenizer)
        nth = np.zeros(capacity + 1, np.int64)  # pieces of each length so far in this task
        for batch in batches:
            for rows, _, _ in pieces(batch, "text", PIECE):
                ids, to = coder.encode(rows.column("text"))
                ids = np.insert(ids, to[1:], end_id)
                begin = to[:-1] + np.arange(len(rows))
                size = np.diff(to) + 1
                n = -(-size // capacity)
                row = np.repeat(np.arange(len(rows)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                first = (size - 1) % capacity + 1
                start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[row], capacity)
                order = np.argsort(length, kind="stable")
                got = np.bincount(length, minlength=capacity + 1)
                place = np.empty(len(row), np.int64)
                place[order] = np.arange(len(row)) - np.repeat(np.cumsum(got) - got, got) + np.repeat(nth, got)
                nth += got
                at = begin[row] + start
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id").take(pa.array(row)),
                        pa.array(piece, pa.int32()),
                        pa.array(start),
                        pa.array(length),
                        pa.array([crc32(ids[a : a + k]) for a, k in zip(at.tolist(), length.tolist())], pa.int64()),
                        pa.array(np.full(len(row), part), pa.int32()),
                        pa.array(place),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"],
                )

    return cut


def _placed(runs: np.ndarray):
    """Look up each piece's run by (length, rank): the last run that starts at or before it."""
    key = runs[:, 0] << 44 | runs[:, 1]

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            run = runs[np.searchsorted(key, length << 44 | rank, "right") - 1]
            keep = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(run[:, 2] + rank - run[:, 1]), pa.array(run[:, 3])], [*keep, "sequence_id", "offset"])

    return place


def pack(documents: DataFrame, capacity: int = SEQUENCE, end_id: int = 2, tokenizer: str | None = None) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = staged(rows.mapInArrow(_pieces_of(tokenizer or tokenizer_path(), end_id, capacity), PIECES), "pieces")
    by_task = staged(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(base, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(_placed(plan_packing(counts, capacity)), schema)
