"""Conversation structure repair by a run-length dynamic programme.

The rows of a conversation, by turn (nulls first, then role and text), are
repaired at the least cost so that the initials of their roles read
``(s?(ua)+)?``. Edits are Keep (0), Rerole to user or assistant (3), Delete (4,
the only choice for blank and repeated rows) and Insert an empty user or
assistant row (3); a truncated row that stays adds 3. Of all cheapest audits,
the edits' initials in order, the ASCII-least is taken. The role that an Insert
or a Rerole gives follows from the row before, so the audit says everything.

A row is one of nine symbols: its role's initial with or without truncation, or
"must go". Each has a min-plus matrix over the four states of the pattern.
Equal neighbours collapse into runs, and a run of ``n`` applies the matrix's
cached binary powers. The choices are then unrolled forwards; inside a long run
the costs are found by halving, so memory stays small.

On Spark: rows are range-partitioned by conversation and order, so that a very
long conversation lies in many parts. Each part turns its stretch of a
conversation (a segment) into runs. A segment at the border of a part also
gives its whole matrix; these products, at most two a part, say what every
segment costs from its end on, and then where each starts. Repeated rows are
found by the first place of each (conversation, role, text), aggregated in each
task first. The last pass streams rows beside their audits. It alone has a long
conversation in one task, a batch at a time, as its digest is sequential.

A null role or text counts as one space, a null conv_id is a conversation of its
own and a null turn comes first. Rows of one turn are ordered by role and text.
Roles other than system, user and assistant (by initial, as they are written)
cannot stay as they are. An empty table gives an empty result. Columns other
than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablezones.llm.batches import worker_state
from tablezones.llm.staging import staged

START, S, U, A = range(4)
#: The state after an inserted or changed row, and after a kept one by its initial (None: not allowed).
FORCED = (U, U, A, U)
KEPT = {0: (S, None, None, None), 1: (U, U, None, U), 2: (None, None, A, None), 3: (None,) * 4}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Cost after the last row, by state: what is missing is inserted.
END = (0, 2 * INSERT, INSERT, 0)
NEVER = 1 << 60
MUST_GO = 8
BLANKS = " \t\n\x0b\x0c\r"
#: Rows of a run whose costs are held at once.
UNROLLED = 512
LEGAL = {(0, 1), (1, 2), (2, 1)}
SEGMENT = (
    "seg long, part long, conv long, edge boolean, symbols binary, lengths binary, matrix array<long>, blank long, duplicate long, truncated long,"
    " illegal long, head int, tail int, low long, high long, turns long, first_turn long, last_turn long"
)
CHAIN = "seg long, home long, nth int, segs int, after array<long>, cost long, blank long, duplicate long, truncated long, illegal long, gaps long"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PATH = "seg long, home long, conv long, nth int, segs int, start int, end int, audit string, " + ", ".join(f"{c} long" for c in COUNTS)


def _times(x: tuple, y: tuple) -> tuple:
    """The min-plus product of two 4 x 4 matrices."""
    return tuple(tuple(min(r[k] + y[k][j] for k in range(4)) for j in range(4)) for r in x)


def _apply(m: tuple, v: tuple) -> tuple:
    a, b, c, d = v
    return tuple(min(r[0] + a, r[1] + b, r[2] + c, r[3] + d) for r in m)


def step(symbol: int) -> tuple:
    """Costs from the state before a row, with inserts before it, to the state after it."""
    m = [[NEVER] * 4 for _ in range(4)]
    for start in range(4):
        state, cost = start, 0
        for _ in range(4):  # more inserts lead to no new state
            for edit, price in _edits(symbol):
                after = _after(edit, state, symbol)
                if after is not None:
                    m[start][after] = min(m[start][after], cost + price)
            state, cost = FORCED[state], cost + INSERT
    return tuple(map(tuple, m))


def _edits(symbol: int) -> tuple[tuple[str, int], ...]:
    """A row's possible edits and their prices, in ASCII order."""
    if symbol == MUST_GO:
        return (("D", DELETE),)
    more = TRUNCATED * (symbol >= 4)
    return ("D", DELETE), ("K", more), ("R", REROLE + more)


def _after(edit: str, state: int, symbol: int) -> int | None:
    if edit == "D":
        return state
    return KEPT[symbol % 4][state] if edit == "K" else FORCED[state]


def power(symbol: int, k: int) -> tuple:
    """The matrix of ``2 ** k`` equal rows, kept by the worker."""
    known = worker_state().setdefault("turn powers", {})
    if (symbol, k) not in known:
        known[symbol, k] = _times(power(symbol, k - 1), power(symbol, k - 1)) if k else step(symbol)
    return known[symbol, k]


def advance(symbol: int, n: int, after: tuple) -> tuple:
    """Costs before ``n`` equal rows from the costs after them."""
    while n:
        k = (n & -n).bit_length() - 1
        after, n = _apply(power(symbol, k), after), n & (n - 1)
    return after


def product(symbols, lengths) -> tuple:
    """The matrix of runs one after another."""
    out = tuple(tuple(0 if i == j else NEVER for j in range(4)) for i in range(4))
    for symbol, n in zip(symbols, lengths):
        k = 0
        while n:
            if n & 1:
                out = _times(out, power(symbol, k))
            n, k = n >> 1, k + 1
    return out


def unroll(symbols, lengths, after: tuple, state: int, last: bool) -> tuple[str, int]:
    """The least audit of a stretch that starts in ``state``, and the state at its end.

    ``after`` are the costs after it; ``last`` says that it ends the conversation."""
    costs = [after]
    for symbol, n in zip(reversed(symbols), reversed(lengths)):
        costs.append(advance(symbol, n, costs[-1]))
    costs.reverse()
    out: list[str] = []
    for k, (symbol, n) in enumerate(zip(symbols, lengths)):
        state = _run(symbol, n, costs[k], costs[k + 1], state, out)
    while last and END[state]:
        out.append("I")
        state = FORCED[state]
    return "".join(out), state


def _run(symbol: int, n: int, before: tuple, after: tuple, state: int, out: list[str]) -> int:
    if n > UNROLLED:
        middle = advance(symbol, n // 2, after)
        state = _run(symbol, n - n // 2, before, middle, state, out)
        return _run(symbol, n // 2, middle, after, state, out)
    costs, matrix = [after], power(symbol, 0)
    for _ in range(n - 1):
        costs.append(_apply(matrix, costs[-1]))
    here = before
    for following in reversed(costs):
        state = _row(symbol, here, following, state, out)
        here = following
    return state


def _row(symbol: int, here: tuple, following: tuple, state: int, out: list[str]) -> int:
    edits = _edits(symbol)
    while True:
        for edit, price in edits:
            if edit > "I" and INSERT + here[FORCED[state]] == here[state]:
                break  # an insert comes before Keep and Rerole
            after = _after(edit, state, symbol)
            if after is not None and price + following[after] == here[state]:
                out.append(edit)
                return after
        out.append("I")
        state = FORCED[state]


def _legal_pairs(initials: np.ndarray) -> int:
    return int(np.isin(initials[:-1] * 4 + initials[1:], [a * 4 + b for a, b in LEGAL]).sum())


def _segments(batches):
    """Sorted rows (part, pos, conv, turn, initial, fault) to one row a segment."""
    names = ["part", "pos", "conv", "turn", "has_conv", "has_turn", "initial", "fault"]

    def row(c: dict, edge: bool) -> dict:
        initial, fault = c["initial"], c["fault"]
        symbol = np.where((fault == 1) | (fault == 2), MUST_GO, initial + 4 * (fault == 3)).astype(np.uint8)
        heads = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]]))
        lengths = np.diff(np.append(heads, len(symbol)))
        turns = c["turn"][c["has_turn"]]
        matrix = [x for r in product(symbol[heads].tolist(), lengths.tolist()) for x in r] if edge else None
        return {
            "seg": int(c["pos"][0]), "part": int(c["part"][0]), "conv": int(c["conv"][0]) if c["has_conv"][0] else None, "edge": edge,
            "symbols": symbol[heads].tobytes(), "lengths": lengths.astype("<i8").tobytes(), "matrix": matrix,
            "blank": int((fault == 1).sum()), "duplicate": int((fault == 2).sum()), "truncated": int((fault == 3).sum()),
            "illegal": len(initial) - 1 - _legal_pairs(initial), "head": int(initial[0]), "tail": int(initial[-1]),
            "low": int(turns[0]) if len(turns) else None, "high": int(turns[-1]) if len(turns) else None, "turns": len(np.unique(turns)),
            "first_turn": int(c["turn"][0]) if c["has_turn"][0] else None, "last_turn": int(c["turn"][-1]) if c["has_turn"][-1] else None,
        }

    held, opening = None, True  # the open segment's rows, and whether it opens its part
    for batch in batches:
        columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
        if held is not None:
            columns = {c: np.concatenate([held[c], columns[c]]) for c in names}
        if not len(columns["pos"]):
            continue
        new_part = columns["part"][1:] != columns["part"][:-1]
        new = new_part | (columns["conv"][1:] != columns["conv"][:-1]) | (columns["has_conv"][1:] != columns["has_conv"][:-1])
        ends = np.flatnonzero(new) + 1
        out, start = [], 0
        for end in ends.tolist():
            closes = bool(new_part[end - 1])
            out.append(row({c: v[start:end] for c, v in columns.items()}, opening or closes))
            start, opening = end, closes
        held = {c: v[start:].copy() for c, v in columns.items()}
        if out:
            yield _table(out, SEGMENT)
    if held is not None:
        yield _table([row(held, True)], SEGMENT)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}


def _table(rows: list[dict], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[name] for r in rows], _TYPES[kind]) for name, kind in fields], [name for name, _ in fields])


def _chained(frame):
    """What follows each border segment of one conversation, and the conversation's counts on the first one's row."""
    import pandas as pd

    rows = frame.sort_values("part").to_dict("records")
    none = lambda x: x is None or x != x  # noqa: E731 - a null
    after, out = END, []
    for r in reversed(rows):
        out.append({"seg": r["seg"], "home": rows[0]["part"], "segs": len(rows), "after": list(after)})
        m = [int(x) for x in r["matrix"]]
        after = _apply(tuple(tuple(m[i : i + 4]) for i in range(0, 16, 4)), after)
    out.reverse()
    counts = {c: sum(int(r[c]) for r in rows) for c in ("blank", "duplicate", "truncated", "illegal", "turns")}
    for x, y in zip(rows[:-1], rows[1:]):
        counts["illegal"] += (int(x["tail"]), int(y["head"])) not in LEGAL
        counts["turns"] -= not none(x["last_turn"]) and not none(y["first_turn"]) and x["last_turn"] == y["first_turn"]
    low, high = ([int(r[c]) for r in rows if not none(r[c])] for c in ("low", "high"))
    counts["gaps"] = max(high) - min(low) + 1 - counts.pop("turns") if low else 0
    for k, r in enumerate(out):
        r |= {"nth": k, "cost": after[START]} | counts
    return pd.DataFrame(out)[[f.split()[0] for f in CHAIN.split(", ")]]


def _paths(batches):
    """Every segment's audit: from the start of its conversation, or, for a later one, from every state."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            symbols, lengths = list(r["symbols"]), np.frombuffer(r["lengths"], "<i8").tolist()
            if r["after"] is None:  # the whole conversation
                first = END
                for symbol, n in zip(reversed(symbols), reversed(lengths)):
                    first = advance(symbol, n, first)
                gaps = r["high"] - r["low"] + 1 - r["turns"] if r["turns"] else 0
                r |= {"after": END, "nth": 0, "segs": 1, "home": r["part"], "gaps": gaps, "cost": first[START]}
            for start in range(4) if r["nth"] else (START,):
                audit, end = unroll(symbols, lengths, tuple(r["after"]), start, r["nth"] == r["segs"] - 1)
                out.append(r | {"start": start, "end": end, "audit": audit})
        if out:
            yield _table(out, PATH)


def _walked(frame):
    """The segments of one conversation that its path takes: (seg, start)."""
    import pandas as pd

    ends = {(int(n), int(s)): (int(seg), int(e)) for seg, n, s, e in zip(frame["seg"], frame["nth"], frame["start"], frame["end"])}
    out, state = [], START
    for n in range(int(frame["nth"].max()) + 1):
        seg, end = ends[n, state]
        out.append((seg, state))
        state = end
    return pd.DataFrame(out, columns=["seg", "start"])


def _repaired(rows_too: bool):
    """Sorted audits and rows to digests, or to the repaired rows."""

    def repaired(batches):
        conv, digest, audit, at, state, place = None, None, None, 0, START, 0
        counts: dict = {}
        done: list[dict] = []
        written: list[tuple] = []

        def put(role: str, text: str):
            nonlocal place
            if rows_too:
                written.append((conv, place, role, text))
            else:
                digest.update(("\n" * (place > 0) + f"{role}:{text}").encode())
            place += 1

        def insert():
            nonlocal state
            state = FORCED[state]
            put("user" if state == U else "assistant", "")

        def finish():
            nonlocal at
            while at < len(audit):  # only inserts are left
                insert()
                at += 1
            done.append(counts | {"conv": conv, "audit": audit, "repaired_sha256": digest.hexdigest()})

        def flush():
            if rows_too and written:
                columns = list(zip(*written))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string()))], ["conv", "place", "role", "text"])
            elif not rows_too and done:
                yield _table(done, RESULT)
            done.clear()
            written.clear()

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("kind", "conv", "role", "text", "audit", *COUNTS)]
            for kind, c, role, text, edits, *numbers in zip(*columns):
                if kind == 0:
                    if audit is not None:
                        finish()
                    conv, digest, audit, at, state, place = c, hashlib.sha256(), edits, 0, START, 0
                    counts = dict(zip(COUNTS, numbers))
                    continue
                while audit[at] == "I":
                    insert()
                    at += 1
                edit, at = audit[at], at + 1
                if edit == "K":
                    state = {"s": S, "u": U, "a": A}[role[0]]
                    put(role, text)
                elif edit == "R":
                    state = FORCED[state]
                    put("user" if state == U else "assistant", text)
                if len(written) >= 10_000:
                    yield from flush()
            yield from flush()
        if audit is not None:
            finish()
        yield from flush()

    return repaired


RESULT = "conv long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with rows dropped, emptied, cut, repeated and reroled by a hash of their key."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = _rows(conversations).withColumn("case", F.crc32(key.cast("binary")) % 20)
    text = F.when(F.col("case") == 1, F.lit("")).when(F.col("case") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("case") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    changed = rows.where("case <> 0").select("conv_id", "turn", F.when(F.col("case") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy"))
    return changed.drop("copy")


def _rows(conversations: DataFrame) -> DataFrame:
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *text)


def _ordered(conversations: DataFrame) -> DataFrame:
    """All rows in order: ``part`` and ``pos`` (ascending over all parts), and the row's faults by itself."""
    stripped = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    rows = _rows(conversations).select(
        F.col("conv_id").alias("conv"), "turn", "role", "text",
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("initial"),
        (stripped == "").alias("blank"), (~F.substring(stripped, -1, 1).isin(".", "!", "?")).alias("cut"),
        F.monotonically_increasing_id().alias("tie"),  # equal rows are alike, but may lie in several parts
    )
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "tie"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie").withColumn("pos", F.monotonically_increasing_id())
    return staged(placed.withColumn("part", F.shiftright("pos", 33)), "turns")


def _audited(rows: DataFrame) -> DataFrame:
    """One row a segment and start that its conversation's path takes, with its audit."""
    first = rows.groupBy("conv", "role", F.sha2("text", 256).alias("same")).agg(F.min("pos").alias("pos"))
    faults = F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(F.col("cut"), 3).otherwise(0)
    marked = rows.select("part", "pos", "conv", "turn", "initial", "blank", "cut").join(first.select("pos", F.lit(1).alias("first")), "pos", "left")
    narrow = marked.select(
        "part", "pos", F.coalesce("conv", F.lit(0)).alias("conv"), F.coalesce("turn", F.lit(0)).alias("turn"),
        F.col("conv").isNotNull().alias("has_conv"), F.col("turn").isNotNull().alias("has_turn"), "initial", faults.alias("fault"),
    )
    segments = staged(narrow.repartition("part").sortWithinPartitions("pos").mapInArrow(_segments, SEGMENT), "segments")
    chains = staged(segments.where("edge").drop("symbols", "lengths", "edge").groupBy("conv").applyInPandas(_chained, CHAIN), "chains")
    # at most two segments a part are at its border
    counts = ("blank", "duplicate", "truncated", "illegal")
    chained = chains.where("segs > 1").select("seg", "home", "nth", "segs", "after", "cost", "gaps", *[F.col(c).alias(f"{c}_all") for c in counts])
    open_paths = segments.drop("matrix", "edge").join(F.broadcast(chained), "seg", "left")
    open_paths = open_paths.select(*[F.coalesce(f"{c}_all", c).alias(c) if c in counts else c for c in open_paths.columns if not c.endswith("_all")])
    paths = staged(open_paths.mapInArrow(_paths, PATH), "paths")
    taken = paths.where("segs > 1").select("seg", "conv", "nth", "start", "end").groupBy("conv").applyInPandas(_walked, "seg long, start int")
    return staged(paths.where("segs = 1").unionByName(paths.where("segs > 1").join(F.broadcast(taken), ["seg", "start"], "left_semi")), "audits")


def _fed(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Each conversation's whole audit and then its rows, in order, in one task."""
    long = audits.where("segs > 1").groupBy("home", "conv", *COUNTS).agg(
        F.min("seg").alias("pos"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", "audit"))), lambda x: x["audit"]), "").alias("audit")
    )
    whole = audits.where("segs = 1").select("home", "conv", F.col("seg").alias("pos"), "audit", *COUNTS).unionByName(long)
    homes = audits.where("segs > 1").select(F.shiftright("seg", 33).alias("p"), F.col("conv").alias("c"), "home")
    homed = rows.join(F.broadcast(homes), (F.col("part") == F.col("p")) & F.col("conv").eqNullSafe(F.col("c")), "left")
    fed = homed.select(F.coalesce("home", "part").alias("home"), "pos", F.lit(1).alias("kind"), "conv", "role", "text").unionByName(
        whole.withColumn("kind", F.lit(0)), allowMissingColumns=True
    )
    return fed.repartition("home").sortWithinPartitions("pos", "kind")


def repair(conversations: DataFrame) -> DataFrame:
    """Each conversation's faults by kind, gaps, cost, audit and the digest of its repaired rows."""
    rows = _ordered(conversations)
    return _fed(rows, _audited(rows)).mapInArrow(_repaired(False), RESULT).withColumnRenamed("conv", "conv_id")


def repaired_rows(conversations: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role and text."""
    rows = _ordered(conversations)
    return _fed(rows, _audited(rows)).mapInArrow(_repaired(True), "conv long, place long, role string, text string").withColumnRenamed("conv", "conv_id")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The repair of ``damaged`` rows for every conversation of the table, also those that lost all rows."""
    found = repair(damaged(conversations))
    ids = conversations.select(F.col("conv_id").cast("long").alias("id")).distinct()
    both = ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS]
    texts = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")]
    return both.select(F.col("id").alias("conv_id"), *zeros, *texts)
