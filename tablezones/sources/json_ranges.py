"""Records of JSON array documents, read by byte ranges.

A document is split at closing braces, which every record has, so Spark's text
source deals the ranges of one large file to many tasks. What a range means
depends on the quotes and braces before it. So each range is summed up as a
function of its start: outside or inside a string, and the depth; the functions
compose over the ranges of a file, and then every range knows its own start and
its byte offset. The second pass gives whole records; pieces of a record that
crosses ranges are put together by file and order.

*Resynchronisation.* What stands between the first two records of a document is
its separator. If that has a line break, which no string can hold, a closing
brace, the separator and an opening brace always begin a record, whatever came
before; so an unclosed string, brace or bracket spoils its own record alone (two rows of
it if it seems to be over where a range ends). In a document without line breaks, or whose first range ends before the separator,
the damage ends where the depth is right again.

Records are JSON objects; anything else between them comes out as a record of
its own or with the next one, and fails to parse. A document may also be a single
object. Empty files have no records. Compressed files are one range.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablezones.functions.fields import column
from tablezones.sources._paths import resolving
from tablezones.sources.json import CORRUPT_COLUMN, NTZ_FORMAT, with_corrupt_column

#: Where a record is from, beside its own columns.
RECORD_COLUMNS = ("_file", "_modified", "_offset")
_HEAD = "file string, base int, gap string"
_SUMMARY = "file string, block long, bytes long, known boolean, quoted0 boolean, depth0 long, quoted1 boolean, depth1 long"
_PIECE = "file string, modified timestamp, block long, kind int, offset long, text string"
WHOLE, OPENS, INSIDE, CLOSES = range(4)


def _machine():
    """The scanner's functions, made in one closure so that they ship to workers by value."""
    token = re.compile(r'"(?:[^"\\\n]|\\[^\n])*"|\\.|["{}\[\]]', re.S)
    in_string = re.compile(r'\\.|["\n]', re.S)

    def after(piece: str, quoted: bool, depth: int) -> tuple[bool, int]:
        """The state behind ``piece`` and the brace that ends it."""
        at = 0
        while True:
            if quoted:  # to the closing quote, or the line's end, which no string goes beyond
                at = next((m.end() for m in in_string.finditer(piece, at) if m.group()[-1] == "\n" or m.group() == '"'), -1)
                if at < 0:
                    return True, depth
                quoted = False
            for m in token.finditer(piece, at):
                c = m.group()
                if c == '"':  # not closed in this line
                    quoted, at = True, m.end()
                    break
                if len(c) == 1:
                    depth += 1 if c in "{[" else -1
            else:
                return False, depth - 1

    def resumes(piece: str, gap: str | None) -> bool:
        return bool(gap) and "\n" in gap and piece.startswith(gap + "{")

    def opening(piece: str) -> tuple[int, int]:
        """Depth of a document's records, and where its first one starts."""
        head = re.match(r"[﻿\s]*(\[?)\s*", piece)
        return len(head.group(1)), head.end()

    return after, resumes, opening


def _ranges(batches) -> Iterator[tuple[tuple, list[str], bool, bool]]:
    """Pieces by (file, modified, block, file size), in order: key, some pieces, first and last of the range."""
    key, held = None, None
    for batch in batches:
        files, times, blocks, sizes, values = (batch.column(c).to_pylist() for c in ("file", "modified", "block", "size", "value"))
        a = 0
        for b in range(1, len(values) + 1):
            if b < len(values) and files[b] == files[a] and blocks[b] == blocks[a]:
                continue
            here = (files[a], times[a], blocks[a], sizes[a])
            if held is not None:
                yield key, held[0], held[1], here != key
            held = values[a:b], here != key
            key, a = here, b
    if held is not None:
        yield key, held[0], held[1], True


def _heads():
    """Record depth and separator of each document, from its first range."""
    after, _, opening = _machine()
    ranges = _ranges

    def heads(batches):
        for key, pieces, first, last in ranges(batches):
            if first:
                base, gap, state = opening(pieces[0])[0], None, (False, 0)
            for k, piece in enumerate(pieces):
                if gap is not None:
                    break
                if (k or not first) and state == (False, base) and "{" in piece:
                    gap = piece[: piece.index("{")]
                state = after(piece, *state)
            if last:
                yield pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([base], pa.int32()), pa.array([gap], pa.string())], ["file", "base", "gap"])

    return heads


def _summed(heads: dict):
    after, resumes, _ = _machine()
    ranges = _ranges

    def summed(batches):
        for key, pieces, first, last in ranges(batches):
            base, gap = heads.get(key[0], (0, None))
            if first:
                states, known, size = [(False, 0), (True, 0)], False, 0
            for piece in pieces:
                size += len(piece.encode()) + 1
                if gap and "\n" in gap and (i := piece.rfind(gap + "{")) >= 0:
                    piece, states, known = piece[i:], [(False, base)] * 2, True
                states = [after(piece, *s) for s in states] if states[0] != states[1] else [after(piece, *states[0])] * 2
            if last:
                row = [key[0], key[2], size, known, *states[0], *states[1]]
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64()]
                names = ["file", "block", "bytes", "known", "quoted0", "depth0", "quoted1", "depth1"]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names)

    return summed


def _started(summaries: list, heads: dict) -> dict[tuple[str, int], tuple[bool, int, int, int, str | None]]:
    """Each range's start: in a string, depth, byte offset, and its document's record depth and separator."""
    out = {}
    file = None
    for r in sorted(summaries, key=lambda r: (r["file"], r["block"])):
        if r["file"] != file:
            file, quoted, depth, offset = r["file"], False, 0, 0
        out[file, r["block"]] = (quoted, depth, offset, *heads[file])
        end = (r["quoted1"], r["depth1"]) if quoted else (r["quoted0"], r["depth0"])
        quoted, depth = end[0], end[1] + (0 if r["known"] else depth)
        offset += r["bytes"]
    return out


def _cut(starts: dict):
    after, resumes, opening = _machine()
    ranges = _ranges

    def parts(piece: str, gap: str | None) -> Iterator[tuple[str, bool]]:
        """``piece`` cut where records resume within it, behind one without a brace; and whether a brace follows."""
        while gap and "\n" in gap and (i := piece.find(gap + "{", 1)) > 0:
            yield piece[:i], False
            piece = piece[i:]
        yield piece, True

    def cut(batches):
        rows: list[tuple] = []

        def give():
            kinds = [pa.string(), pa.timestamp("us", "UTC"), pa.int64(), pa.int32(), pa.int64(), pa.string()]
            names = ["file", "modified", "block", "kind", "offset", "text"]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
            rows.clear()
            return batch

        for key, pieces, first, last in ranges(batches):
            if first:
                quoted, depth, at, base, gap = starts.get((key[0], key[2])) or (False, 0, 0, opening(pieces[0])[0], None)
                crosses = key[2] > 0 and (quoted or depth > base)
                open_text: list[str] = []
                begun, closed = at, False
            for k, whole in enumerate(pieces):
                for piece, braced in parts(whole, gap):
                    size = len(piece.encode())
                    ends = braced and last and k == len(pieces) - 1 and at + size == key[3]  # the file ends here, without a brace
                    braced = braced and not ends
                    again = (k or not first or key[2] > 0) and resumes(piece, gap)
                    skip = 0
                    if closed:  # by depth; with a line break in the separator, only that or the end makes it final
                        if gap is None and "{" in piece:
                            gap = piece[: piece.index("{")]
                        if again or resumes(piece, gap) or "\n" not in (gap or "") or ends and piece.strip() in ("", "]"):
                            rows.append((*key[:3], CLOSES if crosses else WHOLE, begun, "".join(open_text)))
                            open_text, crosses, depth = [], False, base
                        closed = False
                    if again and (open_text or crosses):  # what is open is a broken record
                        rows.append((*key[:3], CLOSES if crosses else WHOLE, begun, "".join(open_text)))
                        open_text, crosses = [], False
                    if not open_text and not crosses:  # between records
                        if first and k == 0 and key[2] == 0:
                            skip = opening(piece)[1]
                        else:
                            if gap is None and "{" in piece:
                                gap = piece[: piece.index("{")]
                            skip = len(piece) - len(piece.lstrip(" \t\r\n,"))
                        begun = at + len(piece[:skip].encode())
                    if again:
                        quoted, depth = False, base
                    quoted, depth = after(piece, quoted, depth)
                    body = piece[skip:]
                    at += size + braced
                    if not braced:
                        depth += not quoted
                        if not open_text and not crosses and body.strip() in ("", "]"):
                            continue
                    open_text.append(body + "}" * braced)
                    closed = braced and not quoted and depth <= base
                    if len(rows) >= 5_000:
                        yield give()
            if last and (open_text or crosses):
                alone = (key[0], key[2]) not in starts  # the document's only range: what is open stays so
                kind = (CLOSES if crosses else WHOLE) if closed or alone else (INSIDE if crosses else OPENS)
                rows.append((*key[:3], kind, begun, "".join(open_text)))
        if rows:
            yield give()

    return cut


def json_records(spark: SparkSession, path) -> DataFrame:
    """The records of every JSON document under ``path``: file, modified, byte offset and text.

    One row on the driver for each range of a file of several ranges, as the scan's own plan has."""
    text = resolving(path, lambda: spark.read.option("lineSep", "}").text(path))
    meta = "_metadata.file_"
    pieces = text.select(
        F.col(f"{meta}path").alias("file"), F.col(f"{meta}modification_time").alias("modified"), F.col(f"{meta}block_start").alias("block"),
        (F.col(f"{meta}block_length") < F.col(f"{meta}size")).alias("several"), F.col(f"{meta}size").alias("size"), "value",
    )
    several = pieces.where("several").drop("several")
    heads = {r["file"]: (r["base"], r["gap"]) for r in several.where("block = 0").mapInArrow(_heads(), _HEAD).collect()}
    starts = _started(several.mapInArrow(_summed(heads), _SUMMARY).collect(), heads) if heads else {}
    cut = pieces.drop("several").mapInArrow(_cut(starts), _PIECE)
    whole = cut.where(F.col("kind") == WHOLE).select("file", "modified", "offset", "text")
    if not starts:
        return whole
    parts = cut.where(F.col("kind") != WHOLE)  # two of each range at most
    order = Window.partitionBy("file").orderBy("block", F.col("kind") == OPENS)
    numbered = parts.withColumn("nth", F.sum((F.col("kind") == OPENS).cast("int")).over(order))
    together = numbered.groupBy("file", "modified", "nth").agg(
        F.min_by("offset", F.struct("block", F.col("kind") == OPENS)).alias("offset"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", (F.col("kind") == OPENS).alias("opens"), "text"))), lambda x: x["text"]), "").alias("text"),
    )
    return whole.unionByName(together.select("file", "modified", "offset", "text"))


def parsed_records(records: DataFrame, schema: StructType | str) -> DataFrame:
    """``records`` as the schema's columns, with ``_corrupt_record`` and the record's ``_file``, ``_modified`` and ``_offset``."""
    full = with_corrupt_column(schema)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN, "timestampNTZFormat": NTZ_FORMAT}
    parsed = records.select(F.from_json("text", full, options).alias("r"), *[F.col(c).alias(f"_{c}") for c in ("file", "modified", "offset")])
    return parsed.select("r.*", "_file", "_modified", "_offset")


def broken_records(parsed: DataFrame) -> DataFrame:
    """The malformed records of ``read_json_ranges``, as ``quarantined`` lists malformed documents."""
    fields = F.struct(*[column(c) for c in parsed.columns if c not in (CORRUPT_COLUMN, *RECORD_COLUMNS)])
    bad = parsed.where(column(CORRUPT_COLUMN).isNotNull())
    return bad.select(*[F.col(c).alias(c[1:]) for c in RECORD_COLUMNS], column(CORRUPT_COLUMN).alias("text"), F.to_json(fields).alias("parsed"))


def read_json_ranges(spark: SparkSession, path, schema: StructType | str) -> DataFrame:
    """Every record of the array documents under ``path``; a broken one alone is malformed."""
    return parsed_records(json_records(spark, path), schema)
