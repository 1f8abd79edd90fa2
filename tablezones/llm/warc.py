"""WARC archives as a chunked record table.

A payload is a run of rows (record, chunk number, bytes) of at most
``CHUNK_BYTES``; Python never holds a whole record. The writer streams the
chunks of each record into one archive per task, with an incremental SHA-1 that
must equal the digest in the record's header at its end. The reader streams the
archives back the same way and carries the digest and the length from chunk to
chunk, so the last chunk of a record has those of the whole payload.

Every record is its own gzip member, so archives can be read from any record.
Payloads of ``REVISIT_BYTES`` or more that are equal are stored once: the page
with the largest id is the response, the others are revisits that refer to it
and have no payload. Their payload's length stands in an extension field.

A null html is an empty payload; a null url is an empty target; a row with a
null page_id gets no archive record and no result. Rows of one page_id are
records of their own. An empty table gives no archive and an empty result.
Other columns are not read. Archives are written under a temporary name and
renamed, so a repeated task writes the same file again.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablezones.llm.staging import commit_file, shared_file_folder, small_side, staged

CHUNK_BYTES, REVISIT_BYTES, LEVEL = 256 << 10, 1000, 1
READ_BYTES = 256 << 10
DATE = "1970-01-01T00:00:00Z"  # archives are a function of their pages alone
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
FILES = "archive string, records long"
CHUNKS = "page_id long, record_type string, refers_to long, chunk int, last boolean, data binary, payload_bytes long, payload_digest string"


def chunk_rows(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row for each chunk of each page's payload, with the payload's length, digest and record kind."""
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.where(F.col("page_id").isNotNull()).select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), body.alias("body"))
    rows = rows.withColumn("digest", F.sha1("body")).withColumn("size", F.octet_length("body").cast("long"))
    large = rows.where(F.col("size") >= REVISIT_BYTES)
    repeated = large.groupBy("digest", "size").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    repeated = small_side(staged(repeated, "repeated-payloads"))
    marked = rows.join(repeated, ["digest", "size"], "left")
    revisit = F.col("first").isNotNull() & (F.col("first") != F.col("page_id"))
    marked = marked.withColumn("refers_to", F.when(revisit, F.col("first")))
    stored = F.when(revisit, 1).otherwise(F.greatest(F.lit(1), F.ceil(F.col("size") / chunk_bytes)))
    cut = marked.withColumn("chunk", F.explode(F.sequence(F.lit(0), stored.cast("int") - 1)))
    data = F.when(F.col("refers_to").isNotNull(), F.lit(b"")).otherwise(F.substring("body", F.col("chunk") * chunk_bytes + 1, F.lit(chunk_bytes)))
    return cut.select("page_id", "url", "digest", "size", "refers_to", "chunk", (F.col("chunk") == stored - 1).alias("last"), data.alias("data"))


def _head(page_id: int, url: str, digest: str, size: int, refers_to: int | None) -> bytes:
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", " ".join(url.split())),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(size)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(HTTP) + (size if refers_to is None else 0))),
    ]
    if refers_to is not None:
        fields.insert(2, ("WARC-Refers-To", f"<urn:page:{refers_to}>"))
        fields.insert(3, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def _writer(folder: str):
    def write(batches):
        import os

        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"{folder}/part-{task.partitionId():06d}.warc.gz"
        tmp = f"{name}.{task.taskAttemptId()}.tmp"
        os.makedirs(folder, exist_ok=True)
        records = 0
        with open(tmp, "wb") as out:
            for batch in batches:
                for i in range(len(batch)):
                    page_id, url, digest, size, refers_to, chunk, last = (batch.column(k)[i].as_py() for k in range(7))
                    if chunk == 0:
                        member, state = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), hashlib.sha1()
                        out.write(member.compress(_head(page_id, url, digest, size, refers_to) + HTTP))
                    data = memoryview(batch.column(7)[i].as_buffer())
                    state.update(data)
                    out.write(member.compress(data))
                    if last:
                        if refers_to is None and state.hexdigest() != digest:
                            raise OSError(f"page {page_id}: the chunks don't make up its payload")
                        out.write(member.compress(b"\r\n\r\n"))
                        out.write(member.flush())
                        records += 1
        if records:
            commit_file(tmp, name)
            yield pa.RecordBatch.from_pydict({"archive": [name], "records": [records]})
        else:
            os.unlink(tmp)

    return write


def write_archives(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives; a table of the archives and their records."""
    folder = shared_file_folder(pages.sparkSession, "warc")
    return staged(chunk_rows(pages, chunk_bytes).mapInArrow(_writer(folder), FILES), "warc-archives")


class _Members:
    """The plain bytes of an archive's gzip members, read in bounded steps."""

    def __init__(self, raw: BinaryIO):
        self.raw, self.rest, self.member, self.plain = raw, b"", None, b""

    def _more(self) -> bool:
        while True:
            if self.member is None or self.member.eof:
                self.rest = (self.member.unused_data if self.member else b"") or self.rest or self.raw.read(READ_BYTES)
                if not self.rest:
                    return False
                self.member = zlib.decompressobj(31)
            elif not self.rest:
                self.rest = self.raw.read(READ_BYTES)
                if not self.rest:
                    raise EOFError("an archive ends within a record")
            got = self.member.decompress(self.rest, READ_BYTES)
            self.rest = self.member.unconsumed_tail
            if got:
                self.plain += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        """The bytes through ``mark``, or None at the end of the archive."""
        while (at := self.plain.find(mark)) < 0:
            if not self._more():
                if self.plain.strip():
                    raise EOFError("an archive ends within a header")
                return None
        got, self.plain = self.plain[: at + len(mark)], self.plain[at + len(mark) :]
        return got

    def take(self, n: int) -> bytes:
        """Exactly ``n`` bytes."""
        while len(self.plain) < n:
            if not self._more():
                raise EOFError("an archive ends within a payload")
        got, self.plain = self.plain[:n], self.plain[n:]
        return got


def read_records(raw: BinaryIO, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple]:
    """Rows of ``CHUNKS`` from one archive, with the running length and digest of each payload."""
    members = _Members(raw)
    while (head := members.until(b"\r\n\r\n")) is not None:
        lines = head.decode().lstrip("\r\n").split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"not a WARC record: {lines[0][:40]}")
        fields = dict(line.split(": ", 1) for line in lines[1:] if line)
        number = lambda k: int(fields[k].removeprefix("<urn:page:").removesuffix(">"))
        page_id, kind, digest = number("WARC-Record-ID"), fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
        left = int(fields["Content-Length"]) - len(members.until(b"\r\n\r\n"))
        if kind == "revisit":
            yield page_id, kind, number("WARC-Refers-To"), 0, True, b"", int(fields["X-Payload-Length"]), digest
        else:
            state, done, chunk = hashlib.sha1(), 0, 0
            while True:
                data = members.take(min(chunk_bytes, left - done))
                state.update(data)
                done += len(data)
                last = done == left
                if last and state.hexdigest() != digest:
                    raise ValueError(f"page {page_id}: the payload doesn't match its digest")
                yield page_id, kind, None, chunk, last, data, done, state.hexdigest()
                chunk += 1
                if last:
                    break
        members.take(4)


def _reader(chunk_bytes: int, payloads: bool):
    def read(batches):
        schema = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("chunk", pa.int32()), ("last", pa.bool_()), ("data", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        rows, held = [], 0
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                with open(archive, "rb") as raw:
                    for row in read_records(raw, chunk_bytes):
                        if not payloads:
                            if not row[4]:
                                continue
                            row = (*row[:5], None, *row[6:])
                        rows.append(row)
                        held += len(row[5] or b"") + 200
                        if held > 4 << 20:
                            yield table(rows)
                            rows, held = [], 0
        if rows:
            yield table(rows)

    return read


def read_chunks(spark: SparkSession, archives: DataFrame, chunk_bytes: int = CHUNK_BYTES, payloads: bool = True) -> DataFrame:
    """The archives' chunked record table; without ``payloads`` only each record's last row, without its bytes."""
    parts = archives.select("archive").repartition(max(1, archives.count()), "archive")
    return parts.mapInArrow(_reader(chunk_bytes, payloads), CHUNKS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives and list every record found in them."""
    records = read_chunks(pages.sparkSession, write_archives(pages), payloads=False)
    return records.where("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
