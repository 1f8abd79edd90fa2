"""Token ids as flat binary files with 64-bit document offsets.

Each part is three files: ``.ids`` (unsigned integers, 16 bits wide when the
vocabulary fits, else 32), ``.idx`` (unsigned 64-bit offsets, one more than
documents) and ``.docs`` (signed 64-bit document ids). Parts are ranges of
ascending document ids. A part's base, the ids in all parts before it, is a
prefix sum over the parts' totals, kept with them in a manifest table. Files
are written under a temporary name and renamed, so a repeated task is harmless.

Texts are encoded before the exchange, which carries ids of the file's width, and
the tasks that write files need no tokenizer. The parts' bounds are quantiles of
the document ids, read in a narrow pass of their own, so that nothing is encoded
twice; an id that holds more rows than a part is split by its texts' hashes.

Null texts are empty documents of one end id; null document ids come first.
Repeated document ids are separate documents, ordered by their text's hash.
An empty table gives no part files and an empty result. Other columns are not
written.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablezones.llm.batches import pieces
from tablezones.llm.staging import commit_file, shared_file_folder, staged
from tablezones.llm.text_ids import PIECE, crc32, encoder, tokenizer_path

MANIFEST = "part int, n_docs long, n_null long, n_ids long, width int"
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"
ENCODED = "doc_id long, place long, part int, width int, ids binary"
LEAST_ID = -(1 << 63)


def part_of(ids: np.ndarray, place: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The part of each row in order of (id, place): parts end at ``bounds``, repeated ones split an id by place."""
    low = np.searchsorted(bounds, ids, "left")
    share = ((place.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(11)) / float(1 << 53)
    return (low + np.floor(share * (np.searchsorted(bounds, ids, "right") - low + 1))).astype(np.int32)


def _encoded(tokenizer: str, end_id: int, bounds: np.ndarray):
    def encode(batches):
        coder = encoder(tokenizer)
        width = 2 if max(len(coder.opens), end_id + 1) <= 1 << 16 else 4
        for batch in batches:
            for rows, _, _ in pieces(batch, "text", PIECE):
                ids, to = coder.encode(rows.column("text"))
                ids = np.insert(ids, to[1:], end_id).astype(f"<u{width}")
                ends = np.concatenate([[0], (to[1:] + np.arange(1, len(to))) * width])
                texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(ends.astype("<i8")), pa.py_buffer(ids)])
                docs, place = rows.column("doc_id"), rows.column("place")
                part = part_of(docs.fill_null(LEAST_ID).to_numpy(zero_copy_only=False), place.to_numpy(zero_copy_only=False), bounds)
                yield pa.RecordBatch.from_arrays([docs, place, pa.array(part), pa.array(np.full(len(rows), width, np.int32)), texts.cast(pa.binary())], ["doc_id", "place", "part", "width", "ids"])

    return encode


def _writer(folder: str):
    def write(batches):
        import os

        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"{folder}/part-{task.partitionId():06d}"
        tmp = f"{name}.{task.taskAttemptId()}.tmp"
        at = n_docs = n_null = width = 0
        os.makedirs(folder, exist_ok=True)
        with open(f"{tmp}ids", "wb") as ids_file, open(f"{tmp}idx", "wb") as idx_file, open(f"{tmp}docs", "wb") as docs_file:
            np.zeros(1, "<u8").tofile(idx_file)
            for batch in batches:
                if not len(batch):
                    continue
                width = batch.column("width")[0].as_py()
                ids = batch.column("ids").cast(pa.large_binary())
                ends = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset :][: len(ids) + 1]
                ids_file.write(memoryview(ids.buffers()[2])[ends[0] : ends[-1]])
                (at + (ends[1:] - ends[0]) // width).astype("<u8").tofile(idx_file)
                docs = batch.column("doc_id")
                n_null += docs.null_count
                docs.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tofile(docs_file)
                at += int(ends[-1] - ends[0]) // width
                n_docs += len(batch)
        if n_docs:
            for kind in ("ids", "idx", "docs"):
                commit_file(f"{tmp}{kind}", f"{name}.{kind}")
            yield pa.RecordBatch.from_pydict({"part": pa.array([task.partitionId()], pa.int32()), "n_docs": [n_docs], "n_null": [n_null], "n_ids": [at], "width": pa.array([width], pa.int32())})
        else:
            for kind in ("ids", "idx", "docs"):
                os.unlink(f"{tmp}{kind}")

    return write


def write_token_files(documents: DataFrame, tokenizer: str | None = None, end_id: int = 0) -> tuple[str, DataFrame]:
    """Encode ``documents`` (doc_id, text) into part files; their folder and manifest."""
    folder = shared_file_folder(documents.sparkSession, "token-files")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = max(1, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    at = F.percentile_approx(F.coalesce("doc_id", F.lit(LEAST_ID)), [k / n for k in range(1, n)] or [0.5], 100 * n)
    bounds = np.array((rows.select(at.alias("at")).first()["at"] or [])[: n - 1], np.int64)
    coded = rows.withColumn("place", F.xxhash64("text")).mapInArrow(_encoded(tokenizer or tokenizer_path(), end_id, bounds), ENCODED)
    parts = coded.repartitionById(n, F.col("part")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "place").select("doc_id", "width", "ids")
    manifest = staged(parts.mapInArrow(_writer(folder), MANIFEST), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    return folder, manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _reader(folder: str):
    def read(batches):
        for batch in batches:
            for p in batch.to_pylist():
                name = f"{folder}/part-{p['part']:06d}"
                ids = np.memmap(f"{name}.ids", f"<u{p['width']}", "r") if p["n_ids"] else np.zeros(0, "<u2")
                at = np.memmap(f"{name}.idx", "<u8", "r").astype(np.int64)
                docs = np.memmap(f"{name}.docs", "<i8", "r")
                for i in range(0, p["n_docs"], 10_000):
                    to = min(i + 10_000, p["n_docs"])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(docs[i:to], pa.int64(), mask=np.arange(i, to) < p["n_null"]),
                            pa.array(p["base"] + at[i:to]),
                            pa.array(at[i + 1 : to + 1] - at[i:to]),
                            pa.array([crc32(ids[a:b]) for a, b in zip(at[i:to], at[i + 1 : to + 1])], pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return read


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Every document as found in the memory-mapped files: its global start, length and checksum."""
    parts = manifest.repartition(max(1, manifest.count()), "part")
    return parts.mapInArrow(_reader(folder), RESULT)
