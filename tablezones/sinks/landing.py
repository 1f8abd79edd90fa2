"""Raw landing zone writers.

``land_json_documents`` writes JSON array documents (``[`` rec ``,`` rec ...
``]``), the layout a document feed arrives in. A document is read by one task,
as a whole, so each is bounded by records and by bytes and is a file of its
own. Records are JSON-encoded by ``to_json`` in the JVM; a small per-partition
Arrow step only joins them, holding one document at a time; nothing is grouped
or shuffled, however large or skewed a partition is.

Both writers replace the target by write-then-swap (see ``guards``). A landing
without rows keeps the zone that is there.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablezones.functions.fields import column
from tablezones.sinks.guards import path_exists, refuse_self_overwrite, replace_folder
from tablezones.sinks.parquet import observed
from tablezones.sinks.report import WriteReport
from tablezones.sources.json import NTZ_FORMAT

DEFAULT_RECORDS_PER_DOCUMENT = 50_000
DEFAULT_BYTES_PER_DOCUMENT = 32 << 20


def _as_documents(per_doc: int, max_bytes: int = DEFAULT_BYTES_PER_DOCUMENT):
    """The per-partition framing step: one row is one document. Built as a
    closure so it is shipped to workers by value: they need pyarrow, not this
    package. A record larger than the bound is a document of its own."""

    def document(records):
        return pa.RecordBatch.from_arrays([pa.array(["[" + "\n,".join(records) + "\n]"], pa.string())], ["value"])

    def frame(batches):
        held, size = [], 0
        for batch in batches:
            for record in batch.column(0).to_pylist():
                if held and (len(held) == per_doc or size + len(record) > max_bytes):
                    yield document(held)
                    held, size = [], 0
                held.append(record)
                size += len(record) + 2
        if held:
            yield document(held)

    return frame


def json_records(df: DataFrame) -> DataFrame:
    """One JSON object text per row (NULL fields dropped, like ``to_json``)."""
    record = F.struct(*[column(c) for c in df.columns])
    return df.select(F.to_json(record, {"timestampNTZFormat": NTZ_FORMAT}).alias("value"))


def _landed(df: DataFrame, path: str, mode: str, inputs: Sequence[str], write, obs) -> WriteReport:
    if mode == "overwrite":
        refuse_self_overwrite(df.sparkSession, path, inputs)
        first = not path_exists(df.sparkSession, path)

        def landed(folder: str) -> bool:
            write("errorifexists", folder)
            return first or int(obs.get["rows"]) > 0

        written = replace_folder(df.sparkSession, path, landed)
    else:
        write(mode, path)
        written = True
    return WriteReport(path, written, dict(obs.get), df.schema)


def land_json_documents(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    records_per_document: int = DEFAULT_RECORDS_PER_DOCUMENT,
    compression: str | None = None,
    bytes_per_document: int = DEFAULT_BYTES_PER_DOCUMENT,
    inputs: Sequence[str] = (),
) -> WriteReport:
    """Write ``df`` as JSON array documents, one per file, each of at most
    ``records_per_document`` records and about ``bytes_per_document`` characters;
    ``compression`` e.g. 'gzip' (a document is read whole by one task either
    way). The report has the rows and their schema."""
    if records_per_document < 1 or bytes_per_document < 1:
        raise ValueError("a document's bounds must be positive")
    records, obs = observed(json_records(df), "landing")
    docs = records.mapInArrow(_as_documents(records_per_document, bytes_per_document), "value string")
    options = {"maxRecordsPerFile": 1, **({"compression": compression} if compression else {})}
    return _landed(df, path, mode, inputs, lambda how, to: docs.write.mode(how).options(**options).text(to), obs)


def land_json_lines(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None, inputs: Sequence[str] = ()) -> WriteReport:
    """Write ``df`` as JSON lines (splittable on read unless compressed with a
    non-splittable codec such as gzip). The report has the rows and their schema."""
    frame, obs = observed(df, "landing")
    options = {"timestampNTZFormat": NTZ_FORMAT, **({"compression": compression} if compression else {})}
    return _landed(df, path, mode, inputs, lambda how, to: frame.write.mode(how).options(**options).json(to), obs)
