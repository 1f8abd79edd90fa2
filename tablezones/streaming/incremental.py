"""The structure + transform stages as an incremental Structured Streaming job.

One stream reads the raw zone. It parses every landed JSON document once (the
file source remembers them in the checkpoint) and appends its rows, malformed
documents included, to a parsed table. Two more streams follow that table: the
same row-wise plan as the batch job appends the good rows to the trusted table,
and malformed documents go to the quarantine table with file name and text. All
three write with the exactly-once file sink. Since only the first one sees the
raw zone, a file that lands or is archived at any moment reaches either both
followers or neither. ``trigger(availableNow=True)`` makes a scheduled run
process what has arrived and stop, so a daily run reads only new files instead
of the whole raw zone. The plans are stateless: nothing accumulates in the
state store.

The checkpoint belongs to the targets: the sink skips batches that it has
already committed, so a run with another checkpoint would lose its files.
Therefore it has no default; name a folder in shared storage and keep it, and
the parsed table with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from tablezones.functions.fields import column
from tablezones.plans.countries import COUNTRIES, CountryRules, transform_countries
from tablezones.sinks.guards import path_exists
from tablezones.sources.json import CORRUPT_COLUMN, NTZ_FORMAT, file_key, with_corrupt_column
from tablezones.sources.parquet import read_parquet


def _origin(schema: StructType) -> str:
    """The parsed table's column for file name and modification time, a name that no field has."""
    taken = {name.lower() for name in schema.fieldNames()}
    name = "_document"
    while name in taken:
        name += "_"
    return name


def _start(out: DataFrame, target: str, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = out.writeStream.format("parquet").outputMode("append").option("path", target).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def start_parse(
    spark: SparkSession,
    raw_dir: str,
    parsed_dir: str,
    schema: StructType,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    archive_dir: str | None = None,
) -> StreamingQuery:
    """Append the rows of every newly landed document to ``parsed_dir``, malformed ones in ``_corrupt_record``.

    ``archive_dir`` moves processed raw files there (those of a batch once a
    later batch commits, so the newest files wait for the next run), keeping
    the raw zone and its listing per trigger small."""
    reader = (
        spark.readStream.schema(with_corrupt_column(schema))
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("timestampNTZFormat", NTZ_FORMAT)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return _start(reader.json(raw_dir).select("*", F.struct(*file_key()).alias(_origin(schema))), parsed_dir, checkpoint, available_now)


def _parsed(spark: SparkSession, parsed_dir: str, schema: StructType) -> DataFrame:
    origin = StructType([StructField("file", StringType()), StructField("modified", TimestampType())])
    return spark.readStream.schema(StructType([*with_corrupt_column(schema).fields, StructField(_origin(schema), origin)])).parquet(parsed_dir)


def start_quarantine(spark: SparkSession, parsed_dir: str, quarantine_dir: str, schema: StructType, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append the file, text and parsed fields of every malformed document to ``quarantine_dir``."""
    bad = _parsed(spark, parsed_dir, schema).where(column(CORRUPT_COLUMN).isNotNull())
    fields = F.struct(*[column(c) for c in schema.fieldNames() if c != CORRUPT_COLUMN])
    out = bad.select(f"{_origin(schema)}.*", F.lit(0).cast("long").alias("offset"), column(CORRUPT_COLUMN).alias("text"), F.to_json(fields).alias("parsed"))
    return _start(out, quarantine_dir, checkpoint, available_now)


def start_incremental_transform(
    spark: SparkSession,
    parsed_dir: str,
    trusted_dir: str,
    schema: StructType,
    checkpoint: str,
    rules: CountryRules = COUNTRIES,
    available_now: bool = True,
) -> StreamingQuery:
    """Append the transformed good rows to ``trusted_dir``; call ``awaitTermination()`` on the result to wait."""
    good = _parsed(spark, parsed_dir, schema).where(column(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN, _origin(schema))
    return _start(transform_countries(good, rules), trusted_dir, checkpoint, available_now)


def _rows(spark: SparkSession, path: str) -> int:
    """Rows of a streaming target by its footers; 0 before its first run."""
    if not path_exists(spark, path):
        return 0
    try:
        return read_parquet(spark, path).count()
    except Exception as exc:
        if "unable to infer schema" in str(exc).lower().replace("_", " "):  # a first run without rows
            return 0
        raise


def run_incremental_transform(
    spark: SparkSession,
    raw_dir: str,
    trusted_dir: str,
    schema: StructType,
    checkpoint: str,
    quarantine_dir: str | None = None,
    parsed_dir: str | None = None,
    rules: CountryRules = COUNTRIES,
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
) -> dict:
    """Process everything landed so far, then stop. Returns the last progress
    of the transform plus this run's ``rows`` and ``corrupt_rows``, which are
    counted in the targets before and after, so they are complete for any
    number of batches. A run that stopped half-way is completed by the next."""
    root, target = checkpoint.rstrip("/"), trusted_dir.rstrip("/")
    if path_exists(spark, f"{root}/transform"):
        raise ValueError(f"{checkpoint} belongs to a job that read the raw zone twice; use a fresh checkpoint and fresh targets")
    aside, parsed = quarantine_dir or f"{target}_quarantine", parsed_dir or f"{target}_parsed"
    before = _rows(spark, trusted_dir), _rows(spark, aside)
    start_parse(spark, raw_dir, parsed, schema, f"{root}/parse", max_files_per_trigger, archive_dir=archive_dir).awaitTermination()
    last = None
    if path_exists(spark, parsed):  # something has landed
        start_quarantine(spark, parsed, aside, schema, f"{root}/quarantine").awaitTermination()
        query = start_incremental_transform(spark, parsed, trusted_dir, schema, f"{root}/trusted", rules)
        query.awaitTermination()
        last = query.lastProgress
    return {**(dict(last) if last else {}), "rows": _rows(spark, trusted_dir) - before[0], "corrupt_rows": _rows(spark, aside) - before[1]}
