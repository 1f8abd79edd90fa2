"""Zone-to-zone jobs: raw JSON -> foundation Parquet -> trusted Parquet -> table.

Each stage is one read, one lazily built plan and one observed write to a
fresh folder, which takes the zone's place only if it has rows; counts come
from the write itself. Stages raise on failure, so a later stage never runs on
stale or missing data. A stage hands the schema of what it wrote to the next.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablezones.errors import CorruptInputError, EmptyInputError
from tablezones.functions.fields import column
from tablezones.plans.countries import COUNTRIES, CountryRules, transform_countries
from tablezones.sinks.guards import path_exists
from tablezones.sinks.jdbc import prepare_for_jdbc, write_jdbc
from tablezones.sinks.parquet import write_parquet
from tablezones.sinks.report import WriteReport
from tablezones.sources.json import CORRUPT_COLUMN, complete_schema, file_key, quarantined, read_json_documents
from tablezones.sources.json_ranges import RECORD_COLUMNS, broken_records, read_json_ranges
from tablezones.sources.parquet import read_parquet

#: Corrupt documents: "fail" keeps the foundation and raises; "quarantine" goes on without them; "salvage" reads
#: documents by ranges and goes on without their broken records alone.
ON_CORRUPT = ("fail", "quarantine", "salvage")


def structured(
    spark: SparkSession,
    raw_path: str,
    schema: StructType | str | None = None,
    landed_schema: StructType | None = None,
) -> DataFrame:
    """Raw JSON documents as typed columns, malformed ones in ``_corrupt_record``.

    Every field of the data is kept: ``schema`` fixes the types of the fields
    it names, and an inference pass over all documents adds the others.
    ``landed_schema`` is the schema in a landing writer's report: those very
    rows are read back, so it is complete and no inference is needed."""
    if landed_schema is not None:
        return read_json_documents(spark, raw_path, schema=landed_schema)
    inferred = read_json_documents(spark, raw_path)
    if schema is None:
        return inferred
    return read_json_documents(spark, raw_path, schema=complete_schema(schema, inferred.schema))


def quarantine(bad: DataFrame, path: str) -> None:
    """Add malformed documents or records (file, modified, offset, text, parsed) to ``path``, but for those of files that it has already.

    A file counts with its modification time, so a rerun of a failing job adds nothing and a corrected file that is
    broken again does."""
    spark = bad.sparkSession
    if path_exists(spark, path):
        known = read_parquet(spark, path)
        if "modified" in known.columns:
            bad = bad.join(known.select("file", "modified").distinct(), ["file", "modified"], "left_anti").select(*bad.columns)
    bad.write.mode("append").parquet(path)


def structure(
    spark: SparkSession,
    raw_path: str,
    foundation_path: str,
    schema: StructType | str | None = None,
    on_corrupt: str = "fail",
    num_files: int | None = None,
    landed_schema: StructType | None = None,
    quarantine_path: str | None = None,
) -> WriteReport:
    """Raw JSON documents -> foundation Parquet, parsed once. Reports rows and corrupt rows.

    Malformed documents never reach the foundation. If there are any, they are
    written to ``quarantine_path`` (default: ``<foundation>_quarantine``); then
    the job fails and keeps the previous foundation, or with
    ``on_corrupt="quarantine"`` publishes the other documents. A malformed
    array document is quarantined as a whole file, or with
    ``on_corrupt="salvage"`` only its broken records are, with their byte
    offsets; that reader splits large documents into ranges and needs a schema.
    Empty input raises and leaves the previous foundation in place.

    A multi-line JSON file is parsed by one task, so a raw zone of a few huge
    files gives a few huge foundation files; ``num_files`` rebalances the
    parsed rows into that many files (one round-robin shuffle, which Spark
    makes deterministic for retries). Leave it unset for many-file zones."""
    if on_corrupt not in ON_CORRUPT:
        raise ValueError(f"on_corrupt must be one of {ON_CORRUPT}")
    by_range = on_corrupt == "salvage"
    if by_range and landed_schema is None and schema is None:
        raise ValueError("salvage needs a schema")
    raw = read_json_ranges(spark, raw_path, landed_schema or schema) if by_range else structured(spark, raw_path, schema, landed_schema)
    aside = quarantine_path or f"{foundation_path.rstrip('/')}_quarantine"
    if raw.columns == [CORRUPT_COLUMN]:  # inference found no well-formed record at all
        whole = spark.read.option("wholetext", True).text(raw_path)
        quarantine(whole.select(*file_key(), F.lit(0).cast("long").alias("offset"), F.col("value").alias("text"), F.lit("{}").alias("parsed")), aside)
        raise CorruptInputError(f"all documents under {raw_path} are malformed; see {aside}")
    seen = raw
    if CORRUPT_COLUMN in raw.columns:
        # Counted where the rows are read, in the pass that writes the good ones.
        counted = Observation()
        seen = raw.observe(counted, F.count_if(column(CORRUPT_COLUMN).isNotNull()).alias("corrupt_rows"))
        seen = seen.where(column(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN, *(RECORD_COLUMNS if by_range else ()))
    if num_files:
        seen = seen.repartition(num_files)

    def corrupt_rows() -> int:
        return int(counted.get["corrupt_rows"]) if CORRUPT_COLUMN in raw.columns else 0

    def accept(metrics: dict) -> None:
        if n := corrupt_rows():
            quarantine(broken_records(raw) if by_range else quarantined(raw), aside)
            if on_corrupt == "fail":
                raise CorruptInputError(f"{n} malformed documents under {raw_path}: see {aside}; previous foundation kept")

    report = write_parquet(seen, foundation_path, inputs=[raw_path], require_rows=True, accept=accept)
    if not report.written:
        raise EmptyInputError(f"no records in {raw_path}; previous foundation kept, later stages not run")
    return WriteReport(report.target, True, {**report.metrics, "corrupt_rows": corrupt_rows()}, report.schema)


def transformed(
    spark: SparkSession, foundation_path: str, rules: CountryRules = COUNTRIES, schema: StructType | None = None
) -> DataFrame:
    """The trusted-zone frame; ``schema`` as the structure stage reported it."""
    return transform_countries(read_parquet(spark, foundation_path, schema=schema), rules)


def transform(
    spark: SparkSession,
    foundation_path: str,
    trusted_path: str,
    rules: CountryRules = COUNTRIES,
    schema: StructType | None = None,
) -> WriteReport:
    """Foundation Parquet -> flat, keyed trusted Parquet. Also reports rows
    left without a key (NULL or empty name), counted in the same pass. Empty
    input raises and leaves the previous trusted table in place."""
    key = rules.renames.get(rules.key_column, rules.key_column)
    extra = [F.count_if(column(key).isNull()).alias("null_keys")] if rules.attach_key else []
    report = write_parquet(
        transformed(spark, foundation_path, rules, schema),
        trusted_path,
        extra_metrics=extra,
        inputs=[foundation_path],
        require_rows=True,
    )
    if not report.written:
        raise EmptyInputError(f"no rows in {foundation_path}; previous trusted table kept, later stages not run")
    return report


def serving_frame(spark: SparkSession, trusted_path: str, schema: StructType | None = None) -> DataFrame:
    """Exactly what the save stage hands to the JDBC writer."""
    return prepare_for_jdbc(read_parquet(spark, trusted_path, schema=schema))


def save(
    spark: SparkSession, trusted_path: str, url: str, table: str, schema: StructType | None = None, **jdbc_options
) -> WriteReport:
    """Trusted Parquet -> JDBC table; an empty input keeps the old table."""
    return write_jdbc(read_parquet(spark, trusted_path, schema=schema), url, table, **jdbc_options)


@dataclass(frozen=True)
class Zones:
    """Locations of the raw, foundation and trusted zones."""

    raw: str
    foundation: str
    trusted: str

    @classmethod
    def under(cls, root: str) -> Zones:
        root = root.rstrip("/")
        return cls(f"{root}/raw", f"{root}/foundation", f"{root}/trusted")


def run_end_to_end(
    spark: SparkSession,
    zones: Zones,
    schema: StructType | str | None = None,
    rules: CountryRules = COUNTRIES,
    jdbc: dict | None = None,
    landed_schema: StructType | None = None,
    on_corrupt: str = "fail",
    num_files: int | None = None,
) -> dict[str, WriteReport]:
    """raw -> foundation -> trusted (-> table when ``jdbc`` has ``url`` and
    ``table``), stopping at the first failure."""
    first = structure(spark, zones.raw, zones.foundation, schema, on_corrupt, num_files, landed_schema)
    second = transform(spark, zones.foundation, zones.trusted, rules, first.schema)
    reports = {"structure": first, "transform": second}
    if jdbc:
        options = dict(jdbc)
        url, table = options.pop("url"), options.pop("table")
        reports["save"] = save(spark, zones.trusted, url, table, second.schema, **options)
    return reports
