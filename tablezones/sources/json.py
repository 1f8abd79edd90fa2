"""JSON sources.

Two layouts, never guessed:

* documents (``read_json_documents``): each file holds one JSON value, usually
  an array of records; every element becomes a row. A file is one task (not
  splittable), so a large feed should be landed as many files.
* lines (``read_json_lines``): one record per line; files split freely.

Without a schema Spark infers one with an extra full pass over the whole input.
A schema given by hand may miss fields, and a reader silently leaves those out;
``complete_schema`` adds them from an inference pass. Only the schema of the
very rows that were landed needs no such pass.

A malformed document is one row with its text in ``_corrupt_record``: of an
array document none of the records counts as read, whatever precedes the fault.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

from tablezones.errors import EmptyInputError
from tablezones.functions.fields import column
from tablezones.sources._paths import resolving

CORRUPT_COLUMN = "_corrupt_record"
#: Written and read alike, so that microseconds survive the round trip.
NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
_MODES = {"keep": "PERMISSIVE", "fail": "FAILFAST"}


def with_corrupt_column(schema: StructType | str) -> StructType:
    """``schema`` plus the column that keeps malformed input visible."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if CORRUPT_COLUMN in schema.fieldNames():
        return schema
    return StructType([*schema.fields, StructField(CORRUPT_COLUMN, StringType(), True)])


def _reader(spark: SparkSession, schema, on_corrupt: str, options):
    if on_corrupt not in _MODES:
        raise ValueError(f"on_corrupt must be one of {sorted(_MODES)}")
    reader = spark.read.option("mode", _MODES[on_corrupt]).option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    reader = reader.option("timestampNTZFormat", NTZ_FORMAT)
    if schema is not None:
        reader = reader.schema(with_corrupt_column(schema) if on_corrupt == "keep" else schema)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader


def _non_empty_schema(df: DataFrame, path) -> DataFrame:
    if not df.columns:
        raise EmptyInputError(f"no JSON records found under {path}")
    return df


def _merged(declared: DataType, inferred: DataType) -> DataType:
    """``declared`` with the struct fields that only ``inferred`` has, at any depth."""
    if isinstance(declared, StructType) and isinstance(inferred, StructType):
        found = {f.name: f for f in inferred.fields}
        fields = [StructField(f.name, _merged(f.dataType, found[f.name].dataType) if f.name in found else f.dataType, f.nullable) for f in declared.fields]
        named = set(declared.fieldNames())
        return StructType([*fields, *(f for f in inferred.fields if f.name not in named)])
    if isinstance(declared, ArrayType) and isinstance(inferred, ArrayType):
        return ArrayType(_merged(declared.elementType, inferred.elementType), declared.containsNull)
    if isinstance(declared, MapType) and isinstance(inferred, StructType) and isinstance(declared.valueType, StructType):
        value: DataType = declared.valueType
        for f in inferred.fields:
            value = _merged(value, f.dataType)
        return MapType(declared.keyType, value, declared.valueContainsNull)
    return declared


def complete_schema(declared: StructType | str, inferred: StructType) -> StructType:
    """Declared types where they are declared, inferred ones for all other fields."""
    declared = StructType.fromDDL(declared) if isinstance(declared, str) else declared
    return StructType([f for f in _merged(declared, inferred).fields if f.name != CORRUPT_COLUMN])


def file_key() -> list[Column]:
    """Which file a row is from, and which state of it: a changed file is another one."""
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified")]


def quarantined(raw: DataFrame) -> DataFrame:
    """The malformed documents of a JSON frame: file name and modification time, byte offset, text, and the fields parsed before the fault."""
    fields = F.struct(*[column(c) for c in raw.columns if c != CORRUPT_COLUMN])
    bad = raw.where(column(CORRUPT_COLUMN).isNotNull())
    return bad.select(*file_key(), F.lit(0).cast("long").alias("offset"), column(CORRUPT_COLUMN).alias("text"), F.to_json(fields).alias("parsed"))


def read_json_documents(
    spark: SparkSession,
    path,
    schema: StructType | str | None = None,
    on_corrupt: str = "keep",
    options: dict | None = None,
) -> DataFrame:
    """Read files that each hold one JSON document; an array gives one row per element."""
    reader = _reader(spark, schema, on_corrupt, options).option("multiLine", True)
    return _non_empty_schema(resolving(path, lambda: reader.json(path)), path)


def read_json_lines(
    spark: SparkSession,
    path,
    schema: StructType | str | None = None,
    on_corrupt: str = "keep",
    options: dict | None = None,
) -> DataFrame:
    """Read JSON-lines files (one record per line, splittable)."""
    reader = _reader(spark, schema, on_corrupt, options)
    return _non_empty_schema(resolving(path, lambda: reader.json(path)), path)
