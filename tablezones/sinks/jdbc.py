"""JDBC table sink.

Overwrite without ``truncate`` drops and recreates the table, so its schema
follows the data; with ``isolation_level='NONE'`` each partition commits on its
own, so readers can briefly see a missing or half-loaded table. Complex
columns are JSON-encoded first because JDBC has no array/struct/map types.
``num_partitions`` caps the number of concurrent connections (coalesce).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablezones.operators.flatten import flatten_complex
from tablezones.sinks.gate import has_rows
from tablezones.sinks.parquet import observed
from tablezones.sinks.report import WriteReport

from tablezones.fixed_values import JDBC_BATCH_SIZE as BATCH_SIZE
from tablezones.fixed_values import JDBC_ISOLATION_LEVEL as ISOLATION_LEVEL
from tablezones.fixed_values import MYSQL_DRIVER, MYSQL_TABLE_OPTIONS


def prepare_for_jdbc(df: DataFrame) -> DataFrame:
    """The frame a JDBC writer can accept: every complex column as JSON text."""
    return flatten_complex(df)


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    batch_size: int = BATCH_SIZE,
    isolation_level: str = ISOLATION_LEVEL,
    truncate: bool = False,
    num_partitions: int | None = None,
    create_table_options: str | None = None,
) -> dict[str, str]:
    """Writer options; MySQL URLs also get the driver class and table options."""
    opts = {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "isolationLevel": isolation_level,
        "truncate": str(truncate).lower(),
    }
    is_mysql = url.startswith("jdbc:mysql:")
    if driver or is_mysql:
        opts["driver"] = driver or MYSQL_DRIVER
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if num_partitions is not None:
        opts["numPartitions"] = str(num_partitions)
    # Table options are MySQL DDL; other databases reject them.
    if create_table_options or is_mysql:
        opts["createTableOptions"] = create_table_options or MYSQL_TABLE_OPTIONS
    return opts


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **options) -> WriteReport:
    """Write ``df`` to a JDBC table; an empty frame leaves the old table in place.

    With isolation ``NONE`` each partition commits by itself, so a retried task
    inserts its rows again. Where that matters, write to a staging table and
    move its rows in one statement of the database."""
    frame = prepare_for_jdbc(df)
    if not has_rows(frame):
        return WriteReport(target=table, written=False, metrics={"rows": 0})
    frame, obs = observed(frame, "jdbc_write")
    frame.write.format("jdbc").options(**jdbc_options(url, table, **options)).mode(mode).save()
    return WriteReport(target=table, written=True, metrics=dict(obs.get))


def mysql_url(host: str, database: str, port: int = 3306) -> str:
    return f"jdbc:mysql://{host}:{port}/{database}"
