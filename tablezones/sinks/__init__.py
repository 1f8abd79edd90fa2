from tablezones.sinks.gate import has_rows
from tablezones.sinks.guards import refuse_self_overwrite, replace_folder
from tablezones.sinks.jdbc import jdbc_options, mysql_url, prepare_for_jdbc, write_jdbc
from tablezones.sinks.landing import json_records, land_json_documents, land_json_lines
from tablezones.sinks.parquet import observed, write_parquet
from tablezones.sinks.report import WriteReport

__all__ = [
    "WriteReport",
    "has_rows",
    "jdbc_options",
    "json_records",
    "land_json_documents",
    "land_json_lines",
    "mysql_url",
    "observed",
    "prepare_for_jdbc",
    "refuse_self_overwrite",
    "replace_folder",
    "write_jdbc",
    "write_parquet",
]
