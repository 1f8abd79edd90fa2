from tablezones.sources.json import CORRUPT_COLUMN, read_json_documents, read_json_lines
from tablezones.sources.parquet import read_parquet

__all__ = ["CORRUPT_COLUMN", "read_json_documents", "read_json_lines", "read_parquet"]
