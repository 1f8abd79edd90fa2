"""tablezones: nested JSON -> flat, keyed, relational-ready tables, as PySpark DataFrame operators.

Subpackages: ``functions`` (Column builders), ``operators`` (DataFrame ->
DataFrame), ``sources`` / ``sinks`` (JSON, Parquet, JDBC), ``plans`` (feed
rules and the zone jobs), ``streaming`` (the transform as an incremental
Structured Streaming job).
"""

__version__ = "0.1.0"
