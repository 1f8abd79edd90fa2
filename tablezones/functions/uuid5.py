"""Deterministic UUIDv5 keys (RFC 4122 section 4.3).

``uuid5`` is the hot-path form: SHA-1 over namespace bytes + UTF-8 name, then
the version and variant bits, all as built-in expressions inside whole-stage
codegen. The UDF forms give the same text through a Python worker and exist
for parity checks and benchmarking.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tablezones.fixed_values import KEY_NAMESPACE


def uuid5_digest(name: Column, namespace: str = KEY_NAMESPACE) -> Column:
    """Hex SHA-1 of namespace bytes + UTF-8 name (the hash behind UUIDv5)."""
    return F.sha1(F.concat(F.unhex(F.lit(uuid.UUID(namespace).hex)), F.encode(name, "UTF-8")))


def uuid5_from_digest(digest: Column, name: Column) -> Column:
    """UUIDv5 text from a :func:`uuid5_digest` column; NULL for a NULL or empty name.

    Hex digit 13 becomes the version 5; digit 17 keeps its low two bits under
    the RFC variant bits 10, i.e. maps to 8, 9, a or b."""
    text = F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab"), F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
    return F.when(F.length(name) > 0, text)


def uuid5(name: Column, namespace: str = KEY_NAMESPACE) -> Column:
    """UUIDv5 text of ``name`` as one expression; NULL for a NULL or empty name.

    Convenient for ad-hoc use, but the digest sits inside a conditional, where
    subexpression elimination does not reach, so it is hashed once per
    use. ``operators.with_uuid5_key`` hashes once per row."""
    return uuid5_from_digest(uuid5_digest(name, namespace), name)


def uuid5_udf(name: Column, namespace: str = KEY_NAMESPACE) -> Column:
    """Arrow-batched pandas UDF with the same result as :func:`uuid5`.

    Worker-side code is a closure over the namespace only, shipped by value,
    so executors need the standard library and pandas, not this package."""
    ns = uuid.UUID(namespace)

    @F.pandas_udf(StringType())
    def _uuid5_batch(names: pd.Series) -> pd.Series:
        return names.map(lambda n: str(uuid.uuid5(ns, str(n))) if n else None)

    return _uuid5_batch(name)


def uuid5_python_udf(name: Column, namespace: str = KEY_NAMESPACE) -> Column:
    """Row-at-a-time Python UDF (the slowest form), kept for comparison only."""
    ns = uuid.UUID(namespace)
    return F.udf(lambda n: str(uuid.uuid5(ns, str(n))) if n else None, StringType())(name)
