"""Typed failures. Every stage raises instead of logging and returning (the
original job swallowed errors and exited 0, so later stages ran on stale data)."""


class TablezonesError(Exception):
    """Base class for all errors raised by this package."""


class MissingInputError(TablezonesError):
    """The input path does not exist (as resolved by Spark, not the local disk)."""


class EmptyInputError(TablezonesError):
    """The input holds no data or no columns, so there is nothing to write."""


class MissingColumnError(TablezonesError):
    """A column or nested field that a strict operator needs is absent."""


class ColumnTypeError(TablezonesError):
    """A column exists but has a type the operator cannot handle."""


class RenameCollisionError(TablezonesError):
    """A rename would produce two columns whose names differ only by case."""


class UnsafeOverwriteError(TablezonesError):
    """The overwrite target is also an input of the plan being written."""


class CorruptInputError(TablezonesError):
    """Malformed JSON was found; the documents are in the quarantine folder."""


class SharedFolderError(TablezonesError):
    """A cluster session names no shared folder (``spark.checkpoint.dir``) for staged tables."""
