"""Typed errors raised before or between Spark jobs."""


class MeterwiseError(Exception):
    """Base of all errors of this package."""


class BadMonth(MeterwiseError, ValueError):
    """The month parameter is not YYYY-MM."""


class SchemaDrift(MeterwiseError, ValueError):
    """Required columns are missing from the input."""


class MissingInput(MeterwiseError, FileNotFoundError):
    """An input path does not exist."""


class EmptyInput(MeterwiseError, RuntimeError):
    """An input that must hold rows holds none."""


class RejectedInput(MeterwiseError, RuntimeError):
    """Files of the input could not be opened as Parquet."""


class DuplicateKeys(MeterwiseError, ValueError):
    """A dimension repeats a key and would multiply fact rows."""


class ConflictingCommit(MeterwiseError):
    """Another writer has committed since the caller last read."""
