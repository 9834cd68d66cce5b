"""Text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized(text: Column | str) -> Column:
    """Lower-case with everything outside a-z and 0-9 removed."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9]", "")


def clean_id(value: Column | str) -> Column:
    """Identifier as text, trimmed and lower-cased."""
    value = F.col(value) if isinstance(value, str) else value
    return F.lower(F.trim(value.cast("string")))


def token(text: Column | str, index: int, separator: str = "_") -> Column:
    """The ``index``-th piece (from 0) of ``text``; NULL when there is no such piece."""
    return F.get(F.split(text, separator), F.lit(index))
