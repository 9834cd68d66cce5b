"""Change detection between two versions of a row."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_changed(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """True when at least one pair differs; two NULLs are equal, NULL and a value are not."""
    return reduce(lambda x, y: x | y, [~a.eqNullSafe(b) for a, b in pairs], F.lit(False))


def row_hash(columns: Iterable[Column | str]) -> Column:
    """SHA-256 over the text of the columns joined by ``|``; NULL counts as empty text."""
    texts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
        for c in columns
    ]
    return F.sha2(F.concat_ws("|", *texts), 256)
