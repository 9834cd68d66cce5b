"""Column expressions shared by the operators; all of them are built-in Spark functions."""

from .change import any_changed, row_hash
from .money import exact_sum, money
from .text import clean_id, normalized, token

__all__ = [
    "any_changed", "clean_id", "exact_sum", "money", "normalized", "row_hash", "token",
]
