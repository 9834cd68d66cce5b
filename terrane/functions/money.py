"""Money expressions.

Sums of doubles depend on the order in which shuffled rows arrive, so a retried task may change the
last digits. Amounts are therefore added as decimals with four places, which is exact and
independent of order, and only the result goes back to double.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for 10^24; what is beyond it, not a number or infinite has no amount.
AMOUNT = "decimal(28,4)"


def _amount(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return value.try_cast(AMOUNT)


def money(value: Column | str) -> Column:
    """Amount rounded half-up to cents, as double."""
    return F.round(_amount(value), 2).cast("double")


def exact_sum(value: Column | str) -> Column:
    """Sum of amounts rounded to cents; NULL over no values."""
    return F.round(F.sum(_amount(value)), 2).cast("double")


def no_amount(value: Column) -> Column:
    """True for a value that is there but is no amount of money."""
    return value.isNotNull() & _amount(value).isNull()
