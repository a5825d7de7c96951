"""Exact money arithmetic on 64-bit integers.

Amounts live in tables as DOUBLE.  Adding doubles gives a different last digit for
every task order, so measures are computed in millionths of the currency unit
("ticks", BIGINT) and turned back into DOUBLE at the edge of a table.  Integer sums
stay in the hash aggregate's fixed-width buffer, which a wide DECIMAL would not, and
under ANSI an overflow stops the job instead of giving a wrong total.  An amount with more
than six decimals stops it too: nothing is rounded.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TICKS_PER_UNIT = 1000000.0
# What a DOUBLE product may be off from a whole number of ticks, in parts of its size.
_NOISE = 1e-15


def to_ticks(amount: Column | str) -> Column:
    amount = F.col(amount) if isinstance(amount, str) else amount
    exact = amount * F.lit(TICKS_PER_UNIT)
    whole = F.rint(exact)
    fits = F.abs(exact - whole) <= F.lit(_NOISE) * F.greatest(F.abs(exact), F.lit(1.0))
    return F.when(fits, whole.cast("bigint")).when(amount.isNotNull(), F.raise_error(
        F.concat(F.lit("more than six decimals: "), amount.cast("string"))).cast("bigint"))


def from_ticks(ticks: Column | str) -> Column:
    ticks = F.col(ticks) if isinstance(ticks, str) else ticks
    return ticks / F.lit(TICKS_PER_UNIT)


def exact_sum(amount: Column | str) -> Column:
    """Order-independent SUM of a DOUBLE amount with at most six decimals."""
    return from_ticks(F.sum(to_ticks(amount)))
