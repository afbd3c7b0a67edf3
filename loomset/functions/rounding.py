"""Rounding that gives the digits Python's ``round`` gives."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Splits a double into two halves of at most 26 bits (Dekker 1971).
_SPLITTER = float(2**27 + 1)
# From here on the neighbours of a double are further apart than the decimals asked for.
_WHOLE = float(2**53)


def py_round(c: Column, digits: int) -> Column:
    """Round a double half to even on its exact binary value.

    Spark rounds the shortest decimal text of a double instead, which moves values such as 2.675
    that lie just beside a tie. Here the scaled value is compared with the tie, and where it
    seems to hit it, the exact rounding error of the scaling decides.
    """
    scale = float(10**digits)
    x = c.cast("double")
    scaled = x * scale
    big = x * _SPLITTER
    high = big - (big - x)
    error = (high * scale - scaled) + (x - high) * scale
    low = F.floor(scaled).cast("double")
    seems_tie = scaled - low == 0.5
    nearest = (
        F.when(seems_tie & (error > 0), low + 1.0).when(seems_tie & (error < 0), low).otherwise(F.rint(scaled))
    )
    return F.when(F.abs(scaled) < _WHOLE, nearest / scale).otherwise(x)


def fixed(c: Column, digits: int, signed: bool = False) -> Column:
    """Text with a fixed number of decimals, as Python's ``:.2f``; infinities and NaN as it spells them."""
    x, plus = c.cast("double"), "+" if signed else ""
    endless = F.when(x > 0, f"{plus}inf").otherwise("-inf")
    special = F.when(F.isnan(x), f"{plus}nan").when(F.abs(x) == float("inf"), endless)
    return F.coalesce(special, F.format_string(f"%{plus}.{digits}f", py_round(x, digits)))


def percent(rate: Column, digits: int = 1, signed: bool = False) -> Column:
    """Text of a rate, as Python's ``:.1%``."""
    return F.concat(fixed(rate * 100, digits, signed), F.lit("%"))
