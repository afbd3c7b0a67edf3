"""Text expressions with Python's Unicode string semantics, as native Spark columns."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The code points Python's str.isspace() accepts.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same set as a Java regex class; (?U) makes \s the Unicode White_Space property.
_WS = r"\s\x1c-\x1f"
WS_RUN = rf"(?U)[{_WS}]+"
NON_WS = rf"(?U)[^{_WS}]"
NORMAL_RUN = rf"(?U)[\p{{L}}\p{{N}}{_WS}]++"
# Listed one by one, since Java's regex looks single Latin characters up in a table.
ASCII_NORMAL_RUN = f"[{string.ascii_letters}{string.digits} \\n\\t]++"


def py_strip(c: Column) -> Column:
    return F.btrim(c, F.lit(PY_WHITESPACE))


def has_text(c: Column) -> Column:
    """True when anything is left after stripping; stops at the first such character."""
    return c.rlike(NON_WS)


def tokens(c: Column) -> Column:
    """Lower-cased whitespace tokens; an empty array when there are none."""
    stripped = py_strip(F.lower(c))
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, WS_RUN))


def special_count(c: Column) -> Column:
    """Characters that are neither alphanumeric nor whitespace.

    Plain ASCII is taken out first by a cheap class; the Unicode class sees what is left.
    """
    return F.length(F.regexp_replace(F.regexp_replace(c, ASCII_NORMAL_RUN, ""), NORMAL_RUN, ""))


def special_ratio(*parts: Column) -> Column:
    """Share of special characters over the concatenation of ``parts``."""
    count, size = F.lit(0), F.lit(0)
    for part in parts:
        count, size = count + special_count(part), size + F.length(part)
    return count / F.greatest(size, F.lit(1))


def as_text(c: Column, dtype: T.DataType) -> Column:
    """Text of a value where every falsy value (null, 0, false, empty) becomes ''."""
    if isinstance(dtype, T.StringType):
        return F.coalesce(c, F.lit(""))
    if isinstance(dtype, T.BooleanType):
        return F.when(c, F.lit("True")).otherwise(F.lit(""))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return (
            F.when(F.isnan(c), F.lit("nan"))
            .when(c == float("inf"), F.lit("inf"))
            .when(c == float("-inf"), F.lit("-inf"))
            .when(c != 0, c.cast("string"))
            .otherwise(F.lit(""))
        )
    if isinstance(dtype, T.NumericType):
        return F.when(c != 0, c.cast("string")).otherwise(F.lit(""))
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.when(F.size(c) > 0, F.to_json(c)).otherwise(F.lit(""))
    if isinstance(dtype, T.StructType):
        return F.coalesce(F.to_json(c), F.lit(""))
    return F.coalesce(c.cast("string"), F.lit(""))


def text_or_empty(name: str, columns: list[str]) -> Column:
    """A column as text, or '' when the table does not have it."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in columns else F.lit("")
