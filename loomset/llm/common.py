"""Helpers shared by the operators: names that cannot clash, bounded broadcasts, byte batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A side is broadcast only after its rows were counted and rows x row_bytes found at or below this.
BROADCAST_BYTES = 32 << 20


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not use, whatever extra columns it carries."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def packed(df: DataFrame) -> tuple[Column, list[str]]:
    """All columns as one struct, and their names: later columns cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]), df.columns


def unpacked(struct: str, names: list[str]) -> list[Column]:
    return [F.col(struct).getField(c).alias(c) for c in names]


def hint_small(df: DataFrame, rows: int, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its counted size allows it; else as it is, for a shuffle join."""
    return F.broadcast(df) if rows * row_bytes <= limit else df


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone. Texts without other characters take the faster function."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )
