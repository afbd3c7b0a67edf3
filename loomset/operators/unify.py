"""Bring instruction layouts to one (instruction, input, output) schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.functions.text import as_text

UNIFIED = ("instruction", "input", "output")

# Source column per unified column ('' where the layout has none) ...
MAPPED = {
    "alpaca": ("instruction", "input", "output"),
    "alpaca_no_input": ("instruction", "", "output"),
    "dolly": ("instruction", "context", "response"),
    "oasst": ("instruction", "", "response"),
}
# ... and the columns that identify a layout; the first match wins.
DETECTION = [
    ("alpaca", {"instruction", "input", "output"}),
    ("dolly", {"instruction", "context", "response"}),
    ("oasst", {"instruction", "response"}),
    ("sharegpt", {"conversations"}),
    ("alpaca_no_input", {"instruction", "output"}),
]
FORMATS = ("alpaca", "alpaca_no_input", "dolly", "oasst", "sharegpt")
USER_ROLES = ("human", "user")
ASSISTANT_ROLES = ("gpt", "assistant")


def detect_format(columns: list[str]) -> str:
    """Layout name from column names alone."""
    present = set(columns)
    for name, required in DETECTION:
        if required <= present:
            return name
    raise ValueError(
        f"no known layout has the columns {sorted(present)}; known are {', '.join(FORMATS)}"
    )


def to_unified(df: DataFrame, fmt: str | None = None, keep: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """Project any supported layout to ``(*keep, instruction, input, output)``. No shuffle."""
    name = fmt or detect_format(df.columns)
    if name == "sharegpt":
        return _from_messages(df, keep)
    if name not in MAPPED:
        raise ValueError(f"no layout named {name}")
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = [
        (as_text(F.col(source), types[source]) if source in types else F.lit("")).alias(target)
        for target, source in zip(UNIFIED, MAPPED[name])
    ]
    return df.select(*keep, *columns)


def _from_messages(df: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """First non-empty user and first non-empty assistant message of a nested message array."""
    element = df.schema["conversations"].dataType.elementType
    types = {f.name: f.dataType for f in element.fields}

    def first_present(message: Column, names: tuple[str, str]) -> Column:
        found = [message[n] for n in names if n in types]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    def value(message: Column) -> Column:
        found = [
            message[n] if isinstance(types[n], T.StringType) else message[n].cast("string")
            for n in ("value", "content")
            if n in types
        ]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    def first_from(roles: tuple[str, ...]) -> Column:
        hits = F.filter(
            "conversations", lambda m: first_present(m, ("from", "role")).isin(*roles) & (value(m) != "")
        )
        return value(F.get(hits, F.lit(0)))

    return (
        df.where(F.size("conversations") >= 2)
        .select(*keep, first_from(USER_ROLES).alias("instruction"), first_from(ASSISTANT_ROLES).alias("output"))
        .where(F.col("instruction").isNotNull() & F.col("output").isNotNull())
        .select(*keep, "instruction", F.lit("").alias("input"), "output")
    )


def turns_to_unified(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The same rule over a table with one row per turn.

    One aggregate, combined before the shuffle: a task sends at most one candidate per
    conversation and side, however long a conversation is.
    """

    def first_from(roles: tuple[str, ...]) -> Column:
        hit = F.col(role).isin(*roles) & (F.col(text) != "")
        return F.min_by(F.col(text), F.when(hit, F.col(turn)))

    return (
        turns.groupBy(F.col(conv).alias("row_id"))
        .agg(
            first_from(USER_ROLES).alias("instruction"),
            first_from(ASSISTANT_ROLES).alias("output"),
            F.count("*").alias("_n"),
        )
        .where("_n >= 2 AND instruction IS NOT NULL AND output IS NOT NULL")
        .select("row_id", "instruction", F.lit("").alias("input"), "output")
    )
