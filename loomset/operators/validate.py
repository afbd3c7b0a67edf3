"""Schema, quality, length and duplicate checks with one removal reason per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomset.functions.rounding import percent
from loomset.functions.text import py_strip, special_count, special_ratio, text_or_empty
from loomset.session import materialize

REQUIRED = ("instruction", "output")

# Default limits, key separator and reason names.
MIN_LENGTH, MAX_LENGTH = 10, 8192
MIN_INSTRUCTION, MIN_OUTPUT = 5, 3
KEY_SEPARATOR = "|||"
DUPLICATE = "duplicate"
LENGTH = "length_out_of_range"
QUALITY_REASONS = (
    "empty_instruction",
    "empty_output",
    "instruction_too_short",
    "output_too_short",
    "corrupted_text",
)
LOCAL_REASONS = (*QUALITY_REASONS, LENGTH)


def missing_columns(df: DataFrame) -> list[str]:
    return [c for c in REQUIRED if c not in df.columns]


def require_schema(df: DataFrame) -> None:
    missing = missing_columns(df)
    if missing:
        raise ValueError(f"validation needs the columns {missing}")


def _with_stripped(df: DataFrame) -> DataFrame:
    """Adds the stripped texts as ``_i`` and ``_o``.

    They come out of a one-element ``inline``, which the optimizer does not fold into later
    filters, so each text is stripped once and not once per check.
    """
    columns = df.columns
    stripped = F.struct(
        py_strip(text_or_empty("instruction", columns)).alias("_i"),
        py_strip(text_or_empty("output", columns)).alias("_o"),
    )
    return df.select("*", F.inline(F.array(stripped)))


def _quality(i: Column, o: Column) -> Column:
    """First failing check, or null. Later branches run only for rows that reach them."""
    no_instruction, no_output, short_instruction, short_output, corrupted = QUALITY_REASONS
    return (
        F.when(i == "", no_instruction)
        .when(o == "", no_output)
        .when(F.length(i) < MIN_INSTRUCTION, short_instruction)
        .when(F.length(o) < MIN_OUTPUT, short_output)
        .when((special_count(i) + special_count(o)) * 2 > F.length(i) + F.length(o), corrupted)
    )


def length_ok(df: DataFrame, min_len: int = MIN_LENGTH, max_len: int = MAX_LENGTH) -> Column:
    """Total unstripped length within both limits, inclusive."""
    total = F.lit(0)
    for name in ("instruction", "input", "output"):
        total = total + F.length(text_or_empty(name, df.columns))
    return total.between(min_len, max_len)


def dedup_key(i: Column, o: Column) -> Column:
    """Fixed-size key of the stripped instruction and output; the input does not count."""
    return F.sha2(F.concat(i, F.lit(KEY_SEPARATOR), o), 256)


def filter_lengths(df: DataFrame, min_len: int = MIN_LENGTH, max_len: int = MAX_LENGTH) -> DataFrame:
    return df.where(length_ok(df, min_len, max_len))


def with_quality_reason(df: DataFrame) -> DataFrame:
    """Adds ``reason``: the first failing quality check, null for a good row."""
    return _with_stripped(df).withColumn("reason", _quality(F.col("_i"), F.col("_o"))).drop("_i", "_o")


def filter_quality(df: DataFrame) -> DataFrame:
    return with_quality_reason(df).where("reason IS NULL").drop("reason")


def quality_counts(df: DataFrame) -> DataFrame:
    return with_quality_reason(df).where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))


def with_special_ratio(df: DataFrame) -> DataFrame:
    return _with_stripped(df).withColumn("special_ratio", special_ratio(F.col("_i"), F.col("_o"))).drop("_i", "_o")


def _first_per_key(keyed: DataFrame, order: str) -> DataFrame:
    """Lowest ``order`` per key.

    The rank filter lets Spark drop losers before the shuffle (WindowGroupLimit), so a text
    repeated in a third of the table sends one row per task.
    """
    w = Window.partitionBy("_key").orderBy(order)
    return keyed.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank", "_key")


def drop_duplicates(df: DataFrame, order: str = "row_id") -> DataFrame:
    """Exact deduplication that keeps the first row in ``order``. One shuffle."""
    columns = df.columns
    keyed = _with_stripped(df).select(*columns, dedup_key(F.col("_i"), F.col("_o")).alias("_key"))
    return _first_per_key(keyed, order)


def with_local_reason(df: DataFrame, min_len: int = MIN_LENGTH, max_len: int = MAX_LENGTH) -> DataFrame:
    """Adds ``reason`` (quality, then length) and, where that is null, ``_key``; needs no shuffle."""
    require_schema(df)
    columns = df.columns
    quality = _quality(F.col("_i"), F.col("_o"))
    length = F.when(~length_ok(df, min_len, max_len), LENGTH)
    flagged = _with_stripped(df).select(*columns, "_i", "_o", F.coalesce(quality, length).alias("reason"))
    key = F.when(F.col("reason").isNull(), dedup_key(F.col("_i"), F.col("_o")))
    # Out of an inline like the stripped texts: a filter on the reason does not run the checks again.
    return flagged.select(*columns, F.inline(F.array(F.struct("reason", key.alias("_key")))))


def validate_all(
    df: DataFrame, min_len: int = MIN_LENGTH, max_len: int = MAX_LENGTH, order: str = "row_id"
) -> DataFrame:
    """Rows that pass every check; only rows that passed the others compete as duplicates."""
    survivors = with_local_reason(df, min_len, max_len).where("reason IS NULL").drop("reason")
    return _first_per_key(survivors, order)


def flag_all(
    df: DataFrame, min_len: int = MIN_LENGTH, max_len: int = MAX_LENGTH, order: str = "row_id"
) -> DataFrame:
    """Every row with its removal reason (null = kept), joined on the unique ``order``."""
    return df.join(flags(df, min_len, max_len, order), order, "left").select(*df.columns, "reason")


def flags(df: DataFrame, min_len: int = MIN_LENGTH, max_len: int = MAX_LENGTH, order: str = "row_id") -> DataFrame:
    """``(order, reason)`` of every row.

    The texts are read and checked once, into a written table of ids, reasons and keys. Winners
    are found there by a combined aggregate and marked by a join on the unique ``order``: neither
    step can be skewed by a text with many copies.
    """
    narrow = materialize(with_local_reason(df, min_len, max_len).select(order, "reason", "_key"), "flags")
    first = winners(narrow, order).select(order, F.lit(True).alias("_first"))
    reason = F.coalesce(F.col("reason"), F.when(F.col("_first").isNull(), DUPLICATE))
    return narrow.join(first, order, "left").select(order, reason.alias("reason"))


def winners(checked: DataFrame, order: str = "row_id") -> DataFrame:
    """``order`` of the first row per key, among the rows of ``with_local_reason`` that have no reason."""
    return checked.where("reason IS NULL").groupBy("_key").agg(F.min(order).alias(order)).select(order)


def reason_counts(df: DataFrame, min_len: int = MIN_LENGTH, max_len: int = MAX_LENGTH) -> DataFrame:
    """``(reason, n)`` over all rows; the row with a null reason counts the kept ones.

    Duplicates are copies beyond one per key, so counts per key suffice. Keys and reasons are
    combined in each task before they are shuffled.
    """
    per_key = (
        with_local_reason(df, min_len, max_len).groupBy("reason", "_key").agg(F.count("*").alias("_n"))
    )
    totals = per_key.groupBy("reason").agg(F.sum("_n").alias("_rows"), F.count("*").alias("_keys"))
    kept = F.struct(F.lit(None).cast("string").alias("reason"), F.col("_keys").alias("n"))
    copies = F.struct(F.lit(DUPLICATE).alias("reason"), (F.col("_rows") - F.col("_keys")).alias("n"))
    removed = F.struct("reason", F.col("_rows").alias("n"))
    rows = F.when(F.col("reason").isNull(), F.array(kept, copies)).otherwise(F.array(removed))
    return totals.select(F.inline(rows)).where("n > 0")


def local_reason_counts() -> list[Column]:
    """One count per row-local ``reason`` (``_ok`` for survivors), to share a scan with other aggregates."""
    counts = [F.count_if(F.col("reason") == r).alias(r) for r in LOCAL_REASONS]
    return [F.count_if(F.col("reason").isNull()).alias("_ok"), *counts]


def validation_report(counts: DataFrame) -> DataFrame:
    """One row: original, kept and removed rows, and the removal rate (0 for an empty table)."""
    n = F.col("n")
    totals = counts.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("original_count"),
        F.coalesce(F.sum(F.when(F.col("reason").isNull(), n)), F.lit(0)).alias("filtered_count"),
    )
    removed = F.col("original_count") - F.col("filtered_count")
    return totals.select(
        "original_count",
        "filtered_count",
        removed.alias("removed_count"),
        F.when(F.col("original_count") == 0, 0.0).otherwise(removed / F.col("original_count")).alias("removal_rate"),
    )


def sorted_reasons(counts: DataFrame) -> DataFrame:
    """Removal reasons, most frequent first."""
    return counts.where("reason IS NOT NULL").orderBy(F.desc("n"), "reason")


def report_summary(counts: DataFrame) -> DataFrame:
    """The report as one text. ``counts`` holds at most one row per reason name, so this is tiny."""
    order = F.struct((-F.col("n")).alias("k"), F.col("reason"), F.col("n"))
    listed = F.array_sort(F.collect_list(F.when(F.col("reason").isNotNull(), order)))
    reasons = counts.agg(
        F.transform(listed, lambda r: F.format_string("    - %s: %d", r["reason"], r["n"])).alias("lines"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("original"),
        F.coalesce(F.sum(F.when(F.col("reason").isNull(), F.col("n"))), F.lit(0)).alias("kept"),
    )
    removed = F.col("original") - F.col("kept")
    rate = F.when(F.col("original") == 0, F.lit(0.0)).otherwise(removed / F.col("original"))
    head = F.array(
        F.lit("Validation Report:"),
        F.format_string("  Original samples: %d", F.col("original")),
        F.format_string("  Filtered samples: %d", F.col("kept")),
        F.concat(F.format_string("  Removed: %d (", removed), percent(rate), F.lit(")")),
    )
    title = F.when(F.size("lines") > 0, F.array(F.lit("  Removal reasons:"))).otherwise(F.array().cast("array<string>"))
    return reasons.select(F.array_join(F.concat(head, title, F.col("lines")), "\n").alias("summary"))
