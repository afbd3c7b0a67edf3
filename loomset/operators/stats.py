"""Length statistics of a unified table: one aggregate over three columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.functions.text import has_text

# Histogram buckets over (characters // 4), upper bound exclusive.
TOKEN_BUCKETS = [
    ("0-128", 0, 128),
    ("128-256", 128, 256),
    ("256-512", 256, 512),
    ("512-1024", 512, 1024),
    ("1024+", 1024, None),
]
_FIELDS = ("instruction", "input", "output")


def dataset_stats(df: DataFrame, *extra: Column) -> DataFrame:
    """One row of counts, average / maximum / minimum lengths and the token histogram as a map.

    ``extra`` aggregates over other columns of ``df`` share the same scan.
    """
    return length_stats(with_lengths(df), *extra)


def with_lengths(df: DataFrame) -> DataFrame:
    """``df`` with the lengths of its texts and whether the input holds any text."""
    lengths = [F.length(F.coalesce(F.col(c), F.lit(""))).cast("bigint").alias(f"_{c}_len") for c in _FIELDS]
    return df.select("*", *lengths, F.coalesce(has_text(F.col("input")), F.lit(False)).alias("_has_input"))


def length_stats(lengths: DataFrame, *extra: Column) -> DataFrame:
    """The statistics out of the columns that ``with_lengths`` adds; no text is read."""
    estimate = F.expr("(_instruction_len + _input_len + _output_len) div 4")
    aggregates = [F.count("*").alias("num_samples")]
    for how, fn in (("avg", F.avg), ("max", F.max), ("min", F.min)):
        zero = F.lit(0.0) if how == "avg" else F.lit(0).cast("bigint")
        aggregates += [F.coalesce(fn(f"_{c}_len"), zero).alias(f"{how}_{c}_len") for c in _FIELDS]
    aggregates.append(F.count_if(~F.col("_has_input")).alias("empty_input_count"))
    for position, (_, low, high) in enumerate(TOKEN_BUCKETS):
        inside = F.col("_tokens") >= low
        if high is not None:
            inside = inside & (F.col("_tokens") < high)
        aggregates.append(F.count_if(inside).alias(f"_b{position}"))
    row = lengths.withColumn("_tokens", estimate).agg(*aggregates, *extra)
    pairs = [part for p, (name, _, _) in enumerate(TOKEN_BUCKETS) for part in (F.lit(name), F.col(f"_b{p}"))]
    empty = F.create_map().cast("map<string,bigint>")
    histogram = F.when(F.col("num_samples") > 0, F.create_map(*pairs)).otherwise(empty)
    return row.withColumn("token_length_distribution", histogram).drop(*[f"_b{p}" for p in range(len(TOKEN_BUCKETS))])


def histogram_rows(stats: DataFrame) -> DataFrame:
    """The histogram as ``(bucket, n)`` rows."""
    return stats.select(F.explode("token_length_distribution").alias("bucket", "n"))
