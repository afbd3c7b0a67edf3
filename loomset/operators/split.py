"""Seeded train / validation / test splits and samples with exact sizes."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.functions.ordering import (
    PREFIX,
    Histogram,
    at_or_before,
    content_hash,
    cut_points,
    hash_keys,
    rank_by_hash,
    seeded_hash,
)
from loomset.session import join_lookup

SPLITS = ("train", "validation", "test")
# Up to this many sampled rows are picked by a top-n; more by a cut point.
TOP_N_SAMPLE = 10_000


def check_ratios(train: float, val: float, test: float) -> None:
    total = train + val + test
    if abs(total - 1.0) > 1e-6:
        raise ValueError(f"the shares {train}, {val} and {test} add up to {total:.4f} instead of 1")
    if min(train, val, test) < 0:
        raise ValueError("a share below 0 is not possible")
    if train == 0:
        raise ValueError("the training share has to be above 0")


def _check_size(n: int) -> None:
    if n < 3:
        raise ValueError(f"a split takes 3 rows or more; the table has {n}")


def split_sizes(n: int, val: float, test: float) -> tuple[int, int, int]:
    """Rows per split: the held-out share is rounded up, then its test share is rounded up."""
    held_ratio = val + test
    if held_ratio == 0:
        return n, 0, 0
    held = math.ceil(held_ratio * n)
    if held >= n:
        raise ValueError(f"With {n} samples the train split would be empty")
    if test == 0:
        return n - held, held, 0
    if val == 0:
        return n - held, 0, held
    n_test = math.ceil(test / held_ratio * held)
    if n_test >= held:
        raise ValueError(f"With {n} samples the validation split would be empty")
    return n - held, held - n_test, n_test


def random_split(
    df: DataFrame,
    train: float = 0.9,
    val: float = 0.05,
    test: float = 0.05,
    seed: int = 42,
    stratify: str | None = None,
    row_id: str = "row_id",
) -> DataFrame:
    """Adds ``split``. Sizes are exact and the same seed gives the same rows.

    Rows are ordered by a seeded hash of their id. Two cut points in that order decide every row
    by comparison, so the rows themselves are neither shuffled nor sorted. Rows that share an id go by
    their values, and equal rows by their position, so that sizes are exact then, too, if ``df`` gives its
    rows in the same order whenever it is read, as files do.
    """
    check_ratios(train, val, test)
    if stratify and stratify in df.columns:
        return stratified_split(df, stratify, train, val, seed, row_id)
    keys = hash_keys(df, row_id, seed)
    histogram = Histogram(keys)
    _check_size(histogram.total)
    _, n_val, n_test = split_sizes(histogram.total, val, test)
    split = F.lit("train")
    ends = [(name, end) for name, end, size in (("validation", n_test + n_val, n_val), ("test", n_test, n_test)) if size]
    for (name, _), cut in zip(ends, cut_points(keys, histogram, [end for _, end in ends])):
        split = F.when(at_or_before(F.col("_h"), F.col("_c"), F.col("_n"), cut), name).otherwise(split)
    return _with_keys(df, row_id, seed).select(*[f"`{c}`" for c in df.columns if c != "split"], split.alias("split"))


def _with_keys(df: DataFrame, row_id: str, seed: int) -> DataFrame:
    """``df`` with its order key, content and position; those that no cut needs are pruned."""
    return df.select("*", seeded_hash(row_id, seed).alias("_h"), content_hash(df).alias("_c"), F.monotonically_increasing_id().alias("_n"))


def _label_text(df: DataFrame, column: str):
    dtype = df.schema[column].dataType
    c = F.col(column)
    text = F.initcap(c.cast("string")) if isinstance(dtype, T.BooleanType) else c.cast("string")
    return F.coalesce(text, F.lit("None"))


def stratified_split(
    df: DataFrame, column: str, train: float, val: float, seed: int = 42, row_id: str = "row_id"
) -> DataFrame:
    """Adds ``split`` so that every label keeps the ratios; at least one row of a label is train.

    Per label, counts by hash prefix place the two boundary ranks in one small group each, and
    only those groups are ranked. The boundaries (one row per label) are joined back.
    """
    labelled = df.withColumn("_label", _label_text(df, column)).withColumn("_h", seeded_hash(row_id, seed))
    keys = labelled.select("_label", "_h", F.col(row_id).alias("_id"), F.substring("_h", 1, PREFIX).alias("_p"))
    per_prefix = keys.groupBy("_label", "_p").agg(F.count("*").alias("_n"))
    # At most 65,536 rows per label, whatever the size of the label.
    by_label = Window.partitionBy("_label")
    ranged = per_prefix.select(
        "_label",
        "_p",
        "_n",
        F.sum("_n").over(by_label.orderBy("_p")).alias("_end"),
        F.sum("_n").over(by_label).alias("_total"),
    )
    n_train = F.greatest(F.lit(1), F.rint(F.col("_total") * train).cast("long"))
    n_val = F.rint(F.col("_total") * val).cast("long")
    ends = F.array(
        F.struct(F.lit("train").alias("_which"), n_train.alias("_rank")),
        F.struct(F.lit("validation").alias("_which"), F.least(F.col("_total"), n_train + n_val).alias("_rank")),
    )
    boundary = (
        ranged.select("_label", "_p", "_n", "_end", F.inline(ends))
        .where("_rank > _end - _n AND _rank <= _end")
        .select("_label", "_p", "_which", (F.col("_rank") - (F.col("_end") - F.col("_n"))).alias("_inner"))
    )
    in_group = Window.partitionBy("_label", "_p", "_which").orderBy("_h", "_id")
    cuts = (
        keys.join(boundary, ["_label", "_p"])
        .withColumn("_at", F.row_number().over(in_group))
        .where("_at = _inner")
        .groupBy("_label")
        .agg(
            F.max(F.when(F.col("_which") == "train", F.struct("_h", "_id"))).alias("_train_end"),
            F.max(F.when(F.col("_which") == "validation", F.struct("_h", "_id"))).alias("_val_end"),
        )
    )
    me = F.struct(F.col("_h").alias("_h"), F.col(row_id).alias("_id"))
    split = (
        F.when(me <= F.col("_train_end"), "train").when(me <= F.col("_val_end"), "validation").otherwise("test")
    )
    joined = join_lookup(labelled, cuts, ["_label"])
    return joined.select(*df.columns, split.alias("split"))


def seeded_sample(df: DataFrame, n: int = 20, seed: int = 42, row_id: str = "row_id") -> DataFrame:
    """``min(n, rows)`` rows without replacement, numbered from 1 in sample order."""
    if n <= TOP_N_SAMPLE:
        picked = df.withColumn("_h", seeded_hash(row_id, seed)).orderBy("_h", row_id).limit(n)
        # At most TOP_N_SAMPLE rows reach this window.
        place = F.row_number().over(Window.orderBy("_h", row_id)).cast("bigint")
        return picked.withColumn("sample_id", place).drop("_h")
    keys = hash_keys(df, row_id, seed)
    histogram = Histogram(keys)
    if n < histogram.total:
        (cut,) = cut_points(keys, histogram, [n])
        wanted = at_or_before(F.col("_h"), F.col("_c"), F.col("_n"), cut)
        df = _with_keys(df, row_id, seed).where(wanted).select(*[f"`{c}`" for c in df.columns])
    return rank_by_hash(df, row_id, seed, "sample_id")
