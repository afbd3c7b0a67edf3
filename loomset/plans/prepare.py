"""Raw instruction data to rendered, split training files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.functions.templates import get_template, render
from loomset.operators.split import check_ratios, random_split
from loomset.operators.stats import length_stats, with_lengths
from loomset.operators.unify import to_unified
from loomset.operators.validate import (
    DUPLICATE,
    LOCAL_REASONS,
    MAX_LENGTH,
    MIN_LENGTH,
    local_reason_counts,
    winners,
    with_local_reason,
)
from loomset.session import BROADCAST_ROWS, drop_path, write_scratch
from loomset.sources.readers import load, with_row_id
from loomset.sources.sinks import write_splits


@dataclass
class Prepared:
    stats: DataFrame  # one row over the unified input
    reasons: DataFrame  # (reason, n); the null reason counts the kept rows
    rows: DataFrame  # (row_id, text, split), read from the checked table
    kept_path: str  # the checked table in shared scratch
    more_paths: list[str] = field(default_factory=list)  # what else was written there

    def release(self) -> None:
        """Delete what was written to scratch once ``rows`` is no longer needed."""
        for path in (self.kept_path, *self.more_paths):
            drop_path(self.rows.sparkSession, path)


def prepare_dataset(
    spark: SparkSession,
    source: str | DataFrame,
    *,
    source_format: str | None = None,
    reader_options: dict | None = None,
    layout: str | None = None,
    template: str = "alpaca",
    min_len: int = MIN_LENGTH,
    max_len: int = MAX_LENGTH,
    ratios: tuple[float, float, float] = (0.9, 0.05, 0.05),
    seed: int = 42,
    stratify: str | None = None,
    out: str | None = None,
) -> Prepared:
    """Load, unify, profile, validate, render, split and (with ``out``) write.

    ``reader_options`` go to the reader: ``schema`` and ``quarantine`` for JSON, ``multi_line`` for CSV.

    The input is read and checked once, into one written table of texts, lengths, reasons and keys.
    Statistics, removal counts, duplicates and the split read its narrow columns; texts are read
    once more, to render the kept rows. Text is shuffled only if there are more duplicates than
    may be broadcast as ids.
    """
    get_template(template)
    check_ratios(*ratios)
    raw = load(spark, source, source_format, **(reader_options or {})) if isinstance(source, str) else with_row_id(source)
    keep = ("row_id", stratify) if stratify and stratify in raw.columns else ("row_id",)
    unified = to_unified(raw, layout, keep)

    written: list[str] = []

    def stored(df: DataFrame, label: str) -> DataFrame:
        written.append(write_scratch(df, label))
        return spark.read.schema(df.schema).parquet(written[-1])

    checked = stored(with_lengths(with_local_reason(unified, min_len, max_len)), "checked")
    profile = length_stats(checked, *local_reason_counts()).first()
    stat_names = [c for c in profile.asDict() if c != "_ok" and c not in LOCAL_REASONS]

    first = winners(checked)
    passed = checked.where("reason IS NULL")
    copies = stored(passed.select("row_id").join(first, "row_id", "left_anti"), "copies")
    num_copies = copies.count()
    num_kept = profile["_ok"] - num_copies
    texts = passed.select(*[f"`{c}`" for c in unified.columns])
    if num_copies <= BROADCAST_ROWS:
        kept = texts.join(F.broadcast(copies), "row_id", "left_anti")
    else:
        kept = stored(texts.join(copies, "row_id", "left_anti"), "kept")
    counts = {reason: profile[reason] for reason in LOCAL_REASONS}
    counts[DUPLICATE] = num_copies
    reasons = [(None, num_kept), *counts.items()]

    rows = random_split(render(kept, template, keep=keep), *ratios, seed=seed, stratify=stratify)
    rows = rows.select("row_id", "text", "split")
    if out:
        write_splits(rows, out)
    return Prepared(
        stats=_one_row(spark, profile, stat_names),
        reasons=spark.createDataFrame([r for r in reasons if r[1]], "reason string, n bigint"),
        rows=rows,
        kept_path=written[0],
        more_paths=written[1:],
    )


def _one_row(spark: SparkSession, row, names: list[str]) -> DataFrame:
    types = {int: "bigint", float: "double", dict: "map<string,bigint>"}
    schema = ", ".join(f"{n} {types[type(row[n])]}" for n in names)
    return spark.createDataFrame([tuple(row[n] for n in names)], schema)


def prepare_training_set(
    spark: SparkSession,
    source: str | DataFrame,
    *,
    template: str | None = None,
    config_template: str | None = None,
    **options,
) -> Prepared:
    """The same with a 90 / 10 split; the template is the argument, else the configured one."""
    chosen = template or config_template or "alpaca"
    return prepare_dataset(spark, source, template=chosen, ratios=(0.9, 0.1, 0.0), **options)


def split_sizes_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy("split").agg(F.count("*").alias("n"))
