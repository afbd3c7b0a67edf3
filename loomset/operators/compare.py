"""Evaluation results, model comparison and their text reports.

Results are a long table ``(pos, model_name, dataset_name, num_samples, metric_no, metric, value)``;
``pos`` is the order in which models were added. A model without values has one row whose metric is null,
so that it is still counted, listed, and first or last.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.functions.rounding import fixed, percent

RESULT_SCHEMA = (
    "pos int, model_name string, dataset_name string, num_samples bigint, "
    "metric_no int, metric string, value double"
)
RESULT_COLUMNS = ["pos", "model_name", "dataset_name", "num_samples", "metric_no", "metric", "value"]

# Metrics where less is better, and the four with a named accessor.
LOWER_IS_BETTER = ("perplexity", "loss", "eval_loss")
NAMED = ("perplexity", "bleu", "rouge_l", "accuracy")


def result_rows(
    metrics: DataFrame, model_name: str, dataset_name: str, num_samples: Column | int, pos: int = 0
) -> DataFrame:
    """A one-row wide metrics table as long result rows; a model without values keeps one row without a metric."""
    names = [c for c in metrics.columns if c != "num_samples"]
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("metric_no"), F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"))
            for i, n in enumerate(names)
        ]
    )
    count = F.lit(num_samples) if isinstance(num_samples, int) else num_samples
    return metrics.select(
        F.lit(pos).alias("pos"),
        F.lit(model_name).alias("model_name"),
        F.lit(dataset_name).alias("dataset_name"),
        count.cast("bigint").alias("num_samples"),
        F.inline_outer(F.filter(entries, lambda e: e["value"].isNotNull())),
    )


def add_models(*results: DataFrame) -> DataFrame:
    """One comparison table; each result keeps or gets its list position."""
    placed = [r.select(*RESULT_COLUMNS).withColumn("pos", F.lit(i)) for i, r in enumerate(results)]
    return reduce(DataFrame.unionByName, placed)


def model_names(results: DataFrame) -> DataFrame:
    return results.select("pos", "model_name").distinct().orderBy("pos")


def wide_results(results: DataFrame, metrics: tuple[str, ...] = NAMED) -> DataFrame:
    """One row per model with a column per metric; null where the metric is absent."""
    keys = ("pos", "model_name", "dataset_name", "num_samples")
    picked = [F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in metrics]
    return results.groupBy(*keys).agg(*picked)


def _signed_value() -> Column:
    """Value turned so that less is always better."""
    return F.when(F.col("metric").isin(*LOWER_IS_BETTER), F.col("value")).otherwise(-F.col("value"))


def best_models(results: DataFrame) -> DataFrame:
    """Best model of every metric; the earlier model wins a tie. One combined aggregate."""
    ranked = results.where("value IS NOT NULL").select(
        "metric", F.struct(_signed_value().alias("v"), "pos").alias("_rank"), "model_name", "value"
    )
    best = F.min_by(F.struct("model_name", "value"), "_rank")
    return ranked.groupBy("metric").agg(best.alias("b")).select("metric", "b.model_name", "b.value")


def best_model(results: DataFrame, metric: str = "perplexity") -> DataFrame:
    return best_models(results.where(F.col("metric") == metric)).select("model_name")


def improvements(results: DataFrame) -> DataFrame:
    """Change from the first to the last model per metric, where both have a value.

    One aggregate per metric keeps its own first and last value; a metric counts when those two
    come from the first and the last model of the whole table.
    """
    per_metric = results.groupBy("metric").agg(
        F.min("pos").alias("_lo"),
        F.max("pos").alias("_hi"),
        F.min_by("value", "pos").alias("base_value"),
        F.max_by("value", "pos").alias("finetuned_value"),
    )
    first, last = (results.agg(how("pos")).scalar() for how in (F.min, F.max))
    pairs = per_metric.where("_lo < _hi").where((F.col("_lo") == first) & (F.col("_hi") == last))
    change = F.col("finetuned_value") - F.col("base_value")
    return pairs.where("base_value IS NOT NULL AND finetuned_value IS NOT NULL").select(
        "metric",
        "base_value",
        "finetuned_value",
        change.alias("absolute_change"),
        F.when(F.col("base_value") == 0, F.lit(0.0)).otherwise(change / F.col("base_value")).alias("relative_change"),
    )


def evaluation_summaries(results: DataFrame) -> DataFrame:
    """One report text per model."""
    wide = wide_results(results)

    def line(label: str, metric: str, text: Column) -> Column:
        return F.when(F.col(metric).isNotNull(), F.concat(F.lit(f"  {label}: "), text))

    lines = [
        F.lit("Evaluation Results:"),
        F.concat(F.lit("  Model: "), F.col("model_name")),
        F.concat(F.lit("  Dataset: "), F.col("dataset_name")),
        F.format_string("  Samples: %d", F.col("num_samples")),
        line("Perplexity", "perplexity", fixed(F.col("perplexity"), 2)),
        line("BLEU", "bleu", fixed(F.col("bleu"), 4)),
        line("ROUGE-L", "rouge_l", fixed(F.col("rouge_l"), 4)),
        line("Accuracy", "accuracy", percent(F.col("accuracy"), 2)),
    ]
    # array_join leaves the absent lines out.
    return wide.select("pos", "model_name", F.array_join(F.array(*lines), "\n").alias("summary"))


def comparison_summary(results: DataFrame, dataset_name: str = "") -> DataFrame:
    """The comparison report as numbered lines ``(line_no, line)``; lines of any number of models."""
    models = results.select("pos", "model_name").distinct()

    def lines(df: DataFrame, part_no: int, pos: Column, no: Column, text: Column) -> DataFrame:
        return df.select(F.lit(part_no).alias("part"), pos.alias("pos"), no.alias("no"), text.alias("line"))

    zero = F.lit(0)
    count = models.agg(F.count("*").alias("n"))
    head_lines = F.array(
        F.lit("Model Comparison Report:"),
        F.lit(f"  Dataset: {dataset_name}"),
        F.format_string("  Models compared: %d", F.col("n")),
        F.lit(""),
    )
    head = count.select(F.lit(0).alias("part"), zero.alias("pos"), F.posexplode(head_lines).alias("no", "line"))
    names = lines(models, 1, F.col("pos"), F.lit(-1), F.concat(F.lit("  "), F.col("model_name"), F.lit(":")))
    values = lines(
        results.where("value IS NOT NULL"),
        1,
        F.col("pos"),
        F.col("metric_no"),
        F.concat(F.lit("    "), F.col("metric"), F.lit(": "), fixed(F.col("value"), 4)),
    )
    gaps = lines(models, 1, F.col("pos"), F.lit(2**31 - 1), F.lit(""))
    best = lines(
        best_model(results), 2, zero, zero, F.concat(F.lit("  Best perplexity: "), F.col("model_name"))
    )
    change = lines(
        improvements(results).where("metric = 'perplexity'"),
        2,
        zero,
        F.lit(1),
        F.concat(
            F.lit("  Perplexity change: "),
            fixed(F.col("absolute_change"), 2, signed=True),
            F.lit(" ("),
            percent(F.col("relative_change"), 1, signed=True),
            F.lit(")"),
        ),
    )
    everything = reduce(DataFrame.unionByName, [head, names, values, gaps, best, change])
    return everything.select("part", "pos", "no", "line")
