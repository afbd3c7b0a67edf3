"""Text metrics over (prediction, reference) pairs, accuracy and perplexity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.functions.overlap import f1, ngrams, overlap_counts, shared_count
from loomset.functions.ordering import row_positions
from loomset.functions.text import py_strip, tokens

# Fixed value: a mean loss at or above this counts as infinite perplexity.
MAX_MEAN_LOSS = 100.0


def align_pairs(predictions: DataFrame, references: DataFrame, on: str = "pair_id") -> DataFrame:
    """Pair two tables by id. A row without a partner fails the job, as a strict zip would."""
    left = predictions.select(on, "prediction", F.lit(True).alias("_has_p"))
    right = references.select(on, "reference", F.lit(True).alias("_has_r"))
    lonely = F.col("_has_p").isNull() | F.col("_has_r").isNull()
    message = F.concat(F.lit("prediction and reference tables differ at "), F.col(on).cast("string"))

    def checked(name: str) -> Column:
        return F.when(lonely, F.raise_error(message).cast("string")).otherwise(F.col(name)).alias(name)

    return left.join(right, on, "full_outer").select(on, checked("prediction"), checked("reference"))


def unaligned(predictions: DataFrame, references: DataFrame, on: str = "pair_id") -> DataFrame:
    """Ids present on one side only."""
    only_p = predictions.join(references, on, "left_anti").select(on, F.lit("prediction").alias("side"))
    only_r = references.join(predictions, on, "left_anti").select(on, F.lit("reference").alias("side"))
    return only_p.unionByName(only_r)


def _tokenized(pairs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    return pairs.select(
        *keep,
        tokens(F.coalesce("prediction", F.lit(""))).alias("_p"),
        tokens(F.coalesce("reference", F.lit(""))).alias("_r"),
    )


def _bleu(shared: Column, p_size: Column, r_size: Column) -> Column:
    """Clipped unigram precision times the capped length ratio; 0 when a side is empty."""
    score = (shared / p_size) * F.least(F.lit(1.0), p_size / r_size)
    return F.when((p_size == 0) | (r_size == 0), F.lit(0.0)).otherwise(score)


def pair_bleu(pairs: DataFrame, keep: tuple[str, ...] = ("pair_id",)) -> DataFrame:
    """Adds the simplified BLEU of each pair, all in native columns."""
    counted = _tokenized(pairs, keep).withColumn("_shared", shared_count(F.col("_p"), F.col("_r")))
    return counted.select(*keep, _bleu(F.col("_shared"), F.size("_p"), F.size("_r")).alias("bleu"))


def pair_rouge_n(pairs: DataFrame, n: int, keep: tuple[str, ...] = ("pair_id",)) -> DataFrame:
    """Adds the n-gram F1 of each pair, all in native columns."""
    grams = _tokenized(pairs, keep).select(*keep, ngrams(F.col("_p"), n).alias("_p"), ngrams(F.col("_r"), n).alias("_r"))
    counted = grams.withColumn("_shared", shared_count(F.col("_p"), F.col("_r")))
    return counted.select(*keep, f1(F.col("_shared"), F.size("_p"), F.size("_r")).alias(f"rouge_{n}"))


def pair_rouge_l(pairs: DataFrame, keep: tuple[str, ...] = ("pair_id",)) -> DataFrame:
    """Adds the longest-common-subsequence F1 of each pair."""
    return pair_metrics(pairs, keep).select(*keep, "rouge_l")


def pair_metrics(pairs: DataFrame, keep: tuple[str, ...] = ("pair_id",)) -> DataFrame:
    """BLEU, ROUGE-1, ROUGE-2 and ROUGE-L of each pair in one pass without a shuffle."""
    texts = [F.coalesce(c, F.lit("")) for c in ("prediction", "reference")]
    counted = pairs.select(*keep, overlap_counts(*texts).alias("_c"))
    p, r = F.col("_c.left"), F.col("_c.right")
    return counted.select(
        *keep,
        _bleu(F.col("_c.uni"), p, r).alias("bleu"),
        f1(F.col("_c.uni"), p, r).alias("rouge_1"),
        f1(F.col("_c.bi"), p - 1, r - 1).alias("rouge_2"),
        f1(F.col("_c.lcs"), p, r).alias("rouge_l"),
    )


def mean_of(scores: DataFrame, *names: str) -> DataFrame:
    """Corpus means; 0 for an empty table. Every pair counts, also those that score 0."""
    return scores.agg(*[F.coalesce(F.avg(n), F.lit(0.0)).alias(n) for n in names])


def text_metrics(pairs: DataFrame) -> DataFrame:
    return mean_of(pair_metrics(pairs, ()), "bleu", "rouge_1", "rouge_2", "rouge_l")


def task_accuracy(
    answers: DataFrame, generated: str = "generated_text", expected: str = "expected", strict: bool = False
) -> DataFrame:
    """Share of rows whose generation and label contain one another (or are equal, if strict).

    A row without generation or label is a miss.
    """
    g, e = F.lower(py_strip(F.col(generated))), F.lower(py_strip(F.col(expected)))
    hit = (g == e) if strict else (F.contains(g, e) | F.contains(e, g))
    return answers.agg(F.coalesce(F.avg(F.coalesce(hit, F.lit(False)).cast("double")), F.lit(0.0)).alias("accuracy"), F.count("*").alias("n"))


def perplexity(scored: DataFrame, by: tuple[str, ...] = ("run",)) -> DataFrame:
    """Token-weighted perplexity per group from ``(loss, num_tokens)`` rows.

    Works on a batch or streaming table; partial sums are formed before the shuffle. A row without a
    loss adds neither loss nor tokens.
    """
    grouped = scored.groupBy(*by) if by else scored.groupBy()
    sums = grouped.agg(
        F.sum(F.col("loss") * F.col("num_tokens")).alias("_loss"),
        F.coalesce(F.sum(F.when(F.col("loss").isNotNull(), F.col("num_tokens"))), F.lit(0)).alias("total_tokens"),
    )
    mean = F.when(F.col("total_tokens") > 0, F.col("_loss") / F.col("total_tokens"))
    value = F.when(mean < MAX_MEAN_LOSS, F.exp(mean)).otherwise(F.lit(float("inf")))
    return sums.select(*by, value.alias("perplexity"), "total_tokens")


def batch_ids(df: DataFrame, batch_size: int = 4, order: str = "row_id") -> DataFrame:
    """Adds ``batch_id``: consecutive groups of ``batch_size`` rows in ``order``."""
    numbered = row_positions(df, order, "_at")
    return numbered.withColumn("batch_id", F.floor(F.col("_at") / batch_size)).drop("_at")
