"""Evaluate one model, and compare several."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.operators.compare import (
    add_models,
    best_models,
    comparison_summary,
    evaluation_summaries,
    improvements,
    result_rows,
)
from loomset.operators.evaluate import perplexity, task_accuracy, text_metrics
from loomset.operators.scoring import Factory, review_samples, score_batches
from loomset.session import materialize
from loomset.sources.sinks import write_metrics, write_review_csv, write_review_markdown


def evaluate_model(
    dataset: DataFrame,
    scored: DataFrame,
    *,
    model_name: str = "",
    dataset_name: str = "",
    pairs: DataFrame | None = None,
    answers: DataFrame | None = None,
    out: str | None = None,
    review: int = 0,
    factory: Factory | None = None,
) -> DataFrame:
    """Result rows of one model.

    ``scored`` holds ``(loss, num_tokens)``; ``pairs`` adds the text metrics and ``answers`` the
    accuracy. Each is one aggregate to a single row, and these rows are joined as subqueries.
    """
    metrics = perplexity(scored, ()).select("perplexity")
    if pairs is not None:
        text = text_metrics(pairs)
        scores = text.select(F.struct(*text.columns).alias("t")).scalar()
        metrics = metrics.withColumn("_t", scores)
        metrics = metrics.select("perplexity", *[F.col(f"_t.{n}").alias(n) for n in text.columns])
    if answers is not None:
        metrics = metrics.withColumn("accuracy", task_accuracy(answers).select("accuracy").scalar())
    size = dataset.agg(F.count("*").alias("n")).scalar()
    metrics = metrics.withColumn("num_samples", size)
    rows = result_rows(metrics, model_name, dataset_name, F.col("num_samples"))
    if out:
        rows = materialize(rows, "results")
        write_metrics(rows, f"{out}/eval_results")
        if review > 0:
            if factory is None:
                raise ValueError("review samples need a model factory")
            # Written once: both sheets must show the same generations.
            samples = materialize(review_samples(dataset, factory, review), "review")
            write_review_markdown(samples, f"{out}/human_eval_md")
            write_review_csv(samples, f"{out}/human_eval_csv")
    return rows


def evaluate_texts(dataset: DataFrame, score_factory, text: str = "text", batch_size: int = 4, **options) -> DataFrame:
    """The same for a model given as a scoring factory."""
    return evaluate_model(dataset, score_batches(dataset, score_factory, text, batch_size), **options)


@dataclass
class Comparison:
    results: DataFrame
    best: DataFrame
    improvement: DataFrame
    reports: DataFrame
    summary: DataFrame


def compare_models(*results: DataFrame, dataset_name: str = "") -> Comparison:
    """Reports over models in the order given; the first is the base."""
    table = add_models(*results)
    return Comparison(
        results=table,
        best=best_models(table),
        improvement=improvements(table),
        reports=evaluation_summaries(table),
        summary=comparison_summary(table, dataset_name),
    )
