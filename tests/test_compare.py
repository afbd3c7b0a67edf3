import pytest

from loomset.operators import compare
from loomset.plans.evaluate import compare_models


def result(spark, name, pos=0, **metrics):
    rows = [(pos, name, "ds", 10, i, m, v) for i, (m, v) in enumerate(metrics.items())]
    return spark.createDataFrame(rows, compare.RESULT_SCHEMA)


def test_best_and_ties(spark):
    table = compare.add_models(
        result(spark, "base", perplexity=12.0, bleu=0.2, train_loss=1.0),
        result(spark, "tuned", perplexity=8.0, bleu=0.2, train_loss=3.0),
        result(spark, "other", perplexity=8.0),
    )
    best = {r["metric"]: r["model_name"] for r in compare.best_models(table).collect()}
    # train_loss is not among the lower-is-better metrics of a comparison.
    assert best == {"perplexity": "tuned", "bleu": "base", "train_loss": "tuned"}
    assert compare.best_model(table, "absent").count() == 0
    assert [r["model_name"] for r in compare.model_names(table).collect()] == ["base", "tuned", "other"]


def test_improvement(spark):
    table = compare.add_models(
        result(spark, "base", perplexity=10.0, bleu=0.0, only_first=1.0),
        result(spark, "middle", perplexity=1.0),
        result(spark, "tuned", perplexity=8.0, bleu=0.5),
    )
    got = {r["metric"]: tuple(r)[1:] for r in compare.improvements(table).collect()}
    assert got == {"perplexity": (10.0, 8.0, -2.0, -0.2), "bleu": (0.0, 0.5, 0.5, 0.0)}
    assert compare.improvements(result(spark, "alone", perplexity=1.0)).count() == 0


def test_wide_and_summaries(spark):
    table = compare.add_models(result(spark, "m", perplexity=7.389, accuracy=0.125), result(spark, "n", bleu=0.5))
    rows = {r["model_name"]: r for r in compare.wide_results(table).collect()}
    assert rows["m"]["perplexity"] == 7.389 and rows["m"]["bleu"] is None and rows["n"]["bleu"] == 0.5
    texts = {r["model_name"]: r["summary"] for r in compare.evaluation_summaries(table).collect()}
    assert texts["m"] == (
        "Evaluation Results:\n  Model: m\n  Dataset: ds\n  Samples: 10\n  Perplexity: 7.39\n  Accuracy: 12.50%"
    )
    assert texts["n"].endswith("\n  BLEU: 0.5000")


def test_comparison_summary(spark):
    job = compare_models(
        result(spark, "base", perplexity=10.0, bleu=0.25), result(spark, "tuned", perplexity=8.0), dataset_name="ds"
    )
    lines = [r["line"] for r in job.summary.orderBy("part", "pos", "no").collect()]
    assert lines == [
        "Model Comparison Report:", "  Dataset: ds", "  Models compared: 2", "",
        "  base:", "    perplexity: 10.0000", "    bleu: 0.2500", "",
        "  tuned:", "    perplexity: 8.0000", "",
        "  Best perplexity: tuned", "  Perplexity change: -2.00 (-20.0%)",
    ]


def test_result_rows(spark):
    wide = spark.createDataFrame([(2.0, None, 7)], "perplexity double, bleu double, num_samples bigint")
    rows = compare.result_rows(wide, "m", "d", wide["num_samples"]).collect()
    assert [(r["metric"], r["value"], r["num_samples"]) for r in rows] == [("perplexity", 2.0, 7)]
    with pytest.raises(TypeError):
        compare.add_models()


def test_a_model_without_values_is_still_compared(spark):
    wide = spark.createDataFrame([(None, None)], "perplexity double, bleu double")
    silent = compare.result_rows(wide, "silent", "ds", 3)
    assert [(r["model_name"], r["num_samples"], r["metric"], r["value"]) for r in silent.collect()] == [("silent", 3, None, None)]
    base, tuned = result(spark, "base", perplexity=10.0), result(spark, "tuned", perplexity=8.0)
    job = compare_models(base, tuned, silent)
    assert [r["model_name"] for r in compare.model_names(job.results).collect()] == ["base", "tuned", "silent"]
    # The last model has no value to compare with.
    assert job.improvement.count() == 0
    assert {r["metric"]: r["model_name"] for r in job.best.collect()} == {"perplexity": "tuned"}
    lines = [r["line"] for r in job.summary.orderBy("part", "pos", "no").collect()]
    assert "  Models compared: 3" in lines and lines[-3:] == ["  silent:", "", "  Best perplexity: tuned"]
    texts = {r["model_name"]: r["summary"] for r in job.reports.collect()}
    assert texts["silent"] == "Evaluation Results:\n  Model: silent\n  Dataset: ds\n  Samples: 3"
    assert {r["metric"] for r in compare_models(base, silent, tuned).improvement.collect()} == {"perplexity"}


def test_infinite_values_are_spelt_as_python_does(spark):
    from loomset.functions.rounding import fixed, percent

    values = [float("inf"), float("-inf"), float("nan"), 2.5, -0.125]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for signed in (False, True):
        got = df.select(fixed(df.v, 2, signed), percent(df.v, 1, signed)).collect()
        sign = "+" if signed else ""
        assert [tuple(r) for r in got] == [(f"{v:{sign}.2f}", f"{v:{sign}.1%}") for v in values]
