"""What Spark is asked to do: pushed filters, number of shuffles, no Python where none is needed."""

import pytest
from pyspark.sql import functions as F

from loomset.functions.templates import render
from loomset.operators import cost, evaluate, registry, stats, telemetry, unify, validate
from loomset.operators.split import random_split
from loomset.session import materialize
from loomset.sources.readers import read_split
from tests.conftest import plan
from workload.queries import QUERIES


def exchanges(df):
    return plan(df).count("Exchange ")


@pytest.fixture(scope="module")
def table(spark, unified):
    rows = [(f"instruction {i}", "", f"output {i}") for i in range(64)]
    return materialize(unified(*rows), "plans")


@pytest.mark.parametrize("name", ["alpaca", "chatml", "llama3", "mistral"])
def test_projections_need_no_shuffle_and_no_python(table, name):
    job = render(validate.filter_lengths(validate.filter_quality(unify.to_unified(table))), name)
    assert exchanges(job) == 0 and "Python" not in plan(job) and "Arrow" not in plan(job)


def test_unified_scan_reads_only_what_is_used(table):
    text = plan(unify.to_unified(table, "oasst").select("row_id", "instruction"))
    assert "ReadSchema: struct<row_id:bigint,instruction:string>" in text


def test_deduplication_shuffles_once_and_drops_copies_before(table):
    for job in (validate.drop_duplicates(table), validate.validate_all(table)):
        text = plan(job)
        assert exchanges(job) == 1 and text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_texts_are_checked_once(spark, table):
    assert plan(validate.validate_all(table)).count("regexp_replace") == plan(validate.with_local_reason(table)).count("regexp_replace")
    flags = plan(validate.flags(table))
    assert "regexp_replace" not in flags and "instruction" not in flags  # they were checked when the narrow table was written
    assert "instruction" in plan(validate.flag_all(table)) and "regexp_replace" not in plan(validate.flag_all(table))


def test_reason_counts_combine_before_the_shuffle(table):
    text = plan(validate.reason_counts(table))
    assert "Window" not in text and text.count("HashAggregate") == 4 and "Join" not in text


def test_stats_are_one_aggregate(table):
    job = stats.dataset_stats(table)
    assert exchanges(job) == 1 and "Exchange SinglePartition" in plan(job)


def test_split_moves_no_rows(table):
    assert exchanges(random_split(table)) == 0


def test_text_metrics_move_no_rows(spark, table):
    pairs = table.select(F.col("row_id").alias("pair_id"), F.col("instruction").alias("prediction"), F.col("output").alias("reference"))
    for job in (evaluate.pair_bleu(pairs), evaluate.pair_rouge_n(pairs, 2)):
        assert exchanges(job) == 0 and "Python" not in plan(job)
    both = evaluate.pair_metrics(pairs)
    assert exchanges(both) == 0 and plan(both).count("ArrowEvalPython") == 1


def test_filters_and_partitions_reach_the_scan(spark, tmp_path):
    df = spark.range(10).selectExpr("id AS row_id", "CASE WHEN id % 2 = 0 THEN 'train' ELSE 'test' END AS split")
    df.write.partitionBy("split").parquet(str(tmp_path / "t"))
    assert "PartitionFilters: [isnotnull(split" in plan(read_split(spark, str(tmp_path), "t", "test"))
    schema = "seq long, name string, version string, path string, metrics map<string,double>, timestamp timestamp, status string"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "r"))
    rows = registry.list_models(spark.read.parquet(str(tmp_path / "r")), "m")
    assert "PushedFilters: [IsNotNull(name), EqualTo(name,m)]" in plan(rows)


def test_price_list_is_broadcast(spark, table):
    usage = table.select(F.col("row_id").alias("usage_id"), F.col("instruction").alias("instance_type"), F.lit(1.0).alias("hours"))
    assert "BroadcastHashJoin" in plan(cost.estimate_cost(usage))


def test_top_k_is_cut_before_the_shuffle(table):
    events = table.select(F.col("instruction").alias("run_id"), F.col("row_id").alias("step"), F.rand(1).alias("eval_loss"))
    events = materialize(events, "events")
    assert "WindowGroupLimit" in plan(telemetry.top_checkpoints(events)) and exchanges(telemetry.top_checkpoints(events)) == 1
    assert "Window " not in plan(telemetry.best_checkpoint(events))


@pytest.mark.parametrize("name", ["template_alpaca_train", "unify_alpaca", "unify_nested_messages", "quality_filter"])
def test_registered_row_queries_do_not_shuffle(spark, name):
    assert exchanges(QUERIES[name](spark, "/root/testdata/sf0.001")) == 0
