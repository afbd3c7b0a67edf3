"""One key holds a third of the rows; results must stay whole and plans must combine early."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

import loomset.session as session
from loomset.operators import registry
from loomset.operators.evaluate import perplexity
from loomset.operators.telemetry import early_stopping_states, progress_rows, run_summary
from loomset.operators.unify import turns_to_unified
from loomset.session import join_lookup
from tests.conftest import plan
from tests.formulas import stopping

N = 6000


def hot(i, others):
    return 0 if i % 3 == 0 else 1 + i % others


def test_one_conversation(spark):
    rng = random.Random(1)
    rows = [(hot(i, 300), i, rng.choice(["user", "assistant", "system"]), rng.choice(["", f"t{i}"])) for i in range(N)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").repartition(8)
    want = {}
    for conv in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == conv]
        first = {role: next((t for _, _, who, t in mine if who == role and t), None) for role in ("user", "assistant")}
        if len(mine) >= 2 and all(first.values()):
            want[conv] = (first["user"], first["assistant"])
    assert {r["row_id"]: (r["instruction"], r["output"]) for r in turns_to_unified(df).collect()} == want
    assert plan(turns_to_unified(df)).count("Aggregate(") == 2


def versions(spark):
    rng = random.Random(2)
    start = datetime.datetime(2024, 1, 1)
    rows = [
        (i, f"m{hot(i, 40)}", f"v{hot(i, 7)}", "p", {"eval_loss": rng.randrange(50) / 10}, start + datetime.timedelta(minutes=rng.randrange(900)), "registered")
        for i in range(N)
    ]
    return rows, spark.createDataFrame(rows, registry.REGISTRY_SCHEMA).repartition(8)


def test_one_model_name(spark):
    rows, df = versions(spark)
    names = {r[1] for r in rows}
    latest = {n: max((r for r in rows if r[1] == n), key=lambda r: (r[5], -r[0]))[0] for n in names}
    best = {n: min((r for r in rows if r[1] == n), key=lambda r: (r[4]["eval_loss"], r[0]))[0] for n in names}
    assert {r["name"]: r["seq"] for r in registry.latest_versions(df).collect()} == latest
    assert {r["name"]: r["seq"] for r in registry.best_versions(df).collect()} == best
    changes = spark.createDataFrame([(1, "m0", "v0", "deployed")], "change_no int, name string, version string, status string")
    changed = [r["seq"] for r in registry.update_status(df, changes).where("status = 'deployed'").collect()]
    assert changed == [min(r[0] for r in rows if r[1:3] == ("m0", "v0"))]
    left = registry.delete_versions(df, changes.select("name", "version"))
    assert left.count() == sum(r[1:3] != ("m0", "v0") for r in rows)


@pytest.mark.parametrize("broadcast_rows", [0, 200_000])
def test_one_run(spark, broadcast_rows, monkeypatch):
    """Both ways of joining a lookup give the same rows."""
    monkeypatch.setattr(join_lookup, "__defaults__", ("left", broadcast_rows))
    at = datetime.datetime(2024, 1, 1)
    rows = [(hot(i, 50), i, at + datetime.timedelta(seconds=i), 1 / (1 + i % 97), 3) for i in range(N)]
    df = spark.createDataFrame(rows, "run_id int, step bigint, ts timestamp, eval_loss double, num_tokens int").repartition(8)
    shown = progress_rows(df, 10)
    last = {run: max(r[1] for r in rows if r[0] == run) for run in {r[0] for r in rows}}
    assert {r["step"] for r in shown.collect()} == {r[1] for r in rows if r[1] % 10 == 0 or r[1] == last[r[0]]}
    assert run_summary(df).where("run_id = 0").first()["total_steps"] == last[0]
    scored = df.select(F.col("run_id").alias("run"), F.col("eval_loss").alias("loss"), "num_tokens")
    assert perplexity(scored).where("run = 0").first()["total_tokens"] == N
    states = early_stopping_states(df, chunk_steps=64).where("run_id = 0").orderBy("step").collect()
    want = stopping([r[3] for r in rows if r[0] == 0], 3, 0.001)
    assert [(r["best_loss"], r["wait_count"], r["should_stop"]) for r in states] == want


def test_lookup_size_is_checked(spark, monkeypatch):
    big = spark.range(100).withColumn("k", F.col("id") % 5)
    small = spark.range(5).select(F.col("id").alias("k"), F.col("id").alias("v"))
    assert "BroadcastHashJoin" in plan(join_lookup(big, small, ["k"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(join_lookup(big, small, ["k"], max_rows=5))
        assert "SortMergeJoin" in plan(join_lookup(big, small, ["k"], max_rows=4))
        monkeypatch.setattr("loomset.session.BROADCAST_BYTES", 20)
        assert "SortMergeJoin" in plan(join_lookup(big, small, ["k"], max_rows=5))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Cluster:
        class sparkContext:
            master = "spark://head:7077"

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Cluster)
    assert session.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
