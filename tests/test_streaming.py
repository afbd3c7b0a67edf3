import random

from pyspark.sql import functions as F

from loomset.functions.templates import render
from loomset.operators.cost import HOURLY_PRICES, estimate_cost
from loomset.operators.evaluate import perplexity
from loomset.operators.telemetry import metric_rows, progress_rows, run_bounds
from loomset.operators.unify import to_unified
from loomset.operators.validate import filter_lengths, filter_quality
from loomset.streaming.jobs import drain, score_stream
from loomset.streaming.telemetry import batches_written, run_states, start_early_stopping, start_progress
from tests.formulas import stopping
from workload.stub_model import echo_factory


def stream_of(spark, df, folder, files=1):
    path = str(folder)
    if files == 1:
        df.write.mode("append").parquet(path)
    else:
        for k in range(files):
            df.where(f"step % {files} = {k}" if "step" not in df.columns else f"part = {k}").drop("part").coalesce(1).write.mode(
                "append"
            ).parquet(path)
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


STATE_ROWS = "run_id string, step bigint, eval_loss double, best_loss double, wait_count bigint, should_stop boolean"


def stop_stream(stream, folder):
    names = [f"{folder}/{x}" for x in ("out", "states", "check")]
    start_early_stopping(stream, *names, patience=3, min_delta=0.01, chunk_steps=16, once=True).awaitTermination()
    return names


def test_early_stopping_over_micro_batches_equals_the_loop(spark, tmp_path):
    """Five micro-batches; one run has a third of the rows, one begins late, one with a NaN."""
    rng = random.Random(2)
    lengths = {"hot": 600, **{f"r{i}": 120 for i in range(10)}}
    runs = {r: [round(rng.uniform(0, 1) / (1 + s / 50), 3) for s in range(n)] for r, n in lengths.items()}
    runs["odd"] = [float("nan"), 0.5, 0.4]
    rows = [(r, s, x, s * 5 // len(losses)) for r, losses in runs.items() for s, x in enumerate(losses)]
    rows += [("late", s, 1.0 - s / 10, 4) for s in range(5)]
    runs["late"] = [1.0 - s / 10 for s in range(5)]
    df = spark.createDataFrame(rows, "run_id string, step bigint, eval_loss double, part int").repartition(6)
    source = str(tmp_path / "in")
    for part in range(5):
        df.where(f"part = {part}").drop("part").write.mode("append").parquet(source)
        stream = spark.readStream.schema("run_id string, step bigint, eval_loss double").parquet(source)
        out, states, check = stop_stream(stream, tmp_path)
    got = batches_written(spark, out, STATE_ROWS)
    want = {(r, s): state for r, losses in runs.items() for s, state in enumerate(stopping(losses, 3, 0.01))}
    text = lambda x: None if x is None or x != x else x
    assert {(r["run_id"], r["step"]): (r["best_loss"], r["wait_count"], r["should_stop"]) for r in got.collect()} == {k: (text(v[0]), *v[1:]) for k, v in want.items()}
    assert got.count() == len(rows)
    for r in run_states(spark, states).collect():
        mine = [want[r["run_id"], s] for s in range(len(runs[r["run_id"]]))]
        assert (r["best_loss"], r["wait_count"]) == (text(mine[-1][0]), mine[-1][1])
        assert r["stop_step"] == next((s for s, state in enumerate(mine) if state[2]), None)
    kept = sorted(p.name for p in (tmp_path / "states").iterdir())
    assert kept == ["batch=3", "batch=4"]


def test_a_micro_batch_that_comes_again_changes_nothing(spark, tmp_path):
    df = spark.createDataFrame([("r", s, 1.0 / (1 + s)) for s in range(40)], "run_id string, step bigint, eval_loss double")
    out, states, check = stop_stream(stream_of(spark, df.withColumn("part", F.col("step") % 1), tmp_path / "in"), tmp_path)
    before = sorted(map(tuple, batches_written(spark, out, STATE_ROWS).collect()))
    left = sorted(map(tuple, run_states(spark, states).collect()))
    (tmp_path / "check" / "commits" / "0").unlink()  # as after a crash between the work and its commit
    for crc in (tmp_path / "check" / "commits").glob(".0*"):
        crc.unlink()
    stop_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), tmp_path)
    assert sorted(map(tuple, batches_written(spark, out, STATE_ROWS).collect())) == before
    assert sorted(map(tuple, run_states(spark, states).collect())) == left


def test_stateless_operators_run_on_streams(spark, tmp_path):
    rows = [(i, "say it" if i % 2 else "", "ctx", f"answer {i}") for i in range(20)]
    df = spark.createDataFrame(rows, "row_id bigint, instruction string, context string, response string")
    job = lambda t: render(filter_lengths(filter_quality(to_unified(t))), "chatml")
    got = drain(job(stream_of(spark, df, tmp_path / "in")), "rendered")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, job(df).collect()))
    assert got.count() == 10


def progress_of(spark, stream, runs, folder, schema):
    start_progress(stream, runs, 5, f"{folder}/out", f"{folder}/check", once=True).awaitTermination()
    return batches_written(spark, f"{folder}/out", schema)


def test_progress_and_metrics(spark, tmp_path):
    df = spark.sql(
        "SELECT 'r' || id % 3 AS run_id, id AS step, timestamp'2024-01-01' + make_interval(0,0,0,0,0,0,id * 2.5) AS ts, "
        "id / 7.0D AS loss FROM range(60)"
    )
    want = progress_rows(df, 5)
    got = progress_of(spark, stream_of(spark, df, tmp_path / "in"), lambda: run_bounds(df), tmp_path, want.schema)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    rows = drain(metric_rows(stream_of(spark, df, tmp_path / "in2")), "metrics")
    assert rows.count() == 60


def test_progress_learns_runs_between_micro_batches(spark, tmp_path):
    df = spark.sql("SELECT concat('r', id % 4) AS run_id, id AS step, timestamp_seconds(id * 3) AS ts, 1.0D AS loss FROM range(80)")
    want, known = progress_rows(df, 5), []
    for k in range(4):
        df.where(f"run_id = 'r{k}'").write.mode("append").parquet(str(tmp_path / "in"))
        known.append(f"r{k}")
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        got = progress_of(spark, stream, lambda: run_bounds(df).where(F.col("run_id").isin(known)), tmp_path, want.schema)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.where("eta_s IS NULL").count() == 0


def test_running_perplexity(spark, tmp_path):
    df = spark.createDataFrame([("a", 2.0, 3), ("a", 4.0, 1)], "run string, loss double, num_tokens bigint")
    query = (
        perplexity(stream_of(spark, df, tmp_path / "in"))
        .writeStream.outputMode("complete").format("memory").queryName("ppl")
        .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert [tuple(r) for r in spark.table("ppl").collect()] == [tuple(r) for r in perplexity(df).collect()]


def test_scoring_stream(spark, tmp_path):
    df = spark.createDataFrame([(i, f"p {i}") for i in range(9)], "row_id int, prompt string")
    got = drain(score_stream(stream_of(spark, df, tmp_path / "in"), echo_factory), "scored")
    assert {(r["row_id"], r["generated_text"], r["num_tokens"]) for r in got.collect()} == {
        (i, f"Answer: p {i}", 3) for i in range(9)
    }


def test_costs(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, rng.choice([*HOURLY_PRICES, "other"]), round(rng.uniform(0, 500), 1)) for i in range(3000)]
    rows += [(3000, "ml.g5.xlarge", 10.0), (3001, "ml.g5.2xlarge", 49.0)]
    df = spark.createDataFrame(rows, "usage_id int, instance_type string, hours double")
    for r in estimate_cost(df).collect():
        price = HOURLY_PRICES.get(r["instance_type"], 0.0)
        assert r["total_cost_usd"] == round(price * r["hours"], 2)
        assert r["known_pricing"] == (r["instance_type"] in HOURLY_PRICES) and r["hourly_cost_usd"] == price
    assert drain(estimate_cost(stream_of(spark, df, tmp_path / "in")), "cost").count() == len(rows)


def test_progress_keeps_events_of_unknown_runs(spark, tmp_path):
    df = spark.sql(
        "SELECT concat('r', id % 3) AS run_id, id AS step, timestamp_seconds(id) AS ts, 1.0D AS loss FROM range(30)"
    )
    known = lambda: run_bounds(df.where("run_id <> 'r2'"))
    got = progress_of(spark, stream_of(spark, df, tmp_path / "in"), known, tmp_path, progress_rows(df, 5).schema)
    rows = {r["step"]: (r["total_steps"], r["eta_s"]) for r in got.collect() if r["run_id"] == "r2"}
    assert rows == {5: (None, None), 20: (None, None)}
