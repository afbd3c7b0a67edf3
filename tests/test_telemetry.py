import datetime
import math
import random

import numpy as np
import pytest

import loomset.operators.telemetry as telemetry
from loomset.operators.telemetry import (
    best_checkpoint,
    checkpoint_history,
    early_stopping,
    early_stopping_states,
    eval_rows,
    metric_rows,
    progress_rows,
    run_reports,
    run_summary,
    top_checkpoints,
)
from tests.formulas import checkpoints, stopping


def evals(spark, runs, start=0, gap=1):
    rows = [(run, start + gap * i, x) for run, losses in runs.items() for i, x in enumerate(losses)]
    return spark.createDataFrame(rows, "run_id string, step bigint, eval_loss double").repartition(8)


def stop_of(spark, losses, **options):
    r = early_stopping(evals(spark, {"r": losses}), **options).first()
    return r["stop_step"], r["wait_count"]


def test_early_stopping_cases(spark):
    assert stop_of(spark, [1.0, 0.8, 0.6, 0.4]) == (None, 0)
    assert stop_of(spark, [0.5, 0.6, 0.7], patience=2) == (2, 2)
    assert stop_of(spark, [0.5, 0.6, 0.3, 0.4], patience=2) == (None, 1)
    assert stop_of(spark, [0.50, 0.499], min_delta=0.01) == (None, 1)
    assert stop_of(spark, [0.5, None, 0.6, None, 0.7], patience=2) == (4, 2)


@pytest.mark.parametrize("chunk_steps", [1, 3, 1 << 16])
def test_nan_losses(spark, chunk_steps):
    nan = float("nan")
    runs = {"late": [0.5, nan, 0.4, nan, nan, 0.3, 0.2], "first": [nan, 0.5, 0.4, 0.3], "all": [nan, nan]}
    rows = early_stopping_states(evals(spark, runs), 2, 0.001, chunk_steps).collect()
    got = {(r["run_id"], r["step"]): repr((r["best_loss"], r["wait_count"], r["should_stop"])) for r in rows}
    want = {
        (run, i): repr((None if math.isnan(best) else best, wait, stop))
        for run, losses in runs.items()
        for i, (best, wait, stop) in enumerate(stopping(losses, 2, 0.001))
    }
    assert got == want
    history = checkpoint_history(evals(spark, runs), 2, chunk_steps).where("run_id = 'late' AND admitted").collect()
    assert {r["step"] for r in history} == {0, 1, 2, 5, 6}


def random_runs(seed):
    rng = random.Random(seed)
    noisy = [round(rng.uniform(0, 1), 3) for _ in range(400)]
    creep = [1 - 0.0004 * i for i in range(300)]  # each step below min_delta
    mixed = [1 / (1 + i / 20) + rng.uniform(0, 0.02) for i in range(300)]
    return {"noisy": noisy, "creep": creep, "mixed": mixed, "one": [0.5], "flat": [0.2] * 50}


@pytest.mark.parametrize("chunk_steps", [1, 7, 64, 1 << 16])
@pytest.mark.parametrize("min_delta", [0.0, 0.001, 0.05])
def test_states_match_the_loop(spark, chunk_steps, min_delta):
    runs = random_runs(8)
    df = evals(spark, runs, start=3, gap=2)
    got = {}
    for r in early_stopping_states(df, 3, min_delta, chunk_steps).collect():
        got[(r["run_id"], r["step"])] = (r["best_loss"], r["wait_count"], r["should_stop"])
    want = {
        (run, 3 + 2 * i): state for run, losses in runs.items() for i, state in enumerate(stopping(losses, 3, min_delta))
    }
    assert got == want


@pytest.mark.parametrize("chunk_steps", [1, 7, 1 << 16])
@pytest.mark.parametrize("k", [1, 3, 10])
def test_checkpoints_match_the_loop(spark, chunk_steps, k):
    runs = {**random_runs(9), "ties": [0.3, 0.3, 0.2, 0.3, 0.2, 0.2, 0.1, 0.3]}
    df = evals(spark, runs)
    rows = checkpoint_history(df, k, chunk_steps).collect()
    assert len(rows) == sum(map(len, runs.values()))
    kept = {(r["run_id"], r["step"]) for r in top_checkpoints(df, k).collect()}
    for run, losses in runs.items():
        saved, held = checkpoints(losses, k)
        mine = [r for r in rows if r["run_id"] == run]
        assert {r["step"] for r in mine if r["admitted"]} == saved
        assert {r["step"] for r in mine if r["evicted"]} == saved - held
        assert {step for name, step in kept if name == run} == held


def test_large_k(spark, monkeypatch):
    df = evals(spark, {"r": [((i * 37) % 101) / 100 for i in range(100)]})
    want = {r["step"] for r in top_checkpoints(df, 20).collect()}
    monkeypatch.setattr(telemetry, "GROUP_LIMIT", 5)
    monkeypatch.setattr(telemetry, "CHUNK_STEPS", 8)
    assert {r["step"] for r in top_checkpoints(df, 20).collect()} == want


def test_best_checkpoint(spark):
    df = evals(spark, {"r": [0.5, 0.3, 0.4, 0.3]}, start=10, gap=10)
    assert best_checkpoint(df, "out/").first()["path"] == "out/checkpoint-step-20"
    assert best_checkpoint(df.where("false")).count() == 0


def events(spark):
    at = datetime.datetime(2024, 1, 1)
    rows = [
        ("a", s, at + datetime.timedelta(seconds=3.37 * s), s / 3, None if s % 2 else 1 / (s + 1), 0.1 / (s + 1), 2.00005, 4)
        for s in range(0, 23)
    ]
    schema = (
        "run_id string, step bigint, ts timestamp, epoch double, loss double, learning_rate double, "
        "grad_norm double, num_samples bigint"
    )
    return spark.createDataFrame(rows, schema).repartition(4)


def test_progress(spark):
    rows = progress_rows(events(spark), 5).orderBy("step").collect()
    assert [r["step"] for r in rows] == [0, 5, 10, 15, 20, 22]
    by_step = {r["step"]: r for r in rows}
    assert by_step[0]["eta_s"] == 0.0 and by_step[22]["eta_s"] == 0.0
    assert by_step[10]["elapsed_s"] == round(33.7, 1) and by_step[10]["eta_s"] == round(3.37 * 12, 1)
    assert by_step[10]["loss"] == round(1 / 11, 4) and by_step[10]["epoch"] == round(10 / 3, 2)
    assert by_step[5]["loss"] is None and by_step[5]["lr"] == 0.1 / 6
    with pytest.raises(ValueError):
        progress_rows(events(spark), 0)


def test_metric_and_eval_rows(spark):
    rows = metric_rows(events(spark)).collect()
    assert {r["metric"] for r in rows} == {"train/loss", "train/learning_rate", "train/grad_norm"}
    assert sum(r["metric"] == "train/loss" for r in rows) == 12
    schema = "run_id string, step int, eval_loss double, eval_runtime double"
    df = spark.createDataFrame([("a", 1, 0.5, None), ("a", 2, None, None), ("a", 3, None, 2.0)], schema)
    assert sorted(r["step"] for r in eval_rows(df).collect()) == [1, 3]


def test_run_summary(spark):
    summary = run_summary(events(spark), "out")
    r = summary.first()
    assert (r["total_steps"], r["train_loss"], r["eval_loss"]) == (22, 1 / 23, None)
    assert r["total_time_s"] == round(3.37 * 22, 1)
    assert math.isclose(r["samples_per_second"], 92 / (3.37 * 22))
    text = run_reports(summary).first()["summary"]
    assert text.splitlines() == [
        "Training Results:", "  Training time: 74.1s", "  Checkpoint: out/checkpoint-step-22",
        f"  Train loss: {1 / 23:.4f}", f"  Samples/sec: {92 / (3.37 * 22):.1f}",
    ]


# ------------------------------------------------------------------ chunk maps


def map_of(losses, low, min_delta):
    """A chunk's map from its rows."""
    known = np.where(np.isnan(losses), np.inf, losses)
    before = np.minimum.accumulate(np.concatenate(([low], known)))
    found = np.flatnonzero(known < before[:-1])
    return (*telemetry.chunk_map(known[found], found, len(losses), low, min_delta), len(losses))


def through(m, best, wait, min_delta):
    above, bests, waits, n = m
    hit = np.flatnonzero(above < best - min_delta)[:1]
    return (float(bests[hit[0]]), int(waits[hit[0]])) if len(hit) else (best, wait + n)


def stepwise(losses, best, wait, min_delta):
    for x in losses:
        best, wait = (x, 0) if x < best - min_delta else (best, wait + 1)
    return best, wait


@pytest.mark.parametrize("min_delta", [0.0, 0.01, 0.3])
def test_maps_and_their_composition_equal_the_loop(min_delta):
    rng = random.Random(6)
    for _ in range(400):
        fall = rng.choice([0.0, 0.001, 0.02])
        parts, level = [], 3.0
        for _ in range(4):
            parts.append([rng.choice([math.nan, level]) if rng.random() < 0.1 else round((level := level - fall) + rng.choice([0, 0.05]) * rng.random(), 4) for _ in range(rng.randint(1, 12))])
        start = 3.0 + rng.random() * min_delta
        low, best, wait, whole = 3.0, start, 5, None
        for part in parts:
            m = map_of(np.array(part), low, min_delta)
            assert through(m, best, wait, min_delta) == stepwise(part, best, wait, min_delta)
            best, wait = stepwise(part, best, wait, min_delta)
            low = min([low, *[x for x in part if not math.isnan(x)]])
            whole = m if whole is None else telemetry.compose(whole, m, min_delta)
        assert through(whole, start, 5, min_delta) == (best, wait)


def test_a_falling_run_leaves_few_records_per_chunk():
    n = 1 << 16
    falls = lambda rate: 5.0 - rate * np.arange(1, n + 1)
    assert len(map_of(falls(0.0015), 5.0, 0.001)[0]) <= 2
    assert len(map_of(falls(0.001 / 50), 5.0, 0.001)[0]) <= 52
    whole = map_of(falls(0.001 / 50), 5.0, 0.001)
    for k in range(1, 8):  # composing keeps the bound
        down = 0.001 / 50 * n * k
        whole = telemetry.compose(whole, map_of(falls(0.001 / 50) - down, 5.0 - down, 0.001), 0.001)
        whole = (*[x[: int((whole[0] >= 4.999).sum()) + 1] for x in whole[:3]], whole[3])
    assert len(whole[0]) <= 52 and whole[3] == 8 * n


@pytest.mark.parametrize("fan", [1, 2, 5])
def test_groups_of_chunks(spark, fan, monkeypatch):
    monkeypatch.setattr(telemetry, "FAN", fan)
    runs = random_runs(9)
    got = {(r["run_id"], r["step"]): (r["best_loss"], r["wait_count"]) for r in early_stopping_states(evals(spark, runs), 3, 0.01, 16).collect()}
    assert got == {(run, i): state[:2] for run, losses in runs.items() for i, state in enumerate(stopping(losses, 3, 0.01))}


def test_states_go_on_from_earlier_ones(spark):
    runs = {**random_runs(10), "nan": [math.nan, 1.0, 0.5], "new": [0.3, 0.1, 0.2]}
    df = evals(spark, runs)
    whole = {(r["run_id"], r["step"]): repr(tuple(r)[2:]) for r in early_stopping_states(df, 3, 0.01, 16).collect()}
    first = early_stopping_states(df.where("step < 130 AND run_id <> 'new'"), 3, 0.01, 16)
    left = first.groupBy("run_id").agg(telemetry.F.max_by("best_loss", "step").alias("best_loss"), telemetry.F.max_by("wait_count", "step").alias("wait_count"))
    rest = early_stopping_states(df.where("step >= 130 OR run_id = 'new'"), 3, 0.01, 16, start=left)
    assert {(r["run_id"], r["step"]): repr(tuple(r)[2:]) for r in first.unionByName(rest).collect()} == whole


def test_admission_jumps_to_the_same_rows():
    rng = random.Random(12)
    for _ in range(200):
        n, k = rng.randint(0, 300), rng.randint(1, 6)
        losses = [rng.choice([round(rng.random(), 2), math.inf, 1 - i / 300]) for i in range(n)]
        kept = sorted(rng.random() for _ in range(rng.randint(0, k)))
        want, best = [], list(kept)
        for x in losses:
            enters = len(best) < k or x < max(best)
            want.append(enters)
            if enters:
                best = sorted([*best, x])[:k]
        enters, left = telemetry.admitted(np.array(losses, float), kept, k)
        assert enters.tolist() == want and sorted(left) == best


def test_short_runs_with_scattered_steps_take_one_chunk(spark):
    runs = {f"r{k}": {1_000 * i + k: float((i * 7 + k) % 5) for i in range(12)} for k in range(4)}
    rows = [(r, step, loss) for r, steps in runs.items() for step, loss in steps.items()]
    df = spark.createDataFrame(rows, "run_id string, step bigint, eval_loss double")
    got = early_stopping_states(df, 3, 0.01, 16)
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInPandas") == 1
    want = [tuple(r) for r in early_stopping_states(df, 3, 0.01, 4).orderBy("run_id", "step").collect()]
    assert [tuple(r) for r in got.orderBy("run_id", "step").collect()] == want and len(want) == 48
