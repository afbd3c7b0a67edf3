import json
import os

import pytest
from pyspark.sql import functions as F

from loomset.plans.evaluate import evaluate_model, evaluate_texts
from loomset.plans.prepare import prepare_dataset, prepare_training_set, split_sizes_of
from loomset.session import materialize, scratch_root
from workload.stub_model import echo_factory, length_loss_factory

GOOD = [(f"instruction number {i}", "ctx" if i % 2 else "", f"the answer is {i}") for i in range(200)]
BAD = [("", "", "x y z"), ("Hi", "", "x y z"), GOOD[0], GOOD[1], ("long enough", "", "a" * 9000)]


def test_prepare_from_a_file(spark, tmp_path):
    path = tmp_path / "raw.json"
    path.write_text(json.dumps([dict(zip(("instruction", "input", "output"), row)) for row in GOOD + BAD]))
    job = prepare_dataset(spark, str(path), out=str(tmp_path / "out"), template="mistral")
    assert {r["reason"]: r["n"] for r in job.reasons.collect()} == {
        None: 200, "empty_instruction": 1, "instruction_too_short": 1, "duplicate": 2, "length_out_of_range": 1,
    }
    stats = job.stats.first()
    assert stats["num_samples"] == 205 and stats["max_output_len"] == 9000
    assert sum(stats["token_length_distribution"].values()) == 205
    assert {r["split"]: r["n"] for r in split_sizes_of(job.rows).collect()} == {"train": 180, "validation": 10, "test": 10}
    written = spark.read.schema("text string, split string").json(str(tmp_path / "out"))
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, job.rows.select("text", "split").collect()))
    first = next(r["text"] for r in job.rows.collect() if "number 1 " in r["text"].replace("\n", " "))
    assert first == "[INST] instruction number 1\nctx [/INST] the answer is 1"


def test_training_set_and_template_precedence(spark, unified):
    df = unified(*GOOD)
    sizes = lambda job: {r["split"]: r["n"] for r in split_sizes_of(job.rows).collect()}
    job = prepare_training_set(spark, df, config_template="chatml")
    assert sizes(job) == {"train": 180, "validation": 20}
    assert job.rows.first()["text"].startswith("<|im_start|>")
    assert prepare_training_set(spark, df).rows.first()["text"].startswith("Below is")
    both = prepare_training_set(spark, df, template="mistral", config_template="chatml")
    assert both.rows.first()["text"].startswith("[INST]")
    with pytest.raises(ValueError, match="no template"):
        prepare_training_set(spark, df, template="nope")


def test_stratified_preparation(spark, unified):
    df = unified(*GOOD).withColumn("topic", F.when(F.col("row_id") % 4 == 0, "a").otherwise("b"))
    rows = prepare_dataset(spark, df, stratify="topic").rows.join(df.select("row_id", "topic"), "row_id")
    got = {(r["topic"], r["split"]): r["count"] for r in rows.groupBy("topic", "split").count().collect()}
    assert got == {
        ("a", "train"): 45, ("a", "validation"): 2, ("a", "test"): 3, ("b", "train"): 135, ("b", "validation"): 8, ("b", "test"): 7,
    }


def test_evaluation_job(spark, tmp_path):
    data = spark.createDataFrame([(i, f"text {i}", f"text {i}") for i in range(30)], "row_id bigint, text string, output string")
    rows = evaluate_texts(
        data, length_loss_factory, model_name="m", dataset_name="d", out=str(tmp_path), review=5, factory=echo_factory
    )
    r = rows.first()
    assert (r["model_name"], r["dataset_name"], r["num_samples"], r["metric"]) == ("m", "d", 30, "perplexity")
    assert spark.read.json(str(tmp_path / "eval_results")).first()["value"] == r["value"]
    sheet = spark.read.csv(str(tmp_path / "human_eval_csv"), header=True)
    assert sheet.count() == 5
    shown = "".join(p.read_text() for p in (tmp_path / "human_eval_md").glob("part-*"))
    assert all(row["generated"] in shown for row in sheet.collect())
    scored = spark.createDataFrame([(1.0, 3)], "loss double, num_tokens bigint")
    with pytest.raises(ValueError):
        evaluate_model(data, scored, out=str(tmp_path / "x"), review=1)


def test_duplicates_beyond_the_broadcast(spark, unified, monkeypatch):
    df = unified(*GOOD, *[GOOD[0]] * 100)
    rows = lambda job: sorted(map(tuple, job.rows.collect()))
    expected = rows(prepare_dataset(spark, df))
    monkeypatch.setattr("loomset.plans.prepare.BROADCAST_ROWS", 10)
    job = prepare_dataset(spark, df)
    assert rows(job) == expected and len(expected) == 200
    assert {r["reason"]: r["n"] for r in job.reasons.collect()} == {None: 200, "duplicate": 100}


def test_scratch_tables(spark, unified):
    table = materialize(unified(*GOOD), "trial")
    assert scratch_root(spark) in table.inputFiles()[0] and table.count() == 200
    job = prepare_dataset(spark, unified(*GOOD))
    paths = [job.kept_path, *job.more_paths]
    assert all(map(os.path.exists, paths))
    job.release()
    assert not any(map(os.path.exists, paths))
