import pytest

from loomset.operators.scoring import (
    GREEDY,
    GenerationOptions,
    generate,
    generate_and_check,
    generate_and_score,
    review_samples,
    score_batches,
    throughput,
    tokens_per_second,
)
from loomset.operators.evaluate import perplexity
from workload.stub_model import echo_factory


def test_call_options():
    sampling = GenerationOptions().call_options(7)
    assert sampling == {
        "max_new_tokens": 256, "do_sample": True, "pad_token_id": 7,
        "temperature": 0.7, "top_p": 0.9, "top_k": 50, "repetition_penalty": 1.1,
    }
    assert set(GREEDY.call_options()) == {"max_new_tokens", "do_sample", "pad_token_id"}
    assert GenerationOptions(repetition_penalty=1.5).call_options()["repetition_penalty"] == 1.5
    assert GenerationOptions(num_beams=4).call_options()["num_beams"] == 4
    assert "num_beams" not in GenerationOptions().call_options()


def test_batches(spark):
    def sizes_factory():
        """Reports the size of the batch each prompt came in."""
        return lambda prompts, options: [(f"{len(prompts)} {sorted(options)}", len(prompts)) for _ in prompts]

    df = spark.createDataFrame([(i, f"p{i}") for i in range(10)], "row_id int, prompt string").coalesce(1)
    rows = generate(df, sizes_factory, GREEDY, batch_size=4).orderBy("row_id").collect()
    assert [r["num_tokens"] for r in rows] == [4] * 8 + [2] * 2
    assert rows[0]["generated_text"] == "4 ['do_sample', 'max_new_tokens', 'pad_token_id']"
    assert all(r["generation_time"] >= 0 for r in rows)
    assert generate(df.where("false"), sizes_factory).count() == 0
    with pytest.raises(ValueError):
        generate(df, sizes_factory, batch_size=0)


def test_throughput(spark):
    df = spark.createDataFrame([(100, 2.0), (100, 0.0), (100, -1.0)], "num_tokens bigint, generation_time double")
    assert [r[0] for r in df.select(tokens_per_second()).collect()] == [50.0, 0.0, 0.0]
    total = throughput(df).first()
    assert total["tokens_per_second"] == 300.0 and total["num_prompts"] == 3
    assert throughput(df.where("false")).first()["tokens_per_second"] == 0.0


def test_generate_then_score(spark):
    df = spark.createDataFrame([("a b", "answer: a b"), ("c", "zzz")], "text string, output string")
    row = generate_and_score(df, echo_factory).first()
    assert row["bleu"] == 0.5 and row["rouge_l"] == 0.5
    assert generate_and_check(df, echo_factory).first()["accuracy"] == 0.5


def test_review_samples(spark):
    df = spark.createDataFrame([(i, f"t{i}", None if i % 2 else f"o{i}") for i in range(40)], "row_id bigint, text string, output string")
    rows = review_samples(df, echo_factory, 10).orderBy("sample_id").collect()
    assert [r["sample_id"] for r in rows] == list(range(1, 11))
    for r in rows:
        at = r["metadata"]["index"]
        assert (r["prompt"], r["generated"]) == (f"t{at}", f"Answer: t{at}")
        assert r["reference"] == ("" if at % 2 else f"o{at}") and r["metadata"]["temperature"] == 0.7
    assert review_samples(df, echo_factory, 10, reference=None).first()["reference"] == ""


def test_loss_scoring(spark):
    def factory():
        return lambda texts, max_length: (2.0, sum(min(len(t), max_length) for t in texts))

    df = spark.createDataFrame([(0, "abc"), (1, "defgh"), (2, "x" * 50)], "row_id int, text string")
    rows = score_batches(df, factory, batch_size=2, max_length=10)
    assert sorted(r["num_tokens"] for r in rows.collect()) == [8, 10]
    assert perplexity(rows, ()).first()["perplexity"] == pytest.approx(7.389056, rel=1e-6)


def test_batches_do_not_depend_on_partitions(spark):
    def factory():
        return lambda texts, max_length: (float(len(texts[0])), len("".join(texts)))

    rows = spark.createDataFrame([(i, "x" * (i * 7 % 11)) for i in range(50)], "row_id int, text string")
    found = [sorted(tuple(r) for r in score_batches(rows.repartition(n), factory).collect()) for n in (1, 4, 7)]
    texts = ["x" * (i * 7 % 11) for i in range(50)]
    wanted = sorted((float(len(texts[i])), len("".join(texts[i : i + 4]))) for i in range(0, 50, 4))
    assert found == [wanted] * 3
