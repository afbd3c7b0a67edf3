import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loomset.functions.overlap import lcs_length, ngrams
from loomset.operators import evaluate
from tests import formulas


def pairs_of(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "pair_id int, prediction string, reference string")


def value(df, name):
    return df.orderBy("pair_id").collect()[0][name]


@pytest.mark.parametrize(
    "p, r, want",
    [
        ("the cat sat on the mat", "the cat sat on the mat", 1.0),
        ("hello world", "foo bar baz", 0.0),
        ("hello", "", 0.0),
        ("the cat sat", "the cat ran away", 0.5),
        ("", "", 0.0),
    ],
)
def test_bleu(spark, p, r, want):
    assert value(evaluate.pair_bleu(pairs_of(spark, (p, r))), "bleu") == pytest.approx(want)


def test_rouge(spark):
    df = pairs_of(spark, ("a b c", "a b c"), ("a b", "c d"), ("", "a"), ("a", "a"), ("a b c d", "a b c d"), ("a b c", "a c d"))
    by_id = lambda scores, name: [r[name] for r in scores.orderBy("pair_id").collect()]
    assert by_id(evaluate.pair_rouge_n(df, 1), "rouge_1")[:3] == [1.0, 0.0, 0.0]
    assert by_id(evaluate.pair_rouge_n(df, 2), "rouge_2")[3:5] == [0.0, 1.0]
    assert by_id(evaluate.pair_rouge_l(df), "rouge_l")[5] == pytest.approx(2 / 3)


def test_ngrams_of_short_texts(spark):
    df = spark.createDataFrame([([],), (["a"],), (["a", "b"],), (["a", "b", "c"],)], "t array<string>")
    got = [[r[f"n{n}"] for r in df.select(ngrams(F.col("t"), n).alias(f"n{n}")).collect()] for n in (1, 2, 3)]
    assert got == [
        [[], ["a"], ["a", "b"], ["a", "b", "c"]],
        [[], [], ["a b"], ["a b", "b c"]],
        [[], [], [], ["a b c"]],
    ]


def test_lcs_matches_the_table():
    rng = random.Random(4)
    for _ in range(300):
        a = [rng.choice("abcde") for _ in range(rng.randrange(0, 90))]
        b = [rng.choice("abcde") for _ in range(rng.randrange(0, 90))]
        assert lcs_length(a, b) == formulas.longest_common(a, b)


@pytest.mark.parametrize("partitions", [1, 8])
def test_all_metrics_match_the_formulas(spark, partitions):
    rng = random.Random(6)
    words = ["a", "b", "B", "ç", "Σ", "日本", "x y", " ", "\n", "the", "The", "cat"]
    text = lambda: " ".join(rng.choices(words, k=rng.randrange(0, 15)))
    rows = [(text(), text()) for _ in range(400)]
    df = pairs_of(spark, *rows).repartition(partitions)
    native = evaluate.pair_bleu(df).join(evaluate.pair_rouge_n(df, 1), "pair_id").join(evaluate.pair_rouge_n(df, 2), "pair_id")
    for scores in (evaluate.pair_metrics(df), native.join(evaluate.pair_rouge_l(df), "pair_id")):
        got = scores.orderBy("pair_id").collect()
        assert len(got) == len(rows)
        for r, (p, ref) in zip(got, rows):
            assert r["bleu"] == pytest.approx(formulas.bleu(p, ref))
            assert r["rouge_1"] == pytest.approx(formulas.rouge_n(p, ref, 1))
            assert r["rouge_2"] == pytest.approx(formulas.rouge_n(p, ref, 2))
            assert r["rouge_l"] == pytest.approx(formulas.rouge_l(p, ref))
    means = evaluate.text_metrics(df).first()
    assert means["rouge_l"] == pytest.approx(sum(formulas.rouge_l(*row) for row in rows) / len(rows))


def test_no_pairs(spark):
    assert tuple(evaluate.text_metrics(pairs_of(spark, ("a", "b")).where("false")).first()) == (0.0,) * 4


def test_alignment(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "pair_id int, prediction string")
    right = spark.createDataFrame([(2, "x"), (1, "y")], "pair_id int, reference string")
    assert sorted(map(tuple, evaluate.align_pairs(left, right).collect())) == [(1, "a", "y"), (2, "b", "x")]
    more = spark.createDataFrame([(2, "x"), (3, "y")], "pair_id int, reference string")
    assert sorted(map(tuple, evaluate.unaligned(left, more).collect())) == [(1, "prediction"), (3, "reference")]
    with pytest.raises(PySparkException, match="differ at"):
        evaluate.align_pairs(left, more).collect()


def test_accuracy(spark):
    schema = "generated_text string, expected string"
    df = spark.createDataFrame([("generated response", " Generated RESPONSE"), ("generated response", "blue")], schema)
    assert tuple(evaluate.task_accuracy(df).first()) == (0.5, 2)
    contained = spark.createDataFrame([("the answer is Blue.", "blue"), ("blu", "BLUE"), ("", "anything")], schema)
    assert evaluate.task_accuracy(contained).first()["accuracy"] == 1.0
    assert evaluate.task_accuracy(contained, strict=True).first()["accuracy"] == 0.0
    assert evaluate.task_accuracy(contained.where("false")).first()["accuracy"] == 0.0


def test_perplexity(spark):
    schema = "run string, loss double, num_tokens bigint"
    df = spark.createDataFrame([("a", 2.0, 3), ("a", 2.0, 5), ("b", 1.0, 1), ("b", 4.0, 2), ("c", 100.0, 1), ("d", 1.0, 0)], schema)
    got = {r["run"]: r["perplexity"] for r in evaluate.perplexity(df).collect()}
    assert got["a"] == pytest.approx(math.exp(2)) and got["b"] == pytest.approx(math.exp(3))
    assert got["c"] == got["d"] == math.inf
    assert evaluate.perplexity(df.where("false"), ()).first()["perplexity"] == math.inf


def test_rows_without_values_do_not_count(spark):
    from loomset.operators.evaluate import perplexity, task_accuracy

    answers = spark.createDataFrame([("a", "a"), ("b", None), ("c", "x")], "generated_text string, expected string")
    assert [tuple(r) for r in task_accuracy(answers).select(*["n"], "accuracy").collect()] == [(3, 1 / 3)]
    scored = spark.createDataFrame([("r", 2.0, 2), ("r", None, 2)], "run string, loss double, num_tokens long")
    row = perplexity(scored).first()
    assert abs(row["perplexity"] - 7.38905609893065) < 1e-9 and row["total_tokens"] == 2
