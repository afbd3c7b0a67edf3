import hashlib
import random

import pytest
from pyspark.sql import functions as F

import loomset.functions.ordering as ordering
import loomset.operators.split as split_module
from loomset.functions.ordering import rank_by_hash, row_positions
from loomset.operators.evaluate import batch_ids
from loomset.operators.split import random_split, seeded_sample


def ids(spark, n, partitions=8):
    return spark.range(n).withColumnRenamed("id", "row_id").repartition(partitions)


def hash_order(n, seed):
    return sorted(range(n), key=lambda i: (hashlib.md5(f"{i}:{seed}".encode()).hexdigest(), i))


def by_split(df):
    out = {"train": set(), "validation": set(), "test": set()}
    for r in df.collect():
        out[r["split"]].add(r["row_id"])
    return out


def test_exact_sizes_and_repeatability(spark):
    got = by_split(random_split(ids(spark, 1000)))
    assert {k: len(v) for k, v in got.items()} == {"train": 900, "validation": 50, "test": 50}
    assert set().union(*got.values()) == set(range(1000))
    assert by_split(random_split(ids(spark, 1000, 1))) == got
    assert by_split(random_split(ids(spark, 1000), seed=1)) != got
    order = hash_order(1000, 42)
    assert got["test"] == set(order[:50]) and got["validation"] == set(order[50:100])


def test_refined_cut_points(spark, monkeypatch):
    """Buckets above the row limit are searched by further prefixes, with the same result."""
    want = by_split(random_split(ids(spark, 5000), 0.8, 0.1, 0.1))
    monkeypatch.setattr(ordering, "SMALL_BUCKET", 1)
    monkeypatch.setattr(ordering, "PREFIX", 1)
    assert by_split(random_split(ids(spark, 5000), 0.8, 0.1, 0.1)) == want


def test_special_ratios(spark):
    assert len(by_split(random_split(ids(spark, 10), 1.0, 0.0, 0.0))["train"]) == 10
    two = by_split(random_split(ids(spark, 11), 0.9, 0.1, 0.0))
    assert (len(two["train"]), len(two["validation"]), len(two["test"])) == (9, 2, 0)
    other = by_split(random_split(ids(spark, 11), 0.9, 0.0, 0.1))
    assert (len(other["train"]), len(other["validation"]), len(other["test"])) == (9, 0, 2)


@pytest.mark.parametrize(
    "n, ratios, message",
    [
        (10, (0.5, 0.2, 0.2), "instead of 1"),
        (10, (1.2, -0.1, -0.1), "below 0"),
        (10, (0.0, 0.5, 0.5), "above 0"),
        (2, (0.9, 0.05, 0.05), "3 rows or more"),
        (3, (0.9, 0.05, 0.05), "would be empty"),
    ],
)
def test_guards(spark, n, ratios, message):
    with pytest.raises(ValueError, match=message):
        random_split(ids(spark, n), *ratios)


def stratified(rows, train, val, seed=42):
    groups, out = {}, {}
    for i, label in rows:
        groups.setdefault(str(label), []).append(i)
    for members in groups.values():
        members.sort(key=lambda i: (hashlib.md5(f"{i}:{seed}".encode()).hexdigest(), i))
        n_train, n_val = max(1, round(len(members) * train)), round(len(members) * val)
        for place, i in enumerate(members):
            out[i] = "train" if place < n_train else "validation" if place < n_train + n_val else "test"
    return out


def test_stratified_with_a_hot_label(spark):
    rows = [(i, "hot" if i % 3 == 0 else None if i % 50 == 1 else f"label{i % 40}") for i in range(3000)] + [(3000, "single")]
    df = spark.createDataFrame(rows, "row_id bigint, label string").repartition(8)
    got = {r["row_id"]: r["split"] for r in random_split(df, 0.9, 0.05, 0.05, stratify="label").collect()}
    assert got == stratified(rows, 0.9, 0.05)
    assert got[3000] == "train"


def test_stratified_small_labels(spark):
    rows = [(i, f"l{i // 10}") for i in range(50)]
    df = spark.createDataFrame(rows, "row_id bigint, label string")
    got = random_split(df, 0.9, 0.05, 0.05, stratify="label").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"train": 45, "test": 5}
    # An unknown column falls back to the plain split.
    assert random_split(df, stratify="absent").count() == 50


def test_sample(spark):
    order = hash_order(500, 42)
    got = {r["sample_id"]: r["row_id"] for r in seeded_sample(ids(spark, 500), 20).collect()}
    assert got == {i + 1: row for i, row in enumerate(order[:20])}
    assert seeded_sample(ids(spark, 5), 20).count() == 5


def test_large_sample_takes_the_other_way(spark, monkeypatch):
    want = {r["sample_id"]: r["row_id"] for r in seeded_sample(ids(spark, 2000), 700).collect()}
    monkeypatch.setattr(split_module, "TOP_N_SAMPLE", 10)
    got = {r["sample_id"]: r["row_id"] for r in seeded_sample(ids(spark, 2000), 700).collect()}
    assert got == want
    everything = seeded_sample(ids(spark, 300), 700)
    assert sorted(r["sample_id"] for r in everything.collect()) == list(range(1, 301))


def test_ranks_and_positions(spark):
    ranks = {r["row_id"]: r["rank"] for r in rank_by_hash(ids(spark, 400), "row_id", 9, "rank").collect()}
    assert [ranks[i] for i in hash_order(400, 9)] == list(range(1, 401))
    clumped = [7 + i for i in range(500)] + [2**40 + i for i in range(300)] + [2**60]
    df = spark.createDataFrame([(v,) for v in clumped], "row_id bigint").repartition(8)
    got = row_positions(df, "row_id", "at", rows_per_bucket=60).orderBy("row_id").collect()
    assert [r["at"] for r in got] == list(range(801))
    batches = batch_ids(df, 4).groupBy("batch_id").agg(F.count("*").alias("n")).collect()
    assert sorted(r["n"] for r in batches) == [1] + [4] * 200


def test_long_rows_are_numbered_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(ordering, "BUCKET_BYTES", 2_000, raising=False)
    df = ids(spark, 200).withColumn("text", F.repeat(F.lit("x"), 100))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = row_positions(df, "row_id", "at").withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert all(r["at"] == r["row_id"] for r in got) and len(got) == 200
    assert len({r["task"] for r in got}) > 2


@pytest.mark.parametrize("small", [10, 10_000])
def test_ids_that_repeat(spark, tmp_path, small, monkeypatch):
    """A cut falls inside equal ids, and inside equal rows, without reading them."""
    monkeypatch.setattr(ordering, "SMALL_BUCKET", small)
    equal = spark.range(0, 30_000, 1, 8).select(F.lit(7).alias("row_id"), F.lit("same").alias("text"))
    told = spark.range(0, 30_000, 1, 8).select(F.lit(7).alias("row_id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    mixed = told.limit(2_000).unionByName(spark.range(1_000).select(F.col("id").cast("int").alias("row_id"), F.lit("x").alias("text")))
    for name, rows, n in (("equal", equal, 30_000), ("told", told, 30_000), ("mixed", mixed, 3_000)):
        rows.write.parquet(str(tmp_path / name))
        df = spark.read.parquet(str(tmp_path / name))
        sizes = {r["split"]: r["count"] for r in random_split(df).groupBy("split").count().collect()}
        assert sizes == {"train": n * 9 // 10, "validation": n // 20, "test": n // 20}
        monkeypatch.setattr(split_module, "TOP_N_SAMPLE", 10)
        places = [r["sample_id"] for r in seeded_sample(df, 500).collect()]
        assert sorted(places) == list(range(1, 501))
    assert "Exchange" not in random_split(df)._jdf.queryExecution().executedPlan().toString()


def test_numbers_are_selected_by_rank(spark):
    rng = random.Random(3)
    values = [rng.choice([0, -1, 5, 2**63 - 1, -(2**63), rng.randrange(-(2**63), 2**63)]) for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(4)
    order = sorted(values)
    for rank in (1, 57, 200, 399, 400):
        value, inner = ordering._select_number(df, "v", rank)
        assert value == order[rank - 1] and inner == rank - order.index(value)
