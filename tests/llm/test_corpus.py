"""Token rollups, quality scores, mixing, archives and the pipeline on small tables."""

import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomset.llm.mixing import leaf_budgets, mix
from loomset.llm.quality import fit, keep_good, probabilities, quality_scores, training_rows
from loomset.llm.token_counts import commit, count_tokens, deletes, inserts, revisions, rollup_history, totals, without_repeated_lines
from loomset.llm.warc import ARC_FIELDS, archive_round_trip, iso_date, parse_arc
from loomset.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_rollups_commit_once_and_add_up(spark):
    rows = [(1, "s", "en", "k1", "v", 5, 4), (2, "s", "en", "k2", "v", 7, 7), (3, None, None, "k3", "v", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, text_key string, version string, n long, revised long")
    ledger = scratch_path(spark, "ledger")
    assert commit(inserts(df), ledger, "a") and not commit(inserts(df), ledger, "a")
    assert commit(revisions(df.where("doc_id <> 2")), ledger, "c") and commit(deletes(df.where("doc_id = 2")), ledger, "b")
    got = {(r["source"], r["lang"]): (r["n_docs"], r["n_tokens"]) for r in totals(spark, ledger, ["a", "b", "c", "missing"]).collect()}
    assert got == {("s", "en"): (1, 4), (None, None): (1, 1)}
    assert totals(spark, ledger, []).count() == 0


def test_rollup_history_equals_a_plain_count(spark):
    texts = {1: "one two\none two\nthree", 2: "one two\none two\nthree", 3: None, 4: "", 5: "é x"}
    df = spark.createDataFrame([(i, t, "en", "s", "extra") for i, t in texts.items()], "doc_id long, text string, lang string, source string, version string")
    counts = {(r["doc_id"], r["version"]): r["n"] for r in count_tokens(df).collect()}
    slim = {i: without_repeated_lines(t or "") for i, t in texts.items()}
    after = {(r["doc_id"], r["version"]): r["n"] for r in count_tokens(df.withColumn("text", F.regexp_replace("text", "^one two\n", ""))).collect()}
    stays = [1, 3, 5]  # 2 copies 1, and 4 copies the null text of 3
    for r in rollup_history(df).collect():
        assert r["n_docs"] == 3 and r["n_tokens"] == sum(after[i, r["version"]] for i in stays)
        assert r["deleted"] == -counts[2, r["version"]]
    assert slim[1] == "one two\nthree" and rollup_history(df.limit(0)).count() == 0


def test_quality_learns_and_keeps_held_out_labels_apart(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good = np.array([r["score"] for r in rows if r["quality"] == 1])
    bad = np.array([r["score"] for r in rows if r["quality"] == 0])
    assert (good[:, None] > bad).mean() > 0.9 and np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.9
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r[0]: r[2] for r in quality_scores(docs, labels).collect()}
    assert a == {r[0]: r[2] for r in quality_scores(docs, flipped).collect()}


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(None, None, "a"), (1, "", "b"), (1, "", "b"), (2, "x " * 20_000, None)], "doc_id long, text string, score string")
    none = spark.createDataFrame([(1, None), (None, 1), (2, 5)], "doc_id long, quality int")
    assert {r["score"] for r in quality_scores(docs, none).collect()} == {0.5}
    kept = keep_good(docs, none)
    assert kept.columns == docs.columns and kept.count() == 4
    assert quality_scores(docs.limit(0), none).count() == 0
    x = np.random.default_rng(0).normal(size=(400, 5))
    net = fit(x, (x[:, 0] > 0).astype(float))
    assert ((probabilities(x, net) > 0.5) == (x[:, 0] > 0)).mean() > 0.95


def test_budget_goes_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame(
        [("a", "en", "s1", 10), ("a", "en", "s2", 1000), ("a", "de", "s1", 1000), ("b", "en", "s1", 50)],
        "domain string, lang string, source string, supply long",
    )
    got = {tuple(r)[:3]: r["given"] for r in leaf_budgets(leaves, 400, {"domain": {"a": 1, "b": 1}}, 1).collect()}
    # b can give 50 of its 200, so a gets 350: 175 each language; s1 can give 10, its sibling takes 165.
    assert got == {("a", "en", "s1"): 10, ("a", "en", "s2"): 165, ("a", "de", "s1"): 175, ("b", "en", "s1"): 50}


def test_mix_takes_epochs_and_a_prefix(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(1, 9), "en", rng.choice(["s1", "s1", "s2"]), "x") for i in range(300)] + [(None, None, None, None, None), (None, "w", None, None, None), (1000, "", "en", "s1", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, epochs string")
    out = mix(docs, F.lit("d"), {}, share=0.9, max_epochs=2)
    assert out.columns == [*docs.columns, "domain", "n_tokens", "epochs_"]
    got = out.collect()
    total = sum(len((t or "").split()) for _, t, *_ in rows)
    used = sum(r["n_tokens"] * r["epochs_"] for r in got)
    assert 0.85 * total < used <= 0.9 * total and all(r["n_tokens"] > 0 for r in got)
    assert mix(docs.limit(0), F.lit("d"), {}).count() == 0
    with pytest.raises(ValueError):
        mix(docs, F.lit("d"), {"lang": {"en": 0}})


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("min_bytes", [0, 5])
def test_archives_round_trip(spark, version, min_bytes):
    rows = [(7, "http://a b\nc", "same text"), (3, "u", "same text"), (3, "u", "same text"), (None, None, "same text"), (9, "x", None), (10, "x", ""), (11, "é", "WARC/1.1\r\n\r\n\r\n\r\n\n"), (12, "l", "é" * 50_000)]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, digest string")
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    expected = []
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= min_bytes and i != first[html or ""]
        expected.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first[html or ""] if revisit else None))
    got = [tuple(r)[:5] for r in archive_round_trip(pages, version, min_bytes).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert archive_round_trip(pages.limit(0), version).count() == 0


def test_arc_parser_rejects_and_flags():
    block = "1 0 x\n" + " ".join(ARC_FIELDS[1]) + "\n"
    head = f"filedesc://f 0.0.0.0 20200101000000 text/plain {len(block)}\n{block}\n"
    (record,) = parse_arc((head + "http://a 1.2.3.4 20200102030405 text/html 9\nabc").encode())
    assert record[1:] == (b"abc", True) and iso_date(record[0]["Archive-date"]) == "2020-01-02T03:04:05Z"
    for broken in (head + "http://a 1.2.3.4 20200102030405 9\nabc", head + "no length\n", head.replace("1 0 x", "9 0 x")):
        with pytest.raises(ValueError):
            list(parse_arc(broken.encode()))


def test_pipeline_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "benchmark", "personal_data", "mixture"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.limit(3).union(spark.createDataFrame([(None, None, None, None, None), (10**9, "", "en", "s", 0)], docs.schema))
    for name, stage in corpus_pipeline.STAGES:
        for table in (odd, docs.limit(0)):
            out = stage(spark, table, SF)
            assert out.columns[: len(docs.columns)] == docs.columns, name
            assert out.count() <= table.count()
    out = corpus_pipeline.run(spark, SF)
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert 0 < len(ids) == len(set(ids)) < docs.count()


def test_training_rows_are_bounded_in_the_tasks(spark):
    """200 partitions: every task sends its share of the chosen rows, not a full sample of its own."""
    df = spark.range(0, 20_000, 1, 200).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    hashes = sorted(hashlib.sha256(str(i).encode()).hexdigest() for i in range(20_000))
    for most in (0, 1, 7, 500, 4_096, 19_999, 20_000, 50_000):
        taken = training_rows(df, most)
        assert sorted(r["h"] for r in taken.collect()) == hashes[: min(most, 20_000)]
        assert taken.groupBy(F.spark_partition_id()).count().count() <= min(most, 200)
    assert training_rows(df.limit(0), 10).count() == 0


def test_one_id_with_many_labels_leaves_room_for_the_rest(spark):
    docs = spark.createDataFrame([(i, ("good words here " if i % 2 else "zz qq xx ") * 5) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(0, 0)] * 500, "doc_id long, quality int")
    scores = {r["doc_id"]: r["score"] for r in quality_scores(docs, labels).collect()}
    assert min(scores[i] for i in range(1, 60, 2)) > max(scores[i] for i in range(0, 60, 2))
