"""Near-duplicates, repeated substrings, decontamination and fingerprints against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomset.llm.decontaminate import contamination_digest, cut_words, decontaminate, find_hits
from loomset.llm.fingerprints import block_masks, fingerprint_digest, within_radius
from loomset.llm.near_dedup import BANDS, BINS, Shingler, keep_first, near_duplicates, sketch
from loomset.llm.suffix_dedup import dedup_digest, remove_repeats

WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "pe", "ro") for b in ("x", "ta", "ven", "s", "rel")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def corpus(seed=5):
    """Copies, near copies, a shared passage, short, empty, null, periodic and long texts."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(1, 120)) for _ in range(40)]
    base, passage = prose(rng, 150), prose(rng, 60)
    for _ in range(25):
        words = base.split()
        for _ in range(rng.randrange(1, 6)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        texts.append(" ".join(words))
    texts += [prose(rng, 30) + " " + passage + " " + prose(rng, 30) for _ in range(15)]
    texts += [base] * 5 + [None, None, "", "   ", "one", "One", "one two", "a" * 3000, "ab " * 400, "ü" * 300, prose(rng, 5000)]
    return dict(enumerate(texts))


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_duplicates_equal_brute_force(spark):
    texts = corpus()
    sets = {i: shingles(t) for i, t in texts.items()}
    group = {i: i for i in texts}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in texts:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                group[b] = a
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(df).collect()}
    assert got == {i: (len(sets[i]), root(i), root(i) == i) for i in texts}


def test_near_duplicates_of_odd_rows(spark):
    rows = [(None, "a b c d e f", "x"), (None, "a b c d e f", "y"), (3, "a b c d e f", "z"), (3, "a b c d e f", "z"), (9, "a b c d e f", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, None, True)] * 2 + [(3, 3, True)] * 2 + [(9, 3, False)], key=str)
    kept = keep_first(df)
    assert kept.columns == df.columns and kept.count() == 4
    assert near_duplicates(df.limit(0)).count() == 0 and keep_first(df.limit(0)).count() == 0


def test_sketch_fills_every_bin_and_estimates_similarity():
    rng = np.random.default_rng(0)
    for n in (1, 3, 50, 2000):
        assert len(sketch(rng.integers(0, 2**63, n).astype(np.uint64))) == BINS
    a = np.unique(rng.integers(0, 2**63, 700).astype(np.uint64))
    b = np.concatenate([a[:600], rng.integers(0, 2**63, 100).astype(np.uint64)])
    true = 600 / (len(a) + 100)
    assert abs((sketch(a) == sketch(b)).mean() - true) < 0.12
    assert BINS % BANDS == 0 and len(Shingler()("x " * 4)) == 1


def plain_repeats(texts, length=100):
    seen, out = {}, {}
    for i in sorted(texts):
        data = (texts[i] or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if data[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.setdefault(data[p : p + length], i)
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        runs = sum(1 for p in range(len(data)) if gone[p] and not (p and gone[p - 1]))
        out[i] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_repeated_substrings_equal_brute_force(spark):
    texts = corpus(6)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    expected = plain_repeats(texts)
    for most in (1, 16_384):  # crowded anchors, and interval expansion
        assert {r[0]: tuple(r)[1:] for r in dedup_digest(df, most_contexts=most).collect()} == expected


def test_repeated_substrings_of_odd_rows(spark):
    text = prose(random.Random(1), 60)
    df = spark.createDataFrame([(None, text, 1), (2, text, 1), (2, text, 1), (5, text, 1)], "doc_id long, text string, n_bytes int")
    got = sorted(((r["doc_id"], r["n_removed"]) for r in dedup_digest(df).collect()), key=str)
    assert got == sorted([(None, 0), (2, 0), (2, 0), (5, len(text))], key=str)
    assert {r["doc_id"]: r["text"] for r in remove_repeats(df).collect()}[5] == ""
    assert dedup_digest(df.limit(0)).count() == 0


@pytest.mark.parametrize("most", [32 << 20, -1])
def test_decontamination_equals_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr("loomset.llm.decontaminate.BROADCAST_BYTES", most)
    texts = corpus(7)
    items = {1: " ".join((texts[3] or "").split()[:25]), 2: "one", 3: None, 4: "", 5: texts[66], 6: "kax lota miven", 7: "kax lota miven"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    grams = {}
    for i, t in items.items():
        w = words(t)
        k = min(10, len(w))
        for p in range(len(w) - k + 1 if w else 0):
            grams.setdefault(tuple(w[p : p + k]), set()).add(i)
    expected = set()
    for i, t in texts.items():
        w, hit, found = words(t), set(), set()
        for k in {len(g) for g in grams}:
            for p in range(len(w) - k + 1):
                if g := grams.get(tuple(w[p : p + k])):
                    hit |= set(range(p, p + k))
                    found |= g
        ids = ",".join(sorted(map(str, found)))
        expected.add((i, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    assert set(map(tuple, contamination_digest(docs, bench).collect())) == expected
    clean = {r["doc_id"] for r in decontaminate(docs, bench).collect()}
    assert clean == {e[0] for e in expected if not e[5]}
    assert contamination_digest(docs, bench.limit(0)).where("contaminated").count() == 0
    assert contamination_digest(docs.limit(0), bench).count() == 0


def shuffled(spark):
    return spark._jsc.sc().statusStore().executorList(True).head().totalShuffleWrite()


def test_large_test_sets_move_no_texts(spark, monkeypatch):
    """Without the broadcast: the same hits, one long text and copies of a text included, and less shuffled than two inputs."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    long = docs.agg(F.lit(None).cast("long"), F.array_join(F.collect_list("text"), " "))
    docs = docs.union(long).union(docs.limit(1).join(spark.range(500).select(F.col("id").alias("n"))).select("doc_id", "text"))
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    hits = lambda: sorted(map(str, find_hits(docs, bench).collect()))
    expected = hits()
    monkeypatch.setattr("loomset.llm.decontaminate.BROADCAST_BYTES", -1)
    before = shuffled(spark)
    assert hits() == expected
    assert shuffled(spark) - before < 2 * size


@pytest.mark.parametrize("most", [32 << 20, -1])
def test_one_block_in_many_tests_and_documents(spark, monkeypatch, most):
    """A block shared by all tests and documents, not the windows around it: only whole windows hit."""
    monkeypatch.setattr("loomset.llm.decontaminate.BROADCAST_BYTES", most)
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("x "), F.lit("a b c d e "), F.expr("concat_ws(' ', 'd', id, id, id, id, id)")).alias("text"))
    bench = spark.range(100).select(F.col("id").alias("item_id"), F.concat(F.lit("a b c d e "), F.expr("concat_ws(' ', 'd', id, id, id, id, if(id < 3, string(id), 'z'))")).alias("text"))
    rows = contamination_digest(docs, bench).where("contaminated").collect()
    # Windows of ten words end before the last word of an item, so the first window of each item is in its document.
    assert sorted(r["doc_id"] for r in rows) == list(range(100))
    assert {r["doc_id"] for r in rows if r["n_hit"] == 11} == {0, 1, 2} and {r["n_hit"] for r in rows} == {10, 11}


def test_decontamination_cuts_words_and_keeps_columns(spark):
    docs = spark.createDataFrame([(None, "Say: Quick brown FOX, then go", "h"), (1, None, None)], "doc_id long, text string, hits string")
    bench = spark.createDataFrame([(None, "quick brown fox")], "item_id long, text string")
    out = decontaminate(docs, bench, mode="spans")
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(None, "Say:   , then go", "h"), (1, None, None)], key=str)
    spans = F.array().cast("array<struct<start:int,end:int>>")
    assert docs.select(cut_words(F.col("text"), spans)).first()[0] == "Say: Quick brown FOX, then go"


def test_fingerprints_against_definitions(spark):
    texts = {i: t for i, t in corpus(8).items()}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    rows = {r["doc_id"]: r for r in fingerprint_digest(df).collect()}
    prints = {i: int(r["fingerprint"], 16) for i, r in rows.items()}
    order = sorted(texts)
    for n, i in enumerate(order):
        text, after = texts[i] or "", texts[order[(n + 1) % len(order)]] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = rows[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r["near_edited"] == 1 - (prints[i] ^ int(r["edited_fingerprint"], 16)).bit_count() / 64
        assert r["near_next"] == 1 - (prints[i] ^ prints[order[(n + 1) % len(order)]]).bit_count() / 64
        near = sum((prints[i] ^ p).bit_count() <= 3 for p in prints.values()) - 1
        assert r["n_near"] == (near if i % 20 == 0 else None)
        assert all(prints[i] == prints[j] for j in texts if (texts[j] or "") == text)


def test_block_tables_find_every_neighbour(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(60)]
    near = [b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(0, 6))) for b in base for _ in range(4)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in base + near], "print long")
    for radius, blocks in ((3, 6), (2, 4), (0, 1)):
        got = {(r["query"], r["print"]) for r in within_radius(df, df, radius, blocks).collect()}
        every = set(base + near)
        assert got == {(signed(a), signed(b)) for a in every for b in every if (a ^ b).bit_count() <= radius}
    assert len(block_masks(3, 6)) == 20
    odd = spark.createDataFrame([(None, "x y"), (None, None), (4, "x y"), (4, "z")], "doc_id long, text string")
    assert fingerprint_digest(odd).count() == 4 and fingerprint_digest(odd.limit(0)).count() == 0


def test_a_shared_passage_links_only_true_neighbours(spark):
    import numpy as np

    from loomset.llm.near_dedup import Shingler, near_duplicates

    rng = random.Random(9)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for i in range(40):
        own = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(2, 30))]
        texts.append(" ".join(passage + own) if i % 2 else " ".join(own[:1] + passage + own[1:]))
    sets = [Shingler()(t) for t in texts]
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if both * 100 >= 75 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    rows = near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(set(label)) > 1 and {r["doc_id"]: r["component_id"] for r in rows} == dict(enumerate(label))
