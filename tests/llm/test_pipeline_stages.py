"""Every stage of the pipeline on its own input against a plain-Python version: kept ids and texts."""

import hashlib
import math
import re
from itertools import combinations

import pytest

import corpus_pipeline
from loomset.llm.quality import quality_scores
from loomset.llm.queries import MAX_EPOCHS, SEED, SHARE, WEIGHTS

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = r"[^\x20\x09-\x0D]+"
PERSONAL = [
    "mail a@b.cc or 10.0.0.1, not 256.1.1.1", "card 4111 1111 1111 1111, not 4111 1111 1111 1112", "call +44 20 7946 0958",
    "account DE89370400440532013000 The rest", "DE88370400440532013000", "my ssn is 123-45-6789", "order 123-45-6789", "x@y.zz 1.2.3.4@b.cc",
]
REDACTED = [
    "mail [EMAIL] or [IP], not 256.1.1.1", "card [CARD], not 4111 1111 1111 1112", "call [PHONE]",
    "account [IBAN] The rest", "DE88370400440532013000", "my ssn is [SSN]", "order 123-45-6789", "[EMAIL] [EMAIL]",
]


@pytest.fixture(scope="module")
def docs(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").limit(3).collect()]
    first = given.where("length(text) > 200").orderBy("doc_id").first()["text"]
    words = re.findall(SPACED, max(items, key=len))
    cuts = [f"zq {' '.join(words[2 : 2 + n])} zq" for n in (9, 10, 13)]
    texts = [None, "", "a b", "A  b", first + " more", items[0], f"before {items[1].upper()} after", items[2][:-12], *cuts, *PERSONAL]
    odd = [(10**9 + i, t, "en", f"src{i % 2}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return given.union(spark.createDataFrame(odd, given.schema)).cache()


def run(spark, docs, name):
    return [r.asDict() for r in STAGES[name](spark, docs, SF).collect()]


def same_rows(got, expected):
    """``got`` holds the rows of ``expected`` by id, every column as there, and no others."""
    assert sorted(r["doc_id"] for r in got) == sorted(expected)
    assert all(r == expected[r["doc_id"]] for r in got)
    assert expected


def rows_of(docs):
    return {r["doc_id"]: r.asDict() for r in docs.collect()}


def test_quality_drops_exactly_the_low_scores(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    assert {r[0] for r in labels.select("quality").distinct().collect()} >= {0, 1}
    scores = {r["doc_id"]: r["score"] for r in quality_scores(docs, labels).select("doc_id", "score").collect()}
    rows = rows_of(docs)
    expected = {i: r for i, r in rows.items() if scores[i] >= 0.5}
    got = [r.asDict() for r in STAGES["quality"](spark, docs, "/root/testdata/sf0.01").collect()]
    same_rows(got, expected)
    bad = {r["doc_id"] for r in labels.where("quality = 0").collect()} & set(rows)
    assert len(bad - set(expected)) > 0.9 * len(bad) and len(expected) > 0.5 * len(rows)


def shingles(text):
    words = re.findall(SPACED, (text or "").translate(LOWER))
    if len(words) < 5:
        return {" ".join(words)} if words else set()
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)}


def test_near_duplicates_keeps_the_smallest_id_of_each_group(spark, docs):
    rows = rows_of(docs)
    sets, group = {i: shingles(r["text"]) for i, r in rows.items()}, {i: i for i in rows}
    for a, b in combinations(sorted(rows), 2):
        small, large = sorted((len(sets[a]), len(sets[b])))
        if 100 * small >= 75 * large > 0 and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((group[a], group[b]))
            group = {i: x if g == y else g for i, g in group.items()}
    expected = {i: r for i, r in rows.items() if group[i] == i}
    assert len(expected) < len(rows)
    same_rows(run(spark, docs, "near_duplicates"), expected)


def test_benchmark_drops_documents_with_a_window(spark, docs):
    words = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    windows = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    grams = {}
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r["text"])
        if w:
            grams.setdefault(min(len(w), 10), set()).update(windows(w, min(len(w), 10)))
    rows = rows_of(docs)
    expected = {i: r for i, r in rows.items() if not any(windows(words(r["text"]), n) & g for n, g in grams.items())}
    assert len(expected) < len(rows)
    same_rows(run(spark, docs, "benchmark"), expected)


def luhn(number):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(number))) % 10 == 0


def redacted(text):
    bare = lambda m: re.sub("[^0-9]", "", m[0])
    near = lambda m, words: re.search(words, (text[max(m.start() - 40, 0) : m.start()] + " " + text[m.end() : m.end() + 40]).lower(), re.A)
    rules = [
        ("EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("IP", r"[0-9]+(\.[0-9]+){3}", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
        ("CARD", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(bare(m)) <= 19 and luhn(bare(m))),
        ("PHONE", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(bare(m)) <= 15),
        ("SSN", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", lambda m: near(m, r"\b(ssn|social|security|tax)\b")),
    ]
    spans = sorted((m.start(), rank, m.end(), kind) for rank, (kind, rule, holds) in enumerate(rules) for m in re.finditer(rule, text) if holds(m))
    out, at, merged = "", 0, []
    for start, _, end, kind in spans:
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end, kind])
    for start, end, kind in merged:
        out, at = out + text[at:start] + f"[{kind}]", end
    return out + text[at:]


def test_personal_data_replaces_exactly_the_spans(spark, docs):
    known, rows, expected = dict(zip(PERSONAL, REDACTED, strict=True)), rows_of(docs), {}
    for i, r in rows.items():
        text = r["text"]
        new = known[text] if text in known else text and redacted(text)
        expected[i] = r if new == text else {**r, "text": new, "n_chars": len(new)}
    assert sum(expected[i] != rows[i] for i in rows if rows[i]["text"] not in known) > 0
    same_rows(run(spark, docs, "personal_data"), expected)


def shared(children, budget):
    """(key, able, weight) to tokens by key: whoever can give less than the level gives all, the rest share by weight."""
    given, weights = {}, sum(w for _, _, w in children)
    ordered = sorted(children, key=lambda c: (c[1] / c[2], c[0]))
    for n, (key, able, weight) in enumerate(ordered):
        level = budget / weights
        if level < able / weight:
            return given | {k: min(a, math.floor(level * w)) for k, a, w in ordered[n:]}
        given[key], budget, weights = able, budget - able, weights - weight
    return given


def test_mixture_takes_the_budgets(spark, docs):
    rows, leaves = rows_of(docs), {}
    for i, r in rows.items():
        number = re.search("[0-9]{1,9}", r["source"] or "")
        n = len(re.findall(SPACED, r["text"] or ""))
        if n:
            leaves.setdefault((f"d{int(number[0]) % 3}" if number else "other", r["lang"], r["source"]), {})[i] = n
    given = {(): math.floor(SHARE * sum(sum(x.values()) for x in leaves.values()))}
    for depth, level in enumerate(("domain", "lang", "source")):
        able = {}
        for leaf, x in leaves.items():
            able[leaf[: depth + 1]] = able.get(leaf[: depth + 1], 0) + MAX_EPOCHS * sum(x.values())
        given = {k: v for up, budget in given.items() for k, v in shared([(k, a, WEIGHTS[level].get(k[-1], 1)) for k, a in able.items() if k[:-1] == up], budget).items()}
    expected = {}
    for leaf, x in leaves.items():
        whole, left = divmod(given[leaf], sum(x.values()))
        fits = True
        for i in sorted(x, key=lambda i: hashlib.md5(f"{SEED}:{whole}:{i}".encode()).hexdigest()):
            left -= x[i]
            fits = fits and left >= 0
            if whole + fits:
                expected[i] = {**rows[i], "domain": leaf[0], "n_tokens": x[i], "epochs": whole + fits}
    assert len(expected) < len(rows)
    same_rows(run(spark, docs, "mixture"), expected)
