"""Cuts at line ends against a loop over characters, and exact restoration."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from loomset.llm.fill_middle import ADDED, check_marks, fill_middle, fill_middle_digest, restored


def lines_of(text):
    out, line = [], ""
    for c in text:
        line += c
        if c == "\n":
            out.append(line)
            line = ""
    return [*out, line] if line else out


def plain(doc_id, text, rate=100, spm=50, seed=7):
    units = lines_of(text or "")
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not n or h3 % 100 >= rate or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text or ""
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    x, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return n, "spm", len(x), len(m), "<S>" + s + "<P>" + x + "<M>" + m
    return n, "psm", len(x), len(m), "<P>" + x + "<S>" + s + "<M>" + m


TEXTS = [
    None, "", "\n", "\n\n\n", "one line", "one line\n", "a\nb\nc", "a\r\nb\r\n", "é\n日本語\n😀 x\n\n", "a <P> b\nc\n", "<S>", "x<M>\n",
    "<\nP>\n<S\n>\n", "<<\n<S\nM>\n", "P>\nS>\nM>\n", "\x00\n\x0b\x0c\x85 z\n", "same\nsame\n",
]


def test_cuts_equal_a_plain_loop(spark):
    rng = random.Random(2)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(5, "a\nb\nc"), (5, "a\nb\nc"), (None, "k\nl\nm\n")]
    rows += [(100 + i, "".join(rng.choice("ab<PSM>é\n\n") for _ in range(rng.randint(0, 60)))) for i in range(300)]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "doc_id long, text string, output string, n int")
    made = fill_middle(df, rate=80, spm=30).withColumn("back", restored(F.col("output_"), F.col("form")))
    assert made.columns == [*df.columns, "n_", "form", "prefix_chars", "middle_chars", "output_", "back"]
    got = sorted(((r["doc_id"], r["text"], r["output"], r["n"], *r[4:]) for r in made.collect()), key=repr)
    want = sorted(((i, t, "t", 1, *plain(i, t, 80, 30), t or "") for i, t in rows), key=repr)
    assert got == want
    assert {r[5] for r in got} == {"plain", "psm", "spm"}


def test_digest_of_long_texts_and_empty_tables(spark):
    many = "line\n" * 300_000 + "é"
    wide = "w" * 3_000_000
    df = spark.createDataFrame([(i, t) for i in range(4) for t in (many, wide)], "doc_id long, text string")
    for r in fill_middle_digest(df).collect():
        texts = [plain(r["doc_id"], t) for t in (many, wide)]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) in [t[:4] for t in texts]
        assert r["output_sha256"] in [hashlib.sha256(t[4].encode()).hexdigest() for t in texts]
        assert r["restored_sha256"] == hashlib.sha256((many if r["n"] > 1 else wide).encode()).hexdigest()
    empty = fill_middle_digest(df.limit(0))
    assert empty.count() == 0
    assert fill_middle(df.limit(0)).columns == ["doc_id", "text", *ADDED]


def test_marks_have_to_be_told_apart(spark):
    check_marks(["<|p|>", "<|s|>", "<|m|>"])
    for bad in (["a", "b"], ["<P>", "<P>", "<M>"], ["", "b", "c"], ["ab", "bc", "d"], ["abcab", "x", "y"], ["<<P>>", "<P>", "m"]):
        with pytest.raises(ValueError):
            check_marks(bad)
    df = spark.createDataFrame([(i, "a.b\n(c\n") for i in range(20)], "doc_id long, text string")
    marks = ["[.P]", "[*S]", "[(M]"]
    made = fill_middle(df, marks=marks)
    assert made.where(restored(F.col("output"), F.col("form"), marks) != F.col("text")).count() == 0
