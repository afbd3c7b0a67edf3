"""Token ids and texts against the tokenizers library."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loomset.llm import bpe
from loomset.llm.bpe import Vocabulary, decode, encode, load_vocabulary, token_digest

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "\n\t", "Hello, World's it's WE'LL 123", "ΣΑΣ ΟΔΟΣ İstanbul ß ﬁ Å é ́x", "日本語 한국어 😀👩‍👩‍👧 ‍", "a\x00b\x7f\x85c d\x0be",
    "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|> <|endof text|> </w> a</w>", "''s 'S '' ''re!", "aaaaaaaaaaaaaaaaaaaaa", "loooooool " * 30, "x" * 5000,
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def vocabulary():
    return load_vocabulary(PATH)


def test_ids_and_texts_equal_the_library(spark, library):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("aabceinorst'sdl 01.,!é\nΣ") for _ in range(rng.randint(0, 80))) for _ in range(400)] + ["repeated row"] * 5
    df = spark.createDataFrame([(i, t, "z", 3) for i, t in enumerate(texts)], "doc_id long, text string, ids string, _whole int").repartition(7)
    coded = encode(df, PATH)
    assert coded.columns == [*df.columns, "ids_"]
    back = decode(coded, PATH, "ids_", "_list")
    for r in back.collect():
        want = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids_"] == want and r["ids"] == "z" and r["text"] == texts[r["doc_id"]]
        assert r["_list"] == library.decode(want, skip_special_tokens=False)


def test_whole_documents(spark, library):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
    for r in token_digest(df, PATH).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert token_digest(df.limit(0), PATH).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=6))
def test_any_text(library, vocabulary, texts):
    encoder = bpe._Encoder(vocabulary)
    got = encoder(pa.array(texts, pa.string())).to_pylist()
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_pairs_fit_exactly_where_merging_keeps_the_border(vocabulary):
    rng = random.Random(3)
    inner = [i for s, i in vocabulary.proposed.items() if not s.endswith("</w>") and s.isascii()]
    last = [i for s, i in vocabulary.proposed.items() if s.endswith("</w>") and s.isascii()]
    pairs = [(rng.choice(inner), rng.choice(last)) for _ in range(4000)]
    a, b = (np.array(x, np.int64) for x in zip(*pairs))
    merged = [vocabulary.merge((vocabulary.texts[x] + vocabulary.texts[y]).removesuffix("</w>")) == [x, y] for x, y in pairs]
    assert vocabulary.compatible(a, b).tolist() == merged and 0 < sum(merged) < len(pairs)


def test_small_rules_with_unreachable_entries():
    """Entry ``abc`` cannot arise: b and c always join first. Repeated letters join from the left."""
    vocab = {s: i for i, s in enumerate(["a", "b", "c", "bc", "ab", "abc", "aa", "aaa"])}
    merges = [["b", "c"], ["a", "b"], ["ab", "c"], ["a", "a"], ["aa", "a"]]
    small = Vocabulary({"model": {"type": "BPE", "vocab": vocab, "merges": merges}})
    assert "abc" not in small.proposed and "aaa" in small.proposed
    library = Tokenizer.from_str(json.dumps({"version": "1.0", "added_tokens": [], "model": {"type": "BPE", "vocab": vocab, "merges": merges}}))
    words = [w for n in range(1, 8) for w in {"".join(random.Random(n * 100 + k).choice("abca") for _ in range(n)) for k in range(60)}]
    assert small.encode_words(words) == [library.encode(w).ids for w in words]


def test_pieces_are_forgotten_without_harm(library, vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "_KNOWN", 2)
    encoder = bpe._Encoder(vocabulary)
    for text in ("one two three four", "four five six", "one one nine"):
        assert encoder(pa.array([text])).to_pylist() == [library.encode(text, add_special_tokens=False).ids]


def test_lists_that_hold_odd_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [None, -5, 10**8, 320])], "doc_id long, ids array<long>")
    got = {r["doc_id"]: r["decoded"] for r in decode(df.withColumn("ids", df["ids"].cast("array<int>")), PATH).collect()}
    assert got == {1: "", 2: "", 3: load_vocabulary(PATH).texts[320]}


def test_files_that_need_other_rules(tmp_path, monkeypatch):
    with pytest.raises(ValueError):
        Vocabulary({"model": {"type": "WordPiece", "vocab": {}}})
    with pytest.raises(ValueError):  # words that begin with a blank
        bpe._Encoder(load_vocabulary(public_tokenizers.path("byte_bpe_50k.json")))
    with pytest.raises(ValueError):
        Vocabulary({"model": {"type": "BPE", "vocab": {}, "merges": [], "unk_token": "?"}})
    monkeypatch.setattr(bpe, "MAX_FILE", 10)
    with pytest.raises(ValueError):
        load_vocabulary(PATH)
