"""Benchmark decontamination: a hash set of normalised test n-grams against all training windows.

Words are maximal runs of lower-cased letters, digits and non-ASCII characters. Every ``n`` consecutive
words of an item form a window; an item with fewer words is one window of its own length.

A window of ``size`` words holds a whole block of ``(size + 1) // 2`` words wherever blocks of that length
are laid end to end, so a document is scanned block by block and a window is looked up by the first whole
block inside it: no window is missed, and a document costs one hash per block. A hash hit counts only
after all words of the window were compared.

The set of test blocks is broadcast if its counted size allows it. If not, fixed-size rows (digest of the
text, position, hash) find the blocks that some test holds; the documents then give only the windows
around those blocks, to be joined with the test windows word for word, and take their hits by the digest.
No text is shuffled for the lookups, and one block shared by many tests and documents multiplies nothing.

Documents and items may repeat or lack ids: rows are kept apart by position, items without an id still
mark words but are not listed. Null and empty texts have no words. An empty benchmark hits nothing.
Extra columns pass through, also when named like ours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.llm.common import BROADCAST_BYTES, ascii_lower, fresh, hint_small, packed, unpacked
from loomset.session import materialize

N = 10
_LOWER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]++"
_ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(_LOWER_WORD), F.lit(0))


def _block(size: int) -> int:
    return (size + 1) // 2


def _hash(tokens: Column, start: Column, size: int) -> Column:
    """Hash of ``size`` words from ``start`` (from 1). Words are fetched one by one: slice() would copy the array."""
    return F.xxhash64(*[F.get(tokens, start + k - 1) for k in range(size)])


def _starts(tokens: Column, size: int, step: int) -> Column:
    last = F.size(tokens) - size + 1
    return F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)), F.lit(step))).otherwise(F.array().cast("array<int>"))


def _blocks(tokens: Column, size: int) -> Column:
    """Hashes and positions of the blocks that windows of ``size`` words are looked up by."""
    b = _block(size)
    return F.transform(
        _starts(tokens, b, b), lambda i: F.struct(_hash(tokens, i, b).alias("hash"), i.alias("at"), F.lit(size).alias("size"))
    )


def test_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """(size, gram, items): the distinct windows of all items with the ids of the items that have them."""
    tokens = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(n))
    starts = F.sequence(F.lit(1), F.size("w") - size + 1)
    grams = tokens.select("item_id", size.alias("size"), F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("gram"))
    return grams.groupBy("size", "gram").agg(F.collect_set("item_id").alias("items"))


test_windows.__test__ = False


def _block_rows(grams: DataFrame, sizes: list[int]) -> DataFrame:
    """(size, gram, items, b): each block that can be the first in a window, with its hash and offset."""
    each = F.array().cast("array<struct<hash:bigint,off:int>>")
    for s in sizes:
        of = F.array(
            *[F.struct(_hash(F.col("gram"), F.lit(o + 1), _block(s)).alias("hash"), F.lit(o).alias("off")) for o in range(_block(s))]
        )
        each = F.when(F.col("size") == s, of).otherwise(each)
    return grams.select("size", "gram", "items", F.explode_outer(each).alias("b"))


def test_blocks(grams: DataFrame, sizes: list[int]) -> DataFrame:
    """(hash, size, tests): for each block that can be the first of a window, the windows and its offset in them."""
    return _block_rows(grams, sizes).groupBy(F.col("b.hash").alias("hash"), "size").agg(F.collect_list(F.struct(F.col("b.off").alias("off"), "gram", "items")).alias("tests"))


test_blocks.__test__ = False


def _merged(found: Column) -> Column:
    """Sorted (start, end) ranges as disjoint ones."""

    def join(acc: Column, s: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when((F.size(acc) > 0) & (s["start"] <= last["end"]), F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(grown))).otherwise(
            F.array_append(acc, s)
        )

    return F.aggregate(found, F.array().cast("array<struct<start:int,end:int>>"), join)


def _by_broadcast(docs: DataFrame, others: DataFrame, text: str, blocks: DataFrame, sizes: list[int]) -> tuple[DataFrame, str]:
    """A row per document: its columns in the named struct, ``n_words``, ``found`` and ``items``."""
    key, row, tokens, win = fresh(docs, "_key", "_row", "_words", "_win")
    work = docs.select(F.monotonically_increasing_id().alias(key), packed(others)[0].alias(row), words(F.col(f"`{text}`")).alias(tokens))
    mark = F.array(F.struct(F.lit(0).cast("long").alias("hash"), F.lit(0).alias("at"), F.lit(0).alias("size")))
    every = F.concat(mark, *[_blocks(F.col(tokens), s) for s in sizes])  # the mark keeps a row for every document
    # The windows are a column of their own before they are exploded: then explode and join share one generated stage
    # and the words of a document are not copied once per window. The outer form keeps the optimizer from inferring a
    # filter on the array's size, which it would push below and so extract the words again for every window.
    listed_windows = work.select(key, row, tokens, F.size(tokens).alias("n_words"), every.alias(win))
    exploded = listed_windows.select(key, row, tokens, "n_words", F.explode_outer(win).alias(win)).select(
        key, row, "n_words", tokens, F.col(f"{win}.hash").alias("hash"), F.col(f"{win}.at").alias("at"), F.col(f"{win}.size").alias("size")
    )
    joined = exploded.join(F.broadcast(blocks), ["hash", "size"], "left").where((F.col("at") == 0) | F.col("tests").isNotNull())

    def occurs(t: Column) -> Column:
        start = F.col("at") - t["off"]
        return F.when(start >= 1, F.slice(tokens, start, F.col("size")) == t["gram"]).otherwise(False)

    hits = joined.withColumn("tests", F.filter("tests", occurs))
    span = lambda t: F.struct((F.col("at") - t["off"] - 1).alias("start"), (F.col("at") - t["off"] - 1 + F.col("size")).alias("end"))
    grouped = hits.groupBy(key).agg(
        F.first(F.when(F.col("at") == 0, F.col(row)), ignorenulls=True).alias(row),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.transform("tests", span))))).alias("found"),
        F.array_sort(F.array_distinct(F.flatten(F.flatten(F.collect_set(F.transform("tests", lambda t: t["items"])))))).alias("items"),
    )
    return grouped, row


def _hits_by_text(docs: DataFrame, text: str, grams: DataFrame, sizes: list[int]) -> DataFrame:
    """(digest, found, items) of the texts that hold a test window; every join here is on narrow rows."""
    work = docs.select(_digest(text).alias("digest"), words(F.col(f"`{text}`")).alias("w"))
    blocks = work.select("digest", F.explode_outer(F.concat(*[_blocks(F.col("w"), s) for s in sizes])).alias("b"))
    held = _block_rows(grams, sizes).select(F.col("b.hash").alias("hash"), "size").distinct()
    near = blocks.select("digest", "b.hash", "b.at", "b.size").join(held, ["hash", "size"], "left_semi")
    near = materialize(near.groupBy("digest").agg(F.collect_set(F.struct("at", "size")).alias("places")), "test_blocks")
    near = hint_small(near, near.agg(F.sum(F.size("places") * 8 + 64)).first()[0] or 0, 1)

    def around(p: Column) -> Column:
        offsets = F.sequence(F.lit(0), F.greatest(F.floor((p["size"] + 1) / 2).cast("int") - 1, F.lit(0)))
        return F.transform(offsets, lambda o: F.struct((p["at"] - o).alias("start"), p["size"].alias("size")))

    windows = work.join(near, "digest").select("digest", "w", F.explode_outer(F.flatten(F.transform("places", around))).alias("p"))
    inside = (F.col("p.start") >= 1) & (F.col("p.start") + F.col("p.size") - 1 <= F.size("w"))
    windows = windows.where(inside).select("digest", "p.start", "p.size", F.slice("w", F.col("p.start"), F.col("p.size")).alias("gram"))
    start = F.col("start") - 1
    hits = windows.join(grams, ["size", "gram"]).groupBy("digest").agg(
        F.array_sort(F.collect_set(F.struct(start.alias("start"), (start + F.col("size")).alias("end")))).alias("found"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    return materialize(hits, "test_hits")


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256))


def _by_shuffle(docs: DataFrame, others: DataFrame, text: str, grams: DataFrame, sizes: list[int]) -> tuple[DataFrame, str]:
    """The same rows as ``_by_broadcast`` for a test set of any size."""
    row, digest = fresh(docs, "_row", "_digest")
    hits = _hits_by_text(docs, text, grams, sizes).withColumnRenamed("digest", digest)
    in_bytes = hits.agg(F.sum((F.size("found") + F.size("items")) * 8 + 64)).first()[0] or 0
    work = docs.select(packed(others)[0].alias(row), _digest(text).alias(digest), F.size(words(F.col(f"`{text}`"))).alias("n_words"))
    joined = work.join(hint_small(hits, in_bytes, 1), digest, "left")
    return joined.select(row, "n_words", *[F.coalesce(c, F.array().cast(hits.schema[c].dataType)).alias(c) for c in ("found", "items")]), row


def find_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", n: int = N, result: str = "hits") -> DataFrame:
    """``docs`` without ``text``, plus ``result``: a struct of ``n_words``, ``spans`` and ``items``.

    ``spans`` are disjoint (start, end) word ranges, from 0, end exclusive, sorted; ``items`` the sorted ids
    of items with an occurring window. Every document gives a row.
    """
    grams = test_windows(benchmark, n)
    counts = grams.groupBy("size").agg(F.count("*").alias("n"), F.sum(F.size("items")).alias("items")).collect()  # at most n rows
    sizes = sorted(r["size"] for r in counts)
    in_bytes = sum(_block(r["size"]) * (r["n"] * (r["size"] * 16 + 64) + r["items"] * 8) for r in counts)
    others = docs.drop(text) if len(docs.columns) > 1 else docs
    if in_bytes <= BROADCAST_BYTES or not sizes:
        found, row = _by_broadcast(docs, others, text, test_blocks(grams, sizes), sizes)
    else:
        found, row = _by_shuffle(docs, others, text, materialize(grams, "test_windows"), sizes)
    (name,) = fresh(others, result)
    out = F.struct(F.col("n_words").cast("long").alias("n_words"), _merged(F.col("found")).alias("spans"), F.col("items").alias("items"))
    return found.select(row, out.alias(name)).select(*unpacked(row, others.columns), name)


def covered(hits: Column) -> Column:
    """Number of words inside any hit."""
    return F.aggregate(hits["spans"], F.lit(0), lambda a, s: a + s["end"] - s["start"])


def cut_words(text: Column, spans: Column) -> Column:
    """``text`` without the words in ``spans``; separators stay, edges are trimmed of spaces."""
    found = F.regexp_extract_all(text, F.lit(_ANY_WORD), F.lit(0))
    gaps = F.split(text, _ANY_WORD, -1)
    kept = F.transform(found, lambda w, i: F.when(F.exists(spans, lambda s: (i >= s["start"]) & (i < s["end"])), F.lit("")).otherwise(w))
    return F.when(F.size(spans) > 0, F.trim(F.array_join(F.zip_with(gaps, kept, lambda g, w: F.concat(g, F.coalesce(w, F.lit("")))), ""))).otherwise(text)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", n: int = N, mode: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents (``mode="documents"``) or without the hit words (``"spans"``)."""
    if mode not in ("documents", "spans"):
        raise ValueError(f"mode is 'documents' or 'spans', not {mode!r}")
    copy, hits, row = fresh(docs, "_copy", "_hits", "_row")
    keep, names = packed(docs)
    narrow = docs.select(keep.alias(row), F.col(f"`{text}`").alias(copy))
    found = find_hits(narrow, benchmark, copy, n, hits)
    if mode == "documents":
        return found.where(F.size(f"{hits}.spans") == 0).select(*unpacked(row, names))
    out = found.select(*unpacked(row, names), hits)
    return out.withColumn(text, cut_words(F.col(f"`{text}`"), F.col(f"{hits}.spans"))).select(*[f"`{c}`" for c in names])


def contamination_digest(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row per document: words, hit words, items with occurring windows and their digest."""
    found = find_hits(docs.select("doc_id", "text"), benchmark, n=n)
    n_hit = covered(F.col("hits")).cast("long")
    ids = F.array_join(F.array_sort(F.transform("hits.items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
