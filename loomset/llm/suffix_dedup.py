"""Exact substring dedup: interval expansion on a Burrows-Wheeler transform, bounded by a length.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier (smaller doc_id, or the same
document and a smaller offset) is removed; strings are judged on the input and lie inside one document.

1. Anchors. Of the hashes of ``GRAM``-byte grams inside a window of ``LENGTH`` bytes the smallest is the
   window's anchor. It depends on the window's bytes alone, so equal windows share an anchor. Neighbouring
   windows with one anchor form a run, about one per 39 bytes; a run's context is the bytes its windows cover.
2. Repeats. Only anchors that occur twice matter, in two runs or in one. Runs with equal contexts collapse to the first of
   them, the others are repeated as a whole.
3. Interval expansion. What remains are first runs whose anchor occurs twice among first runs. Their
   contexts are dealt out by anchor and joined, a bounded number of whole groups at a time, into a text whose
   suffixes are sorted. On its transform, boundaries between suffixes whose common prefix is shorter than
   l are extended backward by one letter to those shorter than l + 1, breadth first for l = 1, 2, ...,
   LENGTH - 1. Suffixes without a boundary between them then share LENGTH bytes; in each such interval all
   windows but the earliest are repeated.
4. An anchor with more than ``MOST_CONTEXTS`` first runs is not held in one task: its windows are matched one
   by one on 128-bit hashes by aggregation, which is exact too and spreads over all tasks.
5. Spans are merged per document and cut out.

Null text counts as empty. Rows without a doc_id are never earlier than others and keep all their bytes.
Rows that repeat a doc_id are versions of one document: equal offsets are the same place, not repeats, and
spans found in one apply to all. Texts shorter than LENGTH keep their bytes. An empty table gives an empty
table. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.llm.common import hint_small
from loomset.llm.near_dedup import mix
from loomset.session import drop_path, materialize, write_scratch

LENGTH = 100
GRAM = 24
MOST_CONTEXTS = 16_384  # at most 2.9 MB of contexts, about 0.3 GB of arrays while they are sorted
BLOCK = 1 << 20
_SEED = 97
_C = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def _letters() -> np.ndarray:
    return np.random.default_rng(_SEED).integers(0, 2**64, 256, dtype=np.uint64)


def _doubled(buffer: np.ndarray, letters: np.ndarray) -> list[np.ndarray]:
    """Hashes of all strings of 1, 2, 4, ..., 64 bytes."""
    out = [letters[buffer]]
    for level in range(6):
        h, k = out[-1], 1 << level
        out.append(h[:-k] * _C[level] + h[k:] if len(h) > k else np.empty(0, np.uint64))
    return out


def _window_hash(doubled: list[np.ndarray], length: int, factor: int) -> np.ndarray:
    """Hash of every window of ``length`` bytes, 64 <= length <= 128: its first and last 64."""
    h = doubled[6]
    return mix(h[: len(h) - (length - 64)] * _C[factor] + h[length - 64 :])


def runs(buffer: np.ndarray, piece: np.ndarray, letters: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(low, high, anchor, content, own) of the runs of windows in ``buffer`` that stay inside one piece.

    ``piece`` numbers the piece of every byte. Windows start at low to high, both inclusive.
    """
    n = len(buffer) - length + 1
    if n <= 0:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, np.int64))
    d = _doubled(buffer, letters)
    g = mix(d[4][: len(buffer) - gram + 1] * _C[7] + d[3][gram - 8 :])  # 16 bytes and the last 8 of 24
    width = length - gram + 1
    low = g
    k = 1
    while 2 * k <= width:
        low = np.minimum(low[:-k], low[k:])
        k *= 2
    low = np.minimum(low[: len(low) - (width - k)], low[width - k :])
    inside = np.flatnonzero(piece[:n] == piece[length - 1 :])
    if not len(inside):
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, np.int64))
    new = np.ones(len(inside), bool)
    new[1:] = (inside[1:] != inside[:-1] + 1) | (low[inside[1:]] != low[inside[:-1]]) | (piece[inside[1:]] != piece[inside[:-1]])
    begun = np.flatnonzero(new)
    new |= (np.arange(len(inside)) - begun[np.cumsum(new) - 1]) % width == 0  # periodic text: one anchor for ever
    begun = np.flatnonzero(new)
    first = inside[begun]
    last = inside[np.append(begun[1:], len(inside)) - 1]
    h = _window_hash(d, length, 6)
    content = mix(h[first] * _C[5] + h[last] + (last - first).astype(np.uint64) * _C[4])
    # A run that holds its anchor twice (periodic text) may repeat a window of its own.
    own = np.zeros(len(first), np.int64)
    span = np.arange(2 * width - 1)
    for at in range(0, len(first), 4096):
        a, b = first[at : at + 4096, None], last[at : at + 4096, None]
        grams = a + span
        same = (g[np.minimum(grams, len(g) - 1)] == low[a]) & (grams < b + width)
        own[at : at + 4096] = same.sum(1) > 1
    return first, last, low[first], content, own


def _pieces(batches, length: int):
    """Buffers of about ``BLOCK`` bytes: (bytes, piece of each byte, document and offset of each piece)."""
    parts, docs, offsets, size = [], [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
            if doc_id is None or len(data) < length:
                continue
            for at in range(0, len(data) - length + 1, BLOCK):
                part = data[at : at + BLOCK + length - 1]
                parts.append(part)
                docs.append(doc_id)
                offsets.append(at)
                size += len(part)
                if size >= BLOCK:
                    yield np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts]), docs, offsets
                    parts, docs, offsets, size = [], [], [], 0
    if parts:
        yield np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts]), docs, offsets


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


def find_runs(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(anchor, content, doc_id, low, high, n) of every run; ``n`` is 2 if it may repeat a window of its own."""

    def run(batches):
        letters = _letters()
        for buffer, piece, ids, offsets in _pieces(batches, length):
            low, high, anchor, content, own = runs(buffer, piece, letters, length, gram)
            starts = np.searchsorted(piece, np.arange(len(ids)))
            of = piece[low]
            shift = np.array(offsets, np.int64)[of] - starts[of]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), pa.array(np.array(ids, np.int64)[of]), pa.array((low + shift).astype(np.int32)), pa.array((high + shift).astype(np.int32)), pa.array((own + 1).astype(np.int8))],
                ["anchor", "content", "doc_id", "low", "high", "n"],
            )

    return _texts(docs, text).mapInArrow(run, "anchor long, content long, doc_id long, low int, high int, n byte")


def sorted_suffixes(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ordered by at least their first ``depth`` symbols (bytes + 1; 0 separates), by prefix doubling."""
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(8, symbols.dtype)]).astype(np.int64)
    key = np.zeros(n, np.int64)
    for i in range(6):
        key = key * 257 + padded[i : i + n]
    k = 6
    while True:
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        if k >= depth or rank[order[-1]] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[: n - k] = rank[k:] + 1
        key = rank * (n + 1) + after
        k *= 2


def expanded_intervals(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order, and for each place in it the number of its interval of suffixes with ``length`` common symbols."""
    n = len(symbols)
    order = sorted_suffixes(symbols, length)
    transform = symbols[order - 1]  # the letter before each suffix; the text is read as a ring
    # Place j holds the suffix that place forward[j] gives when extended backward: letters in order, equal ones as they stand.
    forward = np.argsort(transform, kind="stable")
    # Places whose suffix begins with another letter than the one before: common prefix shorter than 1.
    letter = transform[forward]
    boundary = np.ones(n, bool)
    boundary[1:] = letter[1:] != letter[:-1]
    known = int(boundary.sum())
    for _ in range(1, length):
        group = np.cumsum(boundary)
        reached = group[forward]
        boundary[1:] |= reached[1:] != reached[:-1]
        count = int(boundary.sum())
        if count == known:
            break
        known = count
    return order, np.cumsum(boundary) - 1


def shared_stretches(contexts: list[bytes], docs: np.ndarray, lows: np.ndarray, length: int = LENGTH) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The stretches of ``contexts`` whose windows may be repeated in them: those whose first and last 64 bytes both are.

    Keeps every repeated window, and spares the sorting of contexts that share little more than an anchor.
    """
    sizes = np.array([len(c) for c in contexts])
    which = np.repeat(np.arange(len(contexts)), sizes)
    hashed = _doubled(np.frombuffer(b"".join(contexts), np.uint8), _letters())[6]
    ranked = np.sort(hashed)
    twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    if not len(twice):
        return [], docs[:0], lows[:0]
    again = twice[np.minimum(np.searchsorted(twice, hashed), len(twice) - 1)] == hashed
    n = len(hashed) - (length - 64)
    windows = np.flatnonzero(again[:n] & again[length - 64 :] & (which[:n] == which[length - 1 : length - 1 + n]))
    if not len(windows):
        return [], docs[:0], lows[:0]
    new = np.ones(len(windows), bool)
    new[1:] = (windows[1:] != windows[:-1] + 1) | (which[windows[1:]] != which[windows[:-1]])
    begun = np.flatnonzero(new)
    first, last = windows[begun], windows[np.append(begun[1:], len(windows)) - 1]
    of = which[first]
    shift = first - (np.cumsum(sizes) - sizes)[of]
    cut = [contexts[c][a : a + (z - f) + length] for c, a, f, z in zip(of.tolist(), shift.tolist(), first.tolist(), last.tolist(), strict=True)]
    return cut, docs[of], lows[of] + shift


def repeated_windows(contexts: list[bytes], docs: np.ndarray, lows: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, end) of the spans that repeated windows cover, over whole contexts of the same anchors."""
    contexts, docs, lows = shared_stretches(contexts, docs, lows, length)
    if not contexts:
        return docs, lows, lows
    sizes = np.array([len(c) for c in contexts])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    symbols = np.zeros(int((sizes + 1).sum()), np.int16)
    for c, at in zip(contexts, starts, strict=True):
        symbols[at : at + len(c)] = np.frombuffer(c, np.uint8).astype(np.int16) + 1
    order, interval = expanded_intervals(symbols, length)
    which = np.repeat(np.arange(len(contexts)), sizes + 1)
    within = np.arange(len(symbols)) - starts[which]
    whole = within + length <= sizes[which]
    chosen = whole[order]
    places, groups = order[chosen], interval[chosen]
    doc, at = docs[which[places]], lows[which[places]] + within[places]
    rank = np.lexsort((at, doc, groups))
    g, d, a = groups[rank], doc[rank], at[rank]
    new = np.ones(len(g), bool)
    new[1:] = g[1:] != g[:-1]
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    again = (d != d[head]) | (a != a[head])
    d, a = d[again], a[again]
    if not len(d):
        return d, a, a
    rank = np.lexsort((a, d))
    d, a = d[rank], a[rank]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (a[1:] > a[:-1] + length)
    begun = np.flatnonzero(new)
    ends = np.append(begun[1:], len(d)) - 1
    return d[begun], a[begun], a[ends] + length


_SPANS = "doc_id long, start int, end int"


def _expand(length: int):
    def run(batches):
        held, size, last = [], 0, None

        def flush():
            found = repeated_windows([h[3] for h in held], np.array([h[1] for h in held], np.int64), np.array([h[2] for h in held], np.int64), length)
            return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1].astype(np.int32)), pa.array(found[2].astype(np.int32))], ["doc_id", "start", "end"])

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if size >= BLOCK and row[0] != last:
                    yield flush()
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
                last = row[0]
        if held:
            yield flush()

    return run


def _cut_contexts(docs: DataFrame, wanted: DataFrame, text: str, length: int) -> DataFrame:
    """(anchor, doc_id, low, crowded, bytes): the contexts of ``wanted`` (doc_id, anchor, low, high, crowded)."""
    lists = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "low", "high", "crowded")).alias("cuts"))
    joined = _texts(docs, text).join(lists, "doc_id").select("doc_id", "text", "cuts")
    types = [("anchor", pa.int64()), ("doc_id", pa.int64()), ("low", pa.int32()), ("crowded", pa.bool_()), ("bytes", pa.binary())]

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, value, cuts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                data = (value or "").encode("utf-8", "surrogatepass")
                for c in cuts:
                    part = data[c["low"] : c["high"] + length]
                    if len(part) >= length:
                        rows.append((c["anchor"], doc_id, c["low"], c["crowded"], part))
                if len(rows) >= 4096:
                    yield _batch(rows, types)
                    rows = []
            if rows:
                yield _batch(rows, types)

    return joined.mapInArrow(run, "anchor long, doc_id long, low int, crowded boolean, bytes binary")


def _hashed_windows(contexts: DataFrame, length: int) -> DataFrame:
    """(h1, h2, doc_id, at): 128-bit hashes of the windows of ``contexts`` (doc_id, low, bytes)."""
    types = [("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int32())]

    def run(batches):
        letters = _letters()
        for batch in batches:
            rows = []
            for doc_id, low, part in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                d = _doubled(np.frombuffer(part, np.uint8), letters)
                one, two = _window_hash(d, length, 6).view(np.int64), _window_hash(d, length, 2).view(np.int64)
                rows += [(x, y, doc_id, low + i) for i, (x, y) in enumerate(zip(one.tolist(), two.tolist(), strict=True))]
            if rows:
                yield _batch(rows, types)

    return contexts.select("doc_id", "low", "bytes").mapInArrow(run, "h1 long, h2 long, doc_id long, at int")


def _batch(rows: list[tuple], types: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), types, strict=True)], [n for n, _ in types])


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """(doc_id, spans): disjoint sorted (start, end) byte ranges to remove, for documents that have some."""
    spark = docs.sparkSession
    found_at = write_scratch(find_runs(docs, text, length, gram), "runs")
    found = spark.read.parquet(found_at)
    repeated = found.groupBy("anchor").agg(F.sum("n").alias("total")).where("total > 1").select("anchor")
    rows_at = write_scratch(found.join(repeated, "anchor"), "repeated_runs")
    drop_path(spark, found_at)  # a written table replaces it; the same below
    rows = spark.read.parquet(rows_at)
    firsts = rows.groupBy("anchor", "content").agg(F.min("doc_id").alias("first"))
    marked = materialize(rows.join(firsts, ["anchor", "content"]).drop("content"), "marked_runs")
    drop_path(spark, rows_at)
    whole = marked.where("doc_id > first").select("doc_id", F.col("low").alias("start"), (F.col("high") + length).alias("end"))
    lead = marked.where("doc_id = first").select("anchor", "doc_id", "low", "high", "n")
    crowd = lead.groupBy("anchor").agg(F.sum("n").alias("count")).where("count > 1")
    open_ = lead.join(crowd, "anchor").withColumn("crowded", F.col("count") > most_contexts)

    contexts = materialize(_cut_contexts(docs, open_, text, length), "contexts")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    normal = contexts.where("NOT crowded").select("anchor", "doc_id", "low", "bytes")
    inner = normal.repartition(parts, "anchor").sortWithinPartitions("anchor", "doc_id", "low").mapInArrow(_expand(length), _SPANS)

    hot = materialize(_hashed_windows(contexts.where("crowded"), length), "hot_windows")
    groups = hot.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    same = materialize(hot.join(groups, ["h1", "h2"]), "hot_repeats")
    place = same.where("doc_id = first").groupBy("h1", "h2").agg(F.min("at").alias("first_at"))
    single = same.join(place, ["h1", "h2"]).where("doc_id > first OR at > first_at").select("doc_id", F.col("at").alias("start"), (F.col("at") + length).alias("end"))

    spans = whole.unionByName(inner).unionByName(single)
    listed = spans.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("all"))
    zero = F.struct(F.lit(-1).alias("start"), F.lit(-1).alias("end"), F.array().cast("array<struct<start:int,end:int>>").alias("done"))

    def join(acc: Column, s: Column) -> Column:
        grown = F.struct(acc["start"].alias("start"), F.greatest(acc["end"], s["end"]).alias("end"), acc["done"].alias("done"))
        closed = F.when(acc["end"] >= 0, F.array_append(acc["done"], F.struct(acc["start"].alias("start"), acc["end"].alias("end")))).otherwise(acc["done"])
        return F.when(s["start"] <= acc["end"], grown).otherwise(F.struct(s["start"].alias("start"), s["end"].alias("end"), closed.alias("done")))

    merged = F.aggregate("all", zero, join, lambda acc: F.array_append(acc["done"], F.struct(acc["start"].alias("start"), acc["end"].alias("end"))))
    return listed.select("doc_id", merged.alias("spans"))


def _cut(data: bytes, spans) -> tuple[bytes, int, int]:
    """Kept bytes, removed bytes and number of removed runs."""
    kept, at, removed, n = [], 0, 0, 0
    for s in spans or ():
        start, end = min(s["start"], len(data)), min(s["end"], len(data))
        if end > start:
            kept.append(data[at:start])
            removed += end - start
            n += 1
            at = end
    kept.append(data[at:])
    return b"".join(kept), removed, n


def _with_spans(docs: DataFrame, text: str, **options) -> DataFrame:
    spans = materialize(repeated_spans(docs, text, **options), "spans")
    total = spans.agg(F.coalesce(F.sum(F.size("spans")), F.lit(0)).alias("n"), F.count("*").alias("d")).first()
    return _texts(docs, text).join(hint_small(spans, total["n"] + total["d"] * 3, 8), "doc_id", "left").select("doc_id", "text", "spans")


def remove_repeats(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """(doc_id, text, n_removed): the kept bytes as text; letters of which only a part is kept are dropped."""

    def run(batches):
        for batch in batches:
            out = [(i, *_cut((t or "").encode("utf-8", "surrogatepass"), s)) for i, t, s in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1].decode("utf-8", "ignore") for x in out], pa.string()), pa.array([x[2] for x in out], pa.int64())], ["doc_id", "text", "n_removed"])

    return _with_spans(docs, text, **options).mapInArrow(run, "doc_id long, text string, n_removed long")


def dedup_digest(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, value, spans in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                data = (value or "").encode("utf-8", "surrogatepass")
                kept, removed, n = _cut(data, spans)
                rows.append((doc_id, len(data), removed, n, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _with_spans(docs, text, **options).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
