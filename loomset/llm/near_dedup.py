"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

1. Shingles. A document's set is its distinct hashed shingles of ``WORDS`` words. Documents with the
   same set (a 128-bit digest) become one node named by its smallest doc_id.
2. Sketch. Coordinates are bins. In round i every shingle is thrown into one bin with a value in
   [i, i + 1); a bin keeps its smallest value. Rounds go on until every bin is full; rounds from ``BINS``
   onward throw everything into bin ``i - BINS``, so after 2 x BINS rounds no bin is empty. The share of
   equal coordinates is concentrated around the similarity as if coordinates were independent.
3. Bands of ``ROWS`` coordinates. A pair of similarity 0.75 misses all bands with probability
   (1 - 0.75^6)^60 < 1e-5; more similar pairs far less.
4. Links. In every bucket each node is compared on its whole set with the bucket's smallest node, and
   the links found are merged into components. A group of copies thus costs one comparison per member
   and bucket. Nodes of buckets that still hold several components are compared across components
   where they share one of their rarest shingles, as every linked pair does. That loses nothing and spares
   the pairs of a passage which many otherwise different texts share.
5. Components by smallest-label propagation, with every step written to the shared folder.

Texts that are null, empty or without words have an empty set and are linked with nothing. Rows without
a doc_id are returned alone, with a null component, and kept. Rows that repeat a doc_id are one document.
An empty table gives an empty table. Extra columns are ignored (``mark``) or pass through (``keep_first``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomset.llm.common import hint_small
from loomset.session import materialize

WORDS = 5
SIMILARITY = 0.75
ROWS = 6
BANDS = 60
BINS = ROWS * BANDS
SEED = 20240229
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # finaliser of a public 64-bit mixer


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit integers one to one."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of texts; word hashes are remembered up to a fixed number."""

    def __init__(self, words: int = WORDS, remembered: int = 200_000):
        self.words, self.remembered, self.known = words, remembered, {}
        self.odd = np.random.default_rng(SEED).integers(0, 2**63, words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.remembered:
            known.clear()
        out = np.empty(len(words), np.uint64)
        for i, w in enumerate(words):
            h = known.get(w)
            if h is None:
                h = known[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
            out[i] = h
        return out

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space alone
        if not words:
            return np.empty(0, np.uint64)
        h = self.word_hashes(words)
        k = min(self.words, len(h))
        n = len(h) - k + 1
        total = np.full(n, np.uint64(k), np.uint64)
        for i in range(k):
            total += h[i : i + n] * self.odd[i]
        return np.unique(mix(total))


def sketch(shingles: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The ``bins`` smallest values, each as round * 2^32 + 32 hashed bits."""
    full = np.uint64(2**64 - 1)
    out = np.full(bins, full, np.uint64)
    for i in range(2 * bins):
        h = mix(shingles + np.uint64((SEED + (i + 1) * 0x9E3779B97F4A7C15) % 2**64))
        value = (np.uint64(i) << np.uint64(32)) | (h >> np.uint64(32))
        if i < bins:
            where = ((h & np.uint64(0xFFFFFFFF)) * np.uint64(bins)) >> np.uint64(32)
            np.minimum.at(out, where.astype(np.int64), value)
        else:
            out[i - bins] = min(out[i - bins], value.min())
        if out.max() != full:
            break
    return out


def band_keys(values: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key for each band."""
    rows = values.reshape(bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(rows.shape[1]):
        key = mix(key ^ rows[:, j]) + np.uint64(j)
    return mix(key).view(np.int64)


def _signed(with_sets: bool, bins: int, bands: int):
    def run(batches):
        shingler = Shingler()
        for batch in batches:
            ids, n, s1, s2, sets, keys = [], [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = shingler(text)
                d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                ids.append(doc_id)
                n.append(len(s))
                s1.append(int.from_bytes(d[:8], "little", signed=True))
                s2.append(int.from_bytes(d[8:], "little", signed=True))
                if with_sets:
                    sets.append(s.view(np.int64))
                elif len(s) and doc_id is not None:
                    keys.append(band_keys(sketch(s, bins), bands))
                else:
                    keys.append(np.empty(0, np.int64))
            arrays = [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(sets or keys, pa.list_(pa.int64()))]
            names = ["doc_id", "n_shingles", "s1", "s2", "sets" if with_sets else "keys"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


def signatures(docs: DataFrame, text: str = "text", bins: int = BINS, bands: int = BANDS) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, keys): set size, set digest and band keys of every row."""
    return _texts(docs, text).mapInArrow(_signed(False, bins, bands), "doc_id long, n_shingles long, s1 long, s2 long, keys array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Of (a, b) pairs those whose whole sets reach ``similarity``."""
    percent = round(similarity * 100)
    left = sets.select(F.col("id").alias("a"), F.col("sets").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("sets").alias("right"))
    both = F.size(F.array_intersect("left", "right"))
    union = F.size("left") + F.size("right") - both
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", (both * 100 >= union * percent).alias("linked"))
    return joined.where("linked").select("a", "b").distinct()


def _across(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (id, n, c) of different components ``c`` that can reach ``percent``.

    All nodes put their shingles in one order: those that no other component has, then rare before
    frequent. The first shingle two linked nodes share lies so early in either list that enough others can
    follow: among the first n - ceil(2p / (1 + p) n) + 1 of the smaller and n - ceil(p n) + 1 of the larger,
    and with ceil(p / (1 + p) (n + m)) or more from there on in both.
    """
    each = nodes.join(sets, "id").select("id", "n", "c", F.explode("sets").alias("s"))
    shared = each.groupBy("s").agg(F.count("*").alias("f"), F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("s", "f")
    of = Window.partitionBy("id")
    place = F.row_number().over(of.orderBy("f", "s")) + F.col("n") - F.count("*").over(of)
    larger = F.expr(f"n - ({percent} * n + 99) div 100 + 1")
    smaller = F.expr(f"n - ({2 * percent} * n + {99 + percent}) div {100 + percent} + 1")
    placed = each.join(shared, "s").select("s", "id", "n", "c", place.alias("place"), smaller.alias("first"), larger.alias("all"))
    early = materialize(placed.where("place <= `all`").select("s", "id", "n", "c", (F.col("n") - F.col("place") + 1).alias("left"), (F.col("place") <= F.col("first")).alias("first")), "early")
    x, y = early.where("first").alias("x"), early.alias("y")
    grows = F.struct("x.n", "x.id") < F.struct("y.n", "y.id")
    fits = F.least("x.left", "y.left") * (100 + percent) >= (F.col("x.n") + F.col("y.n")) * percent
    found = x.join(y, F.col("x.s") == F.col("y.s")).where((F.col("x.c") != F.col("y.c")) & grows & fits)
    return found.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for the ends of (a, b) edges: the smallest id that can be reached."""
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component")).withColumnRenamed("a", "id"), "labels")
    while True:
        # The smallest label among the neighbours, then the label of that label: long chains shorten by halves.
        seen = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("near"))
        near = labels.join(seen.withColumnRenamed("a", "id"), "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("near"))
        jump = labels.select(F.col("id").alias("near"), F.col("component").alias("far"))
        new = materialize(near.join(jump, "near", "left").select("id", "old", F.least("near", F.coalesce("far", "near")).alias("component")), "labels")
        changed = new.where("old <> component").limit(1).count()
        labels = new.select("id", "component")
        if not changed:
            return labels


def near_duplicates(docs: DataFrame, text: str = "text", similarity: float = SIMILARITY, bins: int = BINS, bands: int = BANDS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest linked doc_id), kept."""
    signed = materialize(signatures(docs, text, bins, bands), "signed")
    named = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    nodes = named.groupBy("s1", "s2").agg(F.min("doc_id").alias("id"))
    # (key, id) once for each node; a copy's row differs from its node's only in doc_id
    own = signed.join(nodes, ["s1", "s2"], "left").select("doc_id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("id")).alias("id"), "keys")
    first = F.col("id") == F.col("doc_id")
    own = materialize(own.withColumn("keys", F.when(first, F.col("keys"))), "nodes")
    bands_of = own.where("keys IS NOT NULL").select("id", F.col("n_shingles").alias("n"), F.explode("keys").alias("key"))
    shared = bands_of.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last").select("key", "hub")
    buckets = materialize(bands_of.join(shared, "key").select("key", "id", "n", "hub"), "buckets")

    members = materialize(buckets.select("id").distinct(), "members")
    wanted = hint_small(members.withColumnRenamed("id", "doc_id"), members.count(), 16)
    again = _texts(docs, text).join(wanted, "doc_id", "left_semi")
    sets = again.mapInArrow(_signed(True, bins, bands), "doc_id long, n_shingles long, s1 long, s2 long, sets array<long>")
    sets = materialize(sets.where("n_shingles > 0").select(F.col("doc_id").alias("id"), "sets"), "sets")

    stars = materialize(_verified(buckets.where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct(), sets, similarity), "stars")
    merged = components(stars)
    labelled = buckets.join(merged.withColumnRenamed("component", "c"), "id", "left").withColumn("c", F.coalesce("c", "id"))
    split = labelled.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("key")
    unsettled = materialize(labelled.join(split, "key", "left_semi").select("id", "n", "c").distinct(), "unsettled")
    across = materialize(_across(unsettled, sets, round(similarity * 100)), "across")
    rest = materialize(_verified(across, sets, similarity), "rest")
    everything = components(stars.union(rest))

    out = own.join(everything, "id", "left")
    component = F.coalesce("component", "id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_first(docs: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates: the one with the smallest doc_id."""
    found = materialize(near_duplicates(docs, text, similarity), "near")
    gone = materialize(found.where("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct(), "gone")
    return docs.join(hint_small(gone, gone.count(), 16), "doc_id", "left_anti").select(*[docs[f"`{c}`"] for c in docs.columns])
