"""Quality classifier: random-indexing word vectors, pooled, and a small calibrated network.

1. Word vectors. Every word owns a sparse random index vector of +1 and -1 entries. The vector of a word
   is the sum of the index vectors of its neighbours, over all documents. Words are hashed into
   ``SLOTS`` slots, so vectors are a table of fixed size whatever the vocabulary; tasks add up their own
   share and send one row per slot they met.
2. Pooling. A document is the mean and the spread of its words' normalised vectors, and the logarithm of
   its word count. The whole text is read. A text without words pools to zeros and is scored like any other.
3. Network. Two layers in numpy, fitted on the driver with at most ``MAX_TRAIN`` labelled documents:
   those with the smallest hash of id, label and vector among the rows allowed for training; rows equal in
   all three count once. The tasks filter them by a threshold that counts of hashes give, so the driver
   receives no others. One fifth of them is set
   aside to fit the temperature that calibrates probabilities.

Rows whose crc32 of the doc_id's text leaves 2 modulo 4 are held out: their labels are never read. Labels,
language, source and id are no features. Labels that are null, or not 0 or 1, are ignored; contradicting
labels of one document are all used. Without labels of both classes the score is the mean label, or 0.5.
Null text counts as empty; a null doc_id counts as the empty text for the held-out rule, and has no label.
Repeated rows are scored row by row, an empty table gives an empty table, extra columns pass through.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.llm.common import fresh, hint_small, packed, unpacked
from loomset.session import materialize

SLOTS = 1 << 13
DIM = 32
NONZERO = 4
WINDOW = 2
HIDDEN = 24
MAX_TRAIN = 20_000
THRESHOLD = 0.7
SEED = 7
_TOKENS = 1 << 20  # words a task gathers before it adds them up


def _index_vectors(slots: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the nonzero entries of every slot's index vector."""
    rng = np.random.default_rng(SEED)
    at = np.argsort(rng.random((slots, dim)), axis=1)[:, :NONZERO].astype(np.int64)
    return at, rng.choice([-1.0, 1.0], (slots, NONZERO))


class _Slots:
    """Slots of the words of a text; word hashes are remembered up to a fixed number."""

    def __init__(self, slots: int):
        self.slots, self.known = slots, {}

    def __call__(self, text: str | None) -> np.ndarray:
        known, slots = self.known, self.slots
        if len(known) > 200_000:
            known.clear()
        out = []
        for w in (text or "").split():
            s = known.get(w)
            if s is None:
                s = known[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) % slots
            out.append(s)
        return np.array(out, np.int64)


def word_sums(docs: DataFrame, text: str = "text", slots: int = SLOTS, dim: int = DIM) -> DataFrame:
    """(slot, c0, c1, ...): the sum of the neighbours' index vectors for every slot that occurs."""
    names = [f"c{i}" for i in range(dim)]

    def run(batches):
        at, sign = _index_vectors(slots, dim)
        total = np.zeros(slots * dim)
        slot_of, waiting, n = _Slots(slots), [], 0

        def add():
            ids = np.concatenate(waiting)  # documents are separated by WINDOW entries of -1
            for d in range(1, WINDOW + 1):
                a, b = ids[:-d], ids[d:]
                both = (a >= 0) & (b >= 0)
                a, b = a[both], b[both]
                for k in range(NONZERO):
                    for word, near in ((a, b), (b, a)):
                        total[:] += np.bincount(word * dim + at[near, k], weights=sign[near, k], minlength=slots * dim)
            waiting.clear()

        for batch in batches:
            for value in batch.column(0).to_pylist():
                ids = slot_of(value)
                if len(ids):
                    waiting += [ids, np.full(WINDOW, -1, np.int64)]
                    n += len(ids)
                if n >= _TOKENS:
                    add()
                    n = 0
        if waiting:
            add()
        table = total.reshape(slots, dim)
        met = np.flatnonzero(np.abs(table).sum(1))
        yield pa.RecordBatch.from_arrays([pa.array(met)] + [pa.array(table[met, i].astype(np.int64)) for i in range(dim)], ["slot", *names])

    sums = docs.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, "slot long, " + ", ".join(f"{c} long" for c in names))
    return sums.groupBy("slot").agg(*[F.sum(c).alias(c) for c in names])


def word_vectors(docs: DataFrame, text: str = "text", slots: int = SLOTS, dim: int = DIM) -> np.ndarray:
    """Unit word vectors by slot, float32. The driver receives ``slots`` x ``dim`` numbers at most."""
    out = np.zeros((slots, dim), np.float32)
    for row in word_sums(docs, text, slots, dim).collect():
        out[row[0]] = row[1:]
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def pool(docs: DataFrame, vectors: np.ndarray, text: str, result: str) -> DataFrame:
    """``docs`` without ``text``, with the pooled vector of the whole text in ``result``."""
    (name,) = fresh(docs, result)
    kept = [c for c in docs.columns if c != text]
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches):
        table = shared.value
        slot_of = _Slots(len(table))
        for batch in batches:
            rows = []
            for value in batch.column(batch.num_columns - 1).to_pylist():
                ids = slot_of(value)
                if len(ids):
                    v = table[ids]
                    mean = v.mean(0)
                    spread = np.sqrt(np.maximum((v * v).mean(0) - mean * mean, 0))
                    rows.append(np.concatenate([mean, spread, [np.log1p(len(ids)) / 8]]).astype(np.float32))
                else:
                    rows.append(np.zeros(2 * table.shape[1] + 1, np.float32))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, pa.list_(pa.float32()))], [*kept, name])

    plain = docs.select(*[f"`{c}`" for c in kept], F.col(f"`{text}`").cast("string").alias(name))
    schema = plain.drop(name).schema.add(name, T.ArrayType(T.FloatType()))
    return plain.mapInArrow(run, schema)


def _forward(x: np.ndarray, net: dict) -> np.ndarray:
    hidden = np.maximum(((x - net["mean"]) / net["sd"]) @ net["w1"] + net["b1"], 0)
    return hidden @ net["w2"] + net["b2"]


def probabilities(x: np.ndarray, net: dict) -> np.ndarray:
    if "constant" in net:
        return np.full(len(x), net["constant"])
    return 1 / (1 + np.exp(-np.clip(_forward(x, net) / net["temperature"], -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = 60, seed: int = SEED) -> dict:
    """A two-layer network and its temperature. Adam on the log loss, a fifth of the rows set aside to calibrate."""
    if len(set(y.tolist())) < 2:
        return {"constant": float(y.mean()) if len(y) else 0.5}
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    aside = order[: max(1, len(y) // 5)]
    used = order[len(aside):] if len(y) > 5 else order
    mean, sd = x[used].mean(0), x[used].std(0) + 1e-6
    net = {"mean": mean, "sd": sd, "w1": rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)), "b1": np.zeros(hidden), "w2": rng.normal(0, hidden**-0.5, hidden), "b2": 0.0}
    keys = ("w1", "b1", "w2", "b2")
    moment = {k: (np.zeros_like(net[k]), np.zeros_like(net[k])) for k in keys}
    step = 0
    for _ in range(epochs):
        rng.shuffle(used)
        for i in range(0, len(used), 128):
            rows = used[i : i + 128]
            z = (x[rows] - mean) / sd
            h = np.maximum(z @ net["w1"] + net["b1"], 0)
            p = 1 / (1 + np.exp(-np.clip(h @ net["w2"] + net["b2"], -30, 30)))
            g = (p - y[rows]) / len(rows)
            back = np.outer(g, net["w2"]) * (h > 0)
            grads = {"w1": z.T @ back + 1e-4 * net["w1"], "b1": back.sum(0), "w2": h.T @ g + 1e-4 * net["w2"], "b2": g.sum()}
            step += 1
            for k in keys:
                m, v = moment[k]
                m = 0.9 * m + 0.1 * grads[k]
                v = 0.999 * v + 0.001 * grads[k] ** 2
                moment[k] = (m, v)
                net[k] = net[k] - 0.005 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    logits, truth = _forward(x[aside], net), y[aside]
    grid = np.exp(np.linspace(-1.5, 2.5, 81))
    loss = [np.mean(np.logaddexp(0, -np.where(truth == 1, 1, -1) * logits / t)) for t in grid]
    return net | {"temperature": float(grid[int(np.argmin(loss))])}


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def training_rows(rows: DataFrame, most: int) -> DataFrame:
    """The ``most`` rows with the smallest hash ``h``, which is hexadecimal and unique.

    Counts per hash prefix, at most 4,096 numbers a time, find the threshold; the prefix that holds it is
    counted by its next digits. Tasks then filter, so no more than ``most`` rows leave them.
    """
    prefix, room = "", most
    while len(prefix) < 64:
        width = len(prefix) + 3
        inside = rows.where(F.col("h").startswith(prefix)) if prefix else rows
        counts = sorted((r[0], r[1]) for r in inside.groupBy(F.substring("h", 1, width)).count().collect())
        full = None
        for start, n in counts:
            if n > room:
                full = start
                break
            room -= n
        if full is None:  # everything inside fits
            return rows if not prefix else rows.where(F.substring("h", 1, len(prefix)) <= prefix)
        prefix = full
        if room == 0:
            break
    return rows.where(F.substring("h", 1, len(prefix)) < prefix)


def score(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", result: str = "score", max_train: int = MAX_TRAIN) -> DataFrame:
    """``docs`` without ``text``, with the calibrated probability of label 1 in ``result``."""
    vectors = word_vectors(docs, text)
    (features,) = fresh(docs, "_features")
    pooled = materialize(pool(docs, vectors, text, features), "pooled")
    allowed = labels.where(~held_out(F.col("doc_id")) & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).alias("y"))
    labelled = allowed.join(pooled.select("doc_id", F.col(features).alias("x")), "doc_id")
    key = F.sha2(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("y").cast("string"), F.col("x").cast("string")), 256)
    known = materialize(labelled.withColumn("h", key).dropDuplicates(["h"]), "labelled")
    chosen = sorted(training_rows(known, max_train).collect(), key=lambda r: r["h"])  # at most max_train rows
    x = np.array([r["x"] for r in chosen], np.float64).reshape(len(chosen), -1 if chosen else 1)
    net = fit(x, np.array([r["y"] for r in chosen], np.float64))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for batch in batches:
            last = batch.num_columns - 1
            values = np.array(batch.column(last).to_pylist(), np.float64).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(last)], pa.array(probabilities(values, shared.value), pa.float64())], [*batch.schema.names[:last], name])

    (name,) = fresh(pooled, result)
    return pooled.mapInArrow(run, pooled.drop(features).schema.add(name, T.DoubleType()))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without those that score below ``threshold``. Rows are carried through the scoring as they are."""
    row, copy, p = fresh(docs, "_row", "_text", "_score")
    keep, names = packed(docs)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("text_hash"), F.col(f"`{text}`").alias(copy))
    scored = score(narrow, labels, copy, result=p)
    # Equal texts score alike, so the verdict of a text is found by its id and hash, null ids included.
    bad = materialize(scored.where(F.col(p) < threshold).select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash")).distinct(), "rejected")
    flat = docs.select(keep.alias(row), F.col("doc_id").cast("long").alias("_id"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("_hash"))
    kept = flat.join(hint_small(bad, bad.count(), 24), F.col("_id").eqNullSafe(F.col("_bad_id")) & (F.col("_hash") == F.col("_bad_hash")), "left_anti")
    return kept.select(*unpacked(row, names))
