"""Embedding whitening by shifted CholeskyQR.

1. Lattice. An entry c becomes the long floor(256 c). The fit list holds every distinct vector once, so
   copies weigh nothing; it is written and each pass reads it.
2. Sums. One pass adds the entries per dimension, exactly.
3. Orthogonalisation. Rows are centred as (n x - S) / n, from exact integers. Each pass solves them through
   the triangular factors found so far and adds up the Gram matrix of the result: tasks add their blocks, and
   the driver receives one d x d matrix. Its Cholesky factor, shifted in the first pass and wherever the
   plain one breaks down, joins the factors. Passes end when the Gram matrix is the identity, after three
   for most data. Factors multiply to R with A'A = R'R.
4. Components. The singular values of R squared, over n, are the eigenvalues of the covariance, its right
   singular vectors the components. If directions without variance keep the Gram matrix from the identity,
   its symmetric root closes the product, which keeps A'A = R'R.

Rows whose vector is null, empty, or holds a null or non-finite entry are dropped, as are rows of another
length than most distinct vectors have (of equally frequent lengths the longest counts). Entries beyond the
range of a long saturate. Components whose singular value is lost in rounding (below d 2^-50 of the largest)
are not returned, so fewer than wanted are possible, and none for an empty table, a single distinct vector or
equal vectors. Repeated rows each get their result and count once in the fit. Ids, labels and other columns
are not read and pass through; an added column whose name is taken gets a trailing underscore. Vectors of
more than ``MAX_DIM`` dimensions are refused: that bounds what the driver and a task hold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.llm.common import fresh
from loomset.session import materialize

SCALE = 256
COMPONENTS = 4
MAX_DIM = 2048
MAX_PASSES = 8
_ENTRIES = 1 << 20  # numbers of a block of rows
_LONG = 1 << 63
_DIGITS = pa.decimal128(38, 0)


def lattice(vector: Column) -> Column:
    """Entries as longs, floor(256 c); null for a vector that is null, empty or holds a null or non-finite entry."""
    usable = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    whole = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))
    return F.when(usable & (F.size(vector) > 0), whole)


@dataclass
class Whitening:
    """Fitted parameters: ``components`` are columns, ``eigenvalues`` fall."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float | None
    passes: int

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace if len(self.eigenvalues) else self.eigenvalues


def _rows(column: pa.ListArray, d: int) -> Iterator[np.ndarray]:
    """Blocks of a list column as int64 matrices of width ``d``."""
    step = max(1, _ENTRIES // max(d, 1))
    for start in range(0, len(column), step):
        some = column.slice(start, step)
        yield some.flatten().to_numpy(zero_copy_only=False).reshape(len(some), d)


def off_mean(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: int64 where that holds it, else Python integers."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if n * most + max(map(abs, sums), default=0) < _LONG:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return off_mean(x, n, sums).astype(np.float64) / n


def squares(off: np.ndarray) -> list[int]:
    """Exact sum of squares of every row."""
    if off.dtype != object:
        most = max(abs(int(off.max(initial=0))), abs(int(off.min(initial=0))))
        if most * most * off.shape[1] < _LONG:
            return (off * off).sum(1).tolist()
    return [sum(v * v for v in map(int, row)) for row in off]


def solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Rows times the inverse of every upper triangular factor, first to last, column by column."""
    out = rows.copy()
    for r in factors:
        for j in range(len(r)):
            out[:, j] = (out[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def matrix_sum(table: DataFrame, part: Callable[[Iterator[np.ndarray], int], np.ndarray], shape: tuple[int, int], d: int) -> np.ndarray:
    """The sum over all tasks of the matrix that ``part`` makes of a task's blocks of the column ``x``.

    Tasks send their matrix by rows, and equal rows meet; the driver receives one matrix. Rows are added in
    the order of their tasks, so the sum does not depend on arrival.
    """

    def partial(batches):
        blocks = (block for batch in batches for block in _rows(batch.column(0), d))
        matrix = part(blocks, d)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(matrix)), pa.int32()), pa.array(list(matrix), pa.list_(pa.float64()))], ["i", "v"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(2)):
                v = v.values.to_numpy()
                total[i] = total[i] + v if i in total else v
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], ["i", "v"])

    parts = table.select("x").mapInArrow(partial, "i int, v array<double>").select("i", F.spark_partition_id().alias("task"), "v")
    added = parts.repartition("i").sortWithinPartitions("i", "task").mapInArrow(add, "i int, v array<double>")
    out = np.zeros(shape)
    for row in added.collect():  # shape[0] rows
        out[row["i"]] = row["v"]
    return out


def _exact_sums(table: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows, and exact sums per dimension."""

    def partial(batches):
        n, total = 0, [0] * d
        for batch in batches:
            for x in _rows(batch.column(0), d):
                most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
                wide = x if most * len(x) < _LONG else x.astype(object)
                total = [a + int(b) for a, b in zip(total, wide.sum(0))]
                n += len(x)
        if n:
            values = pa.array([Decimal(v) for v in [n, *total]], _DIGITS)
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int32()), values], ["i", "v"])

    rows = table.select("x").mapInArrow(partial, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect()
    by_place = {r["i"]: int(r["v"]) for r in rows}  # d + 1 rows
    return by_place.get(-1, 0), [by_place.get(i, 0) for i in range(d)]


def _cholesky(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper factor; shifted by the bound of the rounding errors if asked for or if the plain one breaks down."""
    d = len(gram)
    if not shifted:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            pass
    shift = 11 * (n * d + d * (d + 1)) * 2.0**-53 * np.linalg.norm(gram, 2)
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift *= 10


def fit(vectors: DataFrame, vector: str = "vector", components: int = COMPONENTS) -> Whitening:
    """Components of the distinct lattice vectors in the column ``vector``, at most ``components`` of them."""
    none = Whitening(0, [], np.empty((0, 0)), np.empty(0), 0.0, None, 0)
    points = vectors.select(lattice(F.col(f"`{vector}`")).alias("x")).where("x IS NOT NULL")
    table = materialize(points.groupBy("x").count().select("x", F.size("x").alias("d")), "vectors")
    width = table.groupBy("d").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if width is None:
        return none
    d = width["d"]
    if d > MAX_DIM:
        raise ValueError(f"vectors have {d} dimensions; {MAX_DIM} are the most")
    table = table.where(F.col("d") == d)
    n, sums = _exact_sums(table, d)

    def gram_of(factors: list[np.ndarray]) -> np.ndarray:
        shared = table.sparkSession.sparkContext.broadcast(factors)  # d x d numbers a pass

        def part(blocks, width):
            out = np.zeros((width, width))
            for x in blocks:
                q = solved(centred(x, n, sums), shared.value)
                out += q.T @ q
            return out

        return matrix_sum(table, part, (d, d), d)

    factors: list[np.ndarray] = []
    product = np.eye(d)
    while True:
        gram = gram_of(factors)
        if not factors and not gram.any():
            return Whitening(n, sums, np.empty((d, 0)), np.empty(0), 0.0, None, 1)
        if factors and np.abs(gram - np.eye(d)).max() <= d * 2.0**-46:
            break
        if len(factors) == MAX_PASSES:
            values, turned = np.linalg.eigh(gram)
            product = np.sqrt(np.maximum(values, 0))[:, None] * turned.T @ product
            break
        factors.append(_cholesky(gram, n, shifted=not factors))
        product = factors[-1] @ product

    _, singular, right = np.linalg.svd(product)
    found = int((singular[:components] > singular[0] * d * 2.0**-50).sum())
    model = Whitening(n, sums, right[:found].T.copy(), singular[:found] ** 2 / n, float((singular**2).sum() / n), None, len(factors) + 1)
    model.identity_error = _identity_error(table, model, d)
    return model


def projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    return centred(x, model.n, model.sums) @ model.components / np.sqrt(model.eigenvalues)


def _identity_error(table: DataFrame, model: Whitening, d: int) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, centred by its own mean."""
    k = len(model.eigenvalues)

    def total(blocks, _):
        return sum((projected(x, model).sum(0, keepdims=True) for x in blocks), np.zeros((1, k)))

    mean = matrix_sum(table, total, (1, k), d)[0] / model.n

    def gram(blocks, _):
        out = np.zeros((k, k))
        for x in blocks:
            w = projected(x, model) - mean
            out += w.T @ w
        return out

    return float(np.abs(matrix_sum(table, gram, (k, k), d) / model.n - np.eye(k)).max())


def whiten(vectors: DataFrame, model: Whitening, vector: str = "vector") -> DataFrame:
    """``vectors`` without unusable rows, with ``whitened`` (one number per component) and ``deviation``.

    ``deviation`` is the exact sum of (n x - S)^2 over the dimensions as a decimal of 38 digits; null beyond.
    """
    whitened, deviation, x = fresh(vectors, "whitened", "deviation", "_x")
    names, d = vectors.columns, len(model.sums)
    schema = T.StructType([*vectors.schema.fields, T.StructField(whitened, T.ArrayType(T.DoubleType())), T.StructField(deviation, T.DecimalType(38, 0))])
    point = lattice(F.col(f"`{vector}`"))
    kept = vectors.select("*", point.alias(x)).where(F.col(x).isNotNull() & (F.size(x) == d))
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        fitted = shared.value
        for batch in batches:
            start = 0
            for block in _rows(batch.column(len(names)), d):
                some = batch.slice(start, len(block))
                start += len(block)
                exact = [Decimal(v) if v < 10**38 else None for v in squares(off_mean(block, fitted.n, fitted.sums))]
                rows = pa.array(list(projected(block, fitted)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*[some.column(i) for i in range(len(names))], rows, pa.array(exact, _DIGITS)], [*names, whitened, deviation])

    return kept.mapInArrow(run, schema)


def whitening_rows(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per remaining row and component; ``deviation`` is null where a long cannot hold it."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))
    model = fit(rows, components=components)
    explained = F.array(*[F.lit(float(v)) for v in model.explained]).cast("array<double>")
    made = whiten(rows, model).select("vec_id", F.expr("try_cast(deviation AS long)").alias("deviation"), F.posexplode("whitened").alias("_at", "whitened"))
    return made.select(
        "vec_id", (F.col("_at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("_at")).alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"),
    )
