"""Whitening against a dense eigendecomposition, exact sums, and odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomset.llm.whitening import MAX_DIM, centred, fit, off_mean, solved, squares, whiten, whitening_rows


def plain(rows, k=4):
    """{(vec_id, place): (n, deviation, whitened, explained)} from (vec_id, vector) rows, by definition."""
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fitted = np.array(sorted({tuple(x) for _, x in kept}), np.float64)
    n, sums = len(fitted), [sum(int(v) for v in column) for column in fitted.T]
    a = fitted - np.array(sums) / n
    values, vectors = np.linalg.eigh(a.T @ a / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    out = {}
    for i, x in kept:
        w = (np.array(x) - np.array(sums) / n) @ vectors / np.sqrt(values)
        out.setdefault(i, []).append((n, sum((n * p - s) ** 2 for p, s in zip(x, sums)), w, values / np.trace(a.T @ a / n)))
    return out


def table(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return df.withColumns({"whitened": F.lit("x"), "_x": F.lit(1), "n": F.lit(2)}) if extra else df


def compare(got, want, k=4):
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    assert set(by_id) == set(want)
    signs = {}
    for i, places in by_id.items():
        n, deviation, w, explained = want[i][0]
        assert sorted(places) == list(range(1, len(w) + 1))
        for c, rows in places.items():
            assert len(rows) == len(want[i])
            for r in rows:
                assert (r["n"], r["deviation"]) == (n, deviation)
                assert r["explained"] == pytest.approx(explained[c - 1], rel=1e-9)
                assert r["identity_error"] <= 1e-10
                if c not in signs and abs(w[c - 1]) > 1e-3:
                    signs[c] = math.copysign(1, r["whitened"] * w[c - 1])
                assert r["whitened"] * signs.get(c, 1) == pytest.approx(w[c - 1], abs=1e-8)


def test_whitening_equals_an_eigendecomposition(spark):
    rng = np.random.default_rng(4)
    data = rng.normal(0, [3, 2, 1, 0.5, 0.2, 0.1], (400, 6)) @ rng.normal(0, 1, (6, 6)) + 50
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    rows += [(7, rows[3][1])] * 40 + [(1000 + i, rows[5][1]) for i in range(150)]
    rows += [(2000, None), (2001, [None] * 6), (2002, [float("nan")] * 6), (2003, [math.inf] + [0.0] * 5), (2004, [])]
    plan = table(spark, rows, extra=True).repartition(16)
    got = whitening_rows(plan).collect()
    mine = [r for r in got if r["vec_id"] != 7]
    compare(mine, {i: v for i, v in plain(rows).items() if i != 7})
    assert len([r for r in got if r["vec_id"] == 7]) == 41 * 4


def test_whitening_of_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], [float(c) for c in r["embedding"]]) for r in df.collect()]
    compare(whitening_rows(df).collect(), plain(rows))


def test_columns_that_depend_on_each_other(spark):
    rng = np.random.default_rng(5)
    a = np.round(rng.normal(0, 40, (200, 2)))
    data = np.column_stack([a, a.sum(1), np.zeros(200), np.full(200, 9.0)])
    df = spark.createDataFrame([(i, (v / 256).tolist()) for i, v in enumerate(data)], "vec_id long, vector array<double>")
    model = fit(df)
    values = np.linalg.eigvalsh(np.cov(np.unique(data, axis=0).T, bias=True))[::-1]
    assert len(model.eigenvalues) == 2 and model.eigenvalues == pytest.approx(values[:2], rel=1e-10)
    assert model.trace == pytest.approx(values.sum(), rel=1e-10) and model.identity_error < 1e-10


def test_variances_far_apart(spark):
    """Condition number 1e9: a plain Gram matrix would lose the last component."""
    rng = np.random.default_rng(6)
    data = np.round(rng.normal(0, [1e11, 1e6, 100], (300, 3)))
    df = spark.createDataFrame([(i, (v / 256).tolist()) for i, v in enumerate(data)], "vec_id long, vector array<double>")
    model = fit(df)
    singular = np.linalg.svd(data - data.mean(0), compute_uv=False)
    assert model.eigenvalues == pytest.approx(singular**2 / 300, rel=1e-6) and model.identity_error < 1e-6


def test_sums_are_exact():
    x = np.array([[2**62, -(2**62)], [5, 7]])
    sums = [2**62 + 5, 7 - 2**62]
    off = off_mean(x, 2, sums)
    assert off.tolist() == [[2 * int(v) - s for v, s in zip(row, sums)] for row in x.tolist()]
    assert squares(off) == [sum(v * v for v in row) for row in off.tolist()]
    small = np.array([[3, 1], [2, 9]])
    assert off_mean(small, 2, [5, 10]).dtype == np.int64 and squares(off_mean(small, 2, [5, 10])) == [65, 65]
    assert centred(small, 2, [5, 10]).tolist() == [[0.5, -4], [-0.5, 4]]
    r = np.array([[2.0, 1.0], [0.0, 4.0]])
    assert solved(np.array([[2.0, 9.0]]), [r, r]).tolist() == (np.array([[2.0, 9.0]]) @ np.linalg.inv(r) @ np.linalg.inv(r)).tolist()


def test_few_or_no_vectors(spark):
    assert whitening_rows(table(spark, [])).count() == 0
    assert whitening_rows(table(spark, [(1, None), (2, [])])).count() == 0
    assert whitening_rows(table(spark, [(1, [1.0, 2.0]), (None, [1.0, 2.0])])).count() == 0
    two = whitening_rows(table(spark, [(1, [1.0, 2.0]), (None, [3.0, 2.0]), (3, [-0.0])])).collect()
    assert sorted((r["vec_id"] or 0, r["component"], round(abs(r["whitened"]), 12), round(r["explained"], 12)) for r in two) == [(0, 1, 1.0, 1.0), (1, 1, 1.0, 1.0)]
    with pytest.raises(ValueError):
        fit(table(spark, [(1, [0.0] * (MAX_DIM + 1))]), "embedding")


def test_huge_entries_saturate(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.5, 2.0])]
    got = whitening_rows(table(spark, rows)).collect()
    assert {r["vec_id"] for r in got} == {1, 2, 3} and all(r["deviation"] is None for r in got if r["vec_id"] < 3)
    x = [[2**63 - 1, 0], [-(2**63), 256], [128, 512]]
    sums = [sum(c) for c in zip(*x)]
    # Fewer digits than 38 need the third row here: 3 x - S.
    model = fit(table(spark, rows), "embedding")
    exact = {r["vec_id"]: r["deviation"] for r in whiten(table(spark, rows), model, "embedding").collect()}
    for i, row in enumerate(x, 1):
        value = sum((3 * p - s) ** 2 for p, s in zip(row, sums))
        assert exact[i] is None if value >= 10**38 else int(exact[i]) == value


def test_added_columns_take_free_names(spark):
    df = table(spark, [(1, [1.0, 2.0]), (2, [0.0, 5.0])], extra=True)
    made = whiten(df, fit(df, "embedding"), "embedding")
    assert made.columns == [*df.columns, "whitened_", "deviation"] and made.count() == 2
