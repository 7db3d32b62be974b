"""Whitening against exact integers in plain Python."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tidemart.llm.queries import op12_whitening
from tidemart.llm.whitening import sliced_products, whiten

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


def integer_rows(vectors, scale=1024, shift=100000):
    return [[math.floor(scale * float(c)) + shift for c in v] for v in vectors]


def exact_covariance(x):
    n, size = len(x), len(x[0])
    s = [sum(r[d] for r in x) for d in range(size)]
    cov = [[Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n ** 3) for j in range(size)]
           for i in range(size)]
    return s, cov


def check(got, ids, vectors, kept):
    x = integer_rows(vectors)
    n, (s, cov) = len(x), exact_covariance(x)
    v = np.array([[float(c) for c in r] for r in cov])
    trace = float(sum(cov[d][d] for d in range(len(s))))
    values = np.linalg.eigvalsh(v)[::-1]
    assert len(got) == n * kept
    rows = {}
    for r in got:
        rows.setdefault(r["vec_id"], {})[r["component"]] = r
    assert sorted(rows) == sorted(ids) and len(set(ids)) == n
    w = np.array([[rows[i][c]["whitened"] for c in range(1, kept + 1)] for i in ids])
    centred = np.array([[float(Fraction(n * e - t, n)) for e, t in zip(r, s)] for r in x])
    for c in range(1, kept + 1):
        first = rows[ids[0]][c]
        assert first["n"] == n
        assert first["explained"] == pytest.approx(values[c - 1] / trace, rel=1e-6)
        # the axis behind the projections is a unit eigenvector: w = centred @ axis / sqrt(e)
        axis = np.linalg.lstsq(centred, w[:, c - 1] * math.sqrt(values[c - 1]), rcond=None)[0]
        assert np.linalg.norm(axis) == pytest.approx(1, abs=1e-8)
        assert np.abs(v @ axis - values[c - 1] * axis).max() <= 1e-8 * values[0]
    for i, r in zip(ids, x):
        assert rows[i][1]["deviation"] == sum((n * e - t) ** 2 for e, t in zip(r, s))
    error = np.abs(np.cov(w.T, bias=True) - np.eye(kept)).max()
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]}
    assert got[0]["identity_error"] == pytest.approx(error, abs=1e-9) and error <= 1e-4


def test_whitening_equals_exact_integers(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = op12_whitening(spark, SF).collect()
    check(got, [r["vec_id"] for r in table], [r["embedding"] for r in table], 8)


@pytest.mark.parametrize("low,high", [(0, 1), (-3, 7), (100000, 101300), (-(1 << 40), 1 << 41), (5, 5)])
def test_bit_planes_give_exact_products(low, high):
    x = np.random.default_rng(7).integers(low, high, (301, 6), endpoint=True)
    x[:, 2] = low
    least, sums, products = sliced_products(x)
    y = (x - x.min(axis=0)).astype(object)
    assert (least == x.min(axis=0)).all() and (sums == y.sum(axis=0)).all() and (products == y.T @ y).all()


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = rng.normal(size=(40, 3)).astype(np.float32).tolist()
    bad = [None, [], [1.0, None, 2.0], [float("nan"), 0.0, 1.0], [float("inf"), 0.0, 1.0], [1.0, 2.0]]
    rows = [(i, v, None) for i, v in enumerate(good)] + [(100 + i, v, 1) for i, v in enumerate(bad)]
    got = whiten(spark.createDataFrame(rows, VECTORS)).collect()
    check(got, list(range(40)), good, 3)
    # repeated rows and null ids are rows of their own
    twice = spark.createDataFrame([(None, good[0], 0), (None, good[0], 0), (1, good[1], 0)], VECTORS)
    again = whiten(twice).collect()
    assert len(again) == 9 and {r["n"] for r in again} == {3} and sum(r["vec_id"] is None for r in again) == 6
    # one row, equal rows: no variance
    for part in (rows[:1], rows[:1] * 3):
        flat = whiten(spark.createDataFrame(part, VECTORS)).collect()
        assert {(r["whitened"], r["explained"], r["identity_error"], r["deviation"]) for r in flat} == {(0.0, 0.0, 0.0, 0)}
    assert whiten(spark.createDataFrame([], VECTORS)).count() == 0
    assert whiten(spark.createDataFrame([(1, None, 2)], VECTORS)).count() == 0


def test_deviation_past_64_bits_is_exact(spark):
    rows = [(i, [float(x), -float(x)], 0) for i, x in enumerate((1e11, -1e11, 3e11, 12.0))]
    x = integer_rows([r[1] for r in rows])
    s = [sum(r[d] for r in x) for d in range(2)]
    want = {i: sum((4 * e - t) ** 2 for e, t in zip(r, s)) for i, r in enumerate(x)}
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r["vec_id"]: int(r["deviation"]) for r in got} == want and max(want.values()) > 1 << 63
