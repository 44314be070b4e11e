"""Whitening against numpy's eigenvectors of the whole covariance."""

from __future__ import annotations

import math

import numpy as np
import pytest
from llm.helpers import CLASHING

from riskmill.llm import whitening as w
from riskmill.llm.common import read


def vectors(spark, rows):
    schema = f"vec_id long, embedding array<float>, label int, {CLASHING}, x int, i int, v double, task int, d int"
    return spark.createDataFrame([(i, v, 1, *[None] * 21) for i, v in rows], schema)


def usable(v):
    return v is not None and all(e is not None and math.isfinite(e) for e in v)


def plain(rows, components=32):
    """(vec_id, deviation, {component: whitened}), explained: exact integers, then the full covariance."""
    rows = [(i, [math.floor(64 * float(np.float32(e))) + 1_000_000 for e in v]) for i, v in rows if usable(v)]
    n, sums = len(rows), [sum(c) for c in zip(*(x for _, x in rows))]
    exact = [[n * e - s for e, s in zip(x, sums)] for _, x in rows]
    z = np.array([[e / n for e in x] for x in exact])
    values, basis = np.linalg.eigh(z.T @ z / n)
    order = np.argsort(values)[::-1][:components]
    white = z @ basis[:, order] / np.sqrt(values[order])
    return [(i, sum(e * e for e in x)) for (i, _), x in zip(rows, exact)], white, values[order] / values.sum()


def check(df, rows, components=32):
    ids, white, shares = plain(rows, components)
    got = {}
    for r in df.collect():
        got.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append((r.whitened, r.explained, r.identity_error, r.n))
    assert len(got) == len(set(ids))
    width = white.shape[1]
    signs = None
    for key, line in zip(ids, white):
        own = np.array([got[key][k + 1][0] for k in range(width)])
        if signs is None:
            signs = np.where(np.sign(own[:, 0]) == np.sign(line), 1.0, -1.0)
        assert np.abs(own[:, 0] - line * signs).max() < 1e-6
        assert np.abs(own[:, 1] / shares - 1).max() < 1e-9
        assert own[:, 2].max() < 1e-9 and set(own[:, 3]) == {len(ids)}


def test_the_table(spark, sf_dir):
    table = read(spark, sf_dir, "embeddings")
    check(w.whiten(table), [(r.vec_id, r.embedding) for r in table.collect()])


@pytest.mark.parametrize(("dimension", "components", "to_driver"), [(5, 32, 2**24), (70, 32, 2**24), (90, 8, 2**24), (70, 32, 0)])
def test_uneven_spectra(spark, monkeypatch, dimension, components, to_driver):
    monkeypatch.setattr(w, "TO_DRIVER", to_driver)
    r = np.random.default_rng(dimension)
    rows = (r.normal(size=(800, dimension)) * np.geomspace(40, 1, dimension)).astype(np.float32).tolist()
    rows = [(k, v) for k, v in enumerate(rows)]
    extra = [(900, None), (901, [None] * dimension), (902, [math.nan] * dimension), (903, [math.inf] + [0.0] * (dimension - 1))]
    check(w.whiten(vectors(spark, rows + extra).repartition(7), components), rows, components)


def test_close_eigenvalues_are_found_without_the_covariance():
    """A flat spectrum, the hard case: more passes, the same vectors."""
    r = np.random.default_rng(1)
    q = np.linalg.qr(r.normal(size=(120, 120)))[0]
    values = np.linspace(2, 1, 120)
    v, calls = q * values @ q.T, []
    found, basis = w.leading(lambda x: calls.append(x.shape) or v @ x, 120, 32)
    assert np.abs(found - values[:32]).max() < 1e-12 and set(calls) == {(120, 52)}
    assert np.abs(np.abs((basis * q[:, :32]).sum(axis=0)) - 1).max() < 1e-12


def test_missing_ranks(spark):
    """Components of zero eigenvalues have no rows; the others are right."""
    r = np.random.default_rng(2)
    rows = [(k, [float(a), float(b), float(a) + 1, 0.0, 7.0]) for k, (a, b) in enumerate(r.integers(-50, 50, (300, 2)))]
    got = w.whiten(vectors(spark, rows)).collect()
    assert {x.component for x in got} == {1, 2} and max(x.identity_error for x in got) < 1e-9 and len(got) == 600
    assert w.whiten(vectors(spark, [(k, [1.0, 2.0]) for k in range(9)])).count() == 0
    assert w.whiten(vectors(spark, [])).count() == 0 and w.whiten(vectors(spark, [(1, None), (2, [])])).count() == 0
    assert w.whiten(vectors(spark, [])).columns == [f.split()[0] for f in w.WHITENED.split(", ")]


def test_awkward_vectors(spark):
    rows = [(None, [1.0, 2.5]), (None, [3.0, -1.5]), (1, [0.25, 0.5]), (1, [0.25, 0.5]), (2, [1e30, 5.0]), (3, [9.0, -1e30]), (4, [1.0]), (5, [1.0, 2.0, 3.0])]
    got = w.whiten(vectors(spark, rows)).collect()
    assert len(got) == 12 and {x.n for x in got} == {6} and max(x.identity_error for x in got) < 1e-4
    assert sorted({x.deviation is None for x in got}) == [True]  # beyond a long
    few = w.whiten(vectors(spark, [r for r in rows if r[0] not in (2, 3)])).collect()
    assert {x.n for x in few} == {4} and all(x.deviation is not None for x in few)


def test_exact_sums():
    x = np.array([[2**40 + 1, 5], [7, -(2**40)]], np.int64)
    for n in (3, 2**30):
        fit = w.Fitted(n, [int(s) * n // 2 for s in x.sum(axis=0)])
        want = [[n * int(e) - s for e, s in zip(row, fit.sums)] for row in x.tolist()]
        assert fit.deviations(x).tolist() == want
        squares = [sum(e * e for e in row) for row in want]
        assert w.squares(fit.deviations(x)) == [s if s < 2**63 else None for s in squares]
