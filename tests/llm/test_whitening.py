"""Whitening against the library's eigensolver, and the counts against known spectra."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tickwell.llm import whitening

SHAPE = "vec_id bigint, embedding array<float>, label int, n string, whitened string, x_ int"
RNG = np.random.default_rng(3)


def rotated(values):
    q, _ = np.linalg.qr(RNG.standard_normal((len(values), len(values))))
    return (q * np.array(values)) @ q.T


SPECTRA = [
    [5.0, 4, 3, 2, 1, 0.5],
    [3.0, 3, 3, 2, 2, 1, 1e-3],
    [1.0, 1 - 1e-9, 1 - 2e-9, 0.2, 0],
    [1e9, 1.0, 1e-3, 1e-3, 0, 0],
    [-4.0, -1, 0.5, 2, 7, 0],
]


@pytest.mark.parametrize("values", SPECTRA)
def test_counts_and_intervals(values):
    matrix, ordered = rotated(values), np.sort(values)
    for a, b in zip(ordered, ordered[1:], strict=False):
        if b - a > 1e-10 * np.abs(values).max():
            assert whitening.below(matrix, (a + b) / 2) == (ordered < (a + b) / 2).sum()
    found = whitening.isolate(matrix, len(values))
    assert sum(m for _, _, m in found) == len(values)
    assert all(a[0] >= b[1] for a, b in zip(found, found[1:], strict=False))


def test_counts_where_a_pivot_is_zero():
    assert whitening.below(np.array([[0.0, 1], [1, 0]]), 0.0) == 1
    assert whitening.below(np.array([[0.0, 1, 1], [1, 0, 1], [1, 1, 0]]), 0.0) == 2
    assert whitening.below(np.zeros((3, 3)), 0.0) == 0


@pytest.mark.parametrize("values", SPECTRA[:4])
def test_leading_components(values):
    matrix = rotated(values)
    got, vectors = whitening.leading(matrix, 4)
    want = np.sort(values)[::-1][: len(got)]
    assert np.allclose(got, want, rtol=1e-7, atol=1e-12 * max(values))
    assert np.allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * got).max() < 1e-8 * max(values)


def test_many_dimensions_at_double_precision():
    matrix = rotated(np.geomspace(1000, 1, 40))
    got, vectors = whitening.leading(matrix, 16)
    e, v = np.linalg.eigh(matrix)
    assert np.allclose(got, e[::-1][:16], rtol=1e-12)
    assert np.allclose(np.abs((vectors * v[:, ::-1][:, :16]).sum(axis=0)), 1, atol=1e-12)


def plain(rows, wanted):
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept]
    fit = np.array(sorted(set(map(tuple, x))), np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    z = fit - sums / n
    e, v = np.linalg.eigh(z.T @ z / n)
    e, v = e[::-1][:wanted], v[:, ::-1][:, :wanted]
    white = ((np.array(x) - sums / n) @ v) / np.sqrt(e)
    deviation = [sum((n * a - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return [i for i, _ in kept], n, deviation, white, e / np.trace(z.T @ z / n)


def vectors(count, size):
    base = RNG.standard_normal((count, size)) @ RNG.standard_normal((size, size)) * 3
    rows = [(k, [float(np.float32(c)) for c in row]) for k, row in enumerate(base)]
    copies = [(1000 + k, rows[7][1]) for k in range(count // 2)]
    odd = [(None, rows[3][1]), (2000, None), (2001, []), (2002, [None] + rows[1][1][1:]), (2003, [math.nan] * size),
           (2004, [math.inf] + rows[2][1][1:]), (5, rows[5][1])]
    return rows + copies + odd


@pytest.mark.parametrize("size", [3, 20])
def test_against_plain(spark, size):
    rows = vectors(60, size)
    frame = spark.createDataFrame([(i, v, 1, "n", "w", 2) for i, v in rows], SHAPE).repartition(4)
    got = whitening.whiten(frame).collect()
    ids, n, deviation, white, share = plain(rows, 16)
    names = got[0].asDict().keys()
    assert {"n", "n_", "whitened", "whitened_", "x_", "deviation", "explained", "identity_error"} <= names
    assert sorted(map(str, (r.vec_id for r in got))) == sorted(map(str, ids))
    at = {(i, d): w for i, d, w in zip(ids, deviation, white, strict=True)}
    signs = None
    for r in got:
        assert r["n_"] == n and r.identity_error < 1e-9 and r.n == "n"
        want = at[r.vec_id, r.deviation]
        assert len(r["whitened_"]) == min(16, size)
        if signs is None:
            signs = np.sign(np.array(r["whitened_"]) * want)
        assert np.allclose(np.array(r["whitened_"]) * signs, want, atol=1e-8)
        assert np.allclose(r.explained, share, rtol=1e-9)


def test_awkward_tables(spark):
    def run(rows):
        return whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()

    assert run([]) == []
    assert run([(1, None), (2, [math.nan])]) == []
    same = run([(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert [(r.n, r.deviation, r.whitened, r.explained) for r in same] == [(1, 0, [], [])] * 2
    # One direction of spread gives one component; a vector of another length is left out.
    line = run([(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [1.0, 2.0, 3.0])])
    assert sorted((r.vec_id, r.n, len(r.whitened)) for r in line) == [(1, 2, 1), (2, 2, 1)]
    assert sorted(abs(r.whitened[0]) for r in line) == pytest.approx([1, 1])


def test_query_covers_the_table(spark):
    rows = whitening.op12(spark, "/root/testdata/sf0.001")
    source = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert rows.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert rows.count() == 16 * source.count()
    assert rows.select("identity_error").first()[0] <= 1e-9
