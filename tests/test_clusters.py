"""Clusterings from several starts against plain ones."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tickwell.operators.clusters import fit_clusters, nearest, uniform


def frame(spark, points, parts=5):
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "at int, v array<double>").repartition(parts)


def blobs(seed=1, rows=240, width=4, spread=1.0):
    draw = np.random.default_rng(seed)
    return draw.normal(size=(rows, width)) * spread + draw.integers(0, 4, size=(rows, 1)) * 2.5


def cost(points, centres):
    return sum(min(((p - np.array(c)) ** 2).sum() for c in centres) for p in points)


def test_best_of_the_starts_is_a_fixed_point(spark):
    points = blobs()
    found = fit_clusters(frame(spark, points), "at", "v", 3, 10, seed=4)
    assert found.cost == pytest.approx(cost(points, found.centres)) == pytest.approx(min(found.costs))
    assert len(found.costs) == 10
    home = np.argmin([[((p - np.array(c)) ** 2).sum() for c in found.centres] for p in points], axis=1)
    for c, centre in enumerate(found.centres):
        assert np.allclose(points[home == c].mean(axis=0), centre)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cost_is_not_above_the_best_of_ten_single_fits(spark, seed):
    points = blobs(seed, rows=150, spread=1.5)
    table = frame(spark, points).persist()
    found = fit_clusters(table, "at", "v", 3, 10, seed=42)
    vectors = table.select(array_to_vector("v").alias("features"))
    singles = [KMeans(k=3, seed=42 + i).fit(vectors).summary.trainingCost for i in range(10)]
    table.unpersist()
    assert found.cost <= min(singles) * (1 + 1e-9)


def test_result_does_not_depend_on_partitions(spark):
    points = blobs(7)
    one, two = (fit_clusters(frame(spark, points, n), "at", "v", 3, 4) for n in (1, 9))
    assert np.allclose(one.centres, two.centres) and one.cost == pytest.approx(two.cost)


def test_passes_do_not_grow_with_the_starts(spark):
    table = frame(spark, blobs(5, rows=90))
    few, many = (fit_clusters(table, "at", "v", 3, n) for n in (1, 10))
    assert many.passes < 10 * few.passes


def test_fewer_distinct_points_than_centres(spark):
    found = fit_clusters(frame(spark, [[1.0, 2.0]] * 6 + [[5.0, 5.0]] * 3), "at", "v", 3, 3)
    assert sorted(found.centres) == [(1.0, 2.0), (5.0, 5.0)] and found.cost == 0.0


def test_no_points(spark):
    empty = spark.createDataFrame([], "at int, v array<double>")
    assert fit_clusters(empty, "at", "v", 3, 2).centres == ()
    nulls = spark.createDataFrame([(1, None), (2, [3.0])], "at int, v array<double>")
    assert fit_clusters(nulls, "at", "v", 3, 2).centres == ((3.0,),)


def test_nearest_takes_the_first_of_equals(spark):
    rows = spark.createDataFrame([([0.0],), ([1.0],), ([2.0],)], "v array<double>")
    assert [r[0] for r in rows.select(nearest("v", ((0.0,), (2.0,)))).collect()] == [0, 0, 1]


def test_draws_are_even():
    drawn = uniform(np.arange(20_000), 3)
    assert 0 < drawn.min() and drawn.max() < 1
    assert abs(np.histogram(drawn, 10, (0, 1))[0] / 2000 - 1).max() < 0.1
