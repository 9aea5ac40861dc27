"""K-means from several starts at once: each round is one pass over the rows for all of them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.shipping import ship
from tickwell.sources.durable import cut

ROUNDS, SETTLED = 100, 1e-12
DRAWN = "start int, race double, row bigint, point array<double>"
TOTALS = "start int, cluster int, dimension int, total double"
# What stands in the place of a dimension beside the sums of a cluster.
ROWS, COST = -1, -2


@dataclass(frozen=True)
class Clusters:
    """`cost` is the sum of squared distances to the nearest centre, by start in `costs`."""

    centres: tuple[tuple[float, ...], ...]
    cost: float
    costs: tuple[float, ...]
    passes: int


def fit_clusters(points: DataFrame, row: str, vector: str, k: int, starts: int, seed: int = 0) -> Clusters:
    """The cheapest of `starts` clusterings of the finite vectors in `vector`; `row` is unique.

    First centres are drawn with odds by squared distance from those before: each row draws a time that
    its odds shorten and the earliest is taken, so that one aggregation draws for every start. The
    draws depend on `row`, not on partitions. A round then moves the centres of every start; a start
    whose cost no longer falls is left out of the next. Fewer than `k` distinct vectors give as many
    centres, no rows give none. Only centres and their sums, `starts` times `k` vectors, reach the driver.
    """
    ship(points.sparkSession)
    named = points.select(F.xxhash64(row, F.lit(seed)).alias("row"), F.col(vector).alias("point"))
    stored = cut(named.where("point IS NOT NULL"))
    passes, sets = 0, [np.empty((0, 0))] * starts
    for at in range(k):
        drawn, passes = _drawn(stored, sets, at), passes + 1
        sets = [_with(centres, drawn.get(start)) for start, centres in enumerate(sets)]
    if not len(sets[0]):
        return Clusters((), 0.0, (0.0,) * starts, passes)
    costs, moving = [float("inf")] * starts, set(range(starts))
    final = list(sets)
    while moving and passes < k + ROUNDS:
        found, passes = _totals(stored, {s: sets[s] for s in moving}), passes + 1
        for start in sorted(moving):
            moved, cost = found[start]
            if cost >= costs[start] * (1 - SETTLED):
                moving.discard(start)
                continue
            # The cost is that of the centres the rows were held against, not of the moved ones.
            final[start], costs[start], sets[start] = sets[start], cost, moved
    best = min(range(starts), key=lambda s: (costs[s], s))
    centres = tuple(tuple(map(float, c)) for c in final[best])
    return Clusters(centres, costs[best], tuple(costs), passes)


def nearest(vector: str, centres: tuple[tuple[float, ...], ...]) -> Column:
    """Index of the nearest centre, the first of equally near ones."""

    def distance(centre: tuple[float, ...]) -> Column:
        gaps = F.zip_with(vector, F.array(*[F.lit(c) for c in centre]), lambda x, c: (x - c) * (x - c))
        return F.aggregate(gaps, F.lit(0.0), lambda total, g: total + g)

    distances = F.array(*[distance(c) for c in centres])
    return F.array_position(distances, F.array_min(distances)).cast("int") - 1


def _with(centres: np.ndarray, point: list[float] | None) -> np.ndarray:
    if point is None:
        return centres
    return np.array([point]) if not len(centres) else np.vstack([centres, point])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch["point"].flatten().to_numpy().reshape(len(batch), -1)


def squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each centre, one centre after the other."""
    return np.stack([((points - c) ** 2).sum(axis=1) for c in centres], axis=1)


def uniform(rows: np.ndarray, salt: int) -> np.ndarray:
    """A number in (0, 1) for each row and salt, by the splitmix64 finaliser."""
    x = rows.astype(np.uint64) + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def _drawn(stored: DataFrame, sets: list[np.ndarray], at: int) -> dict[int, list[float]]:
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            points, rows = _matrix(batch), batch["row"].to_numpy()
            starts, races, chosen = [], [], []
            for start, centres in enumerate(sets):
                odds = squared(points, centres).min(axis=1) if at else np.ones(len(points))
                with np.errstate(divide="ignore"):
                    race = -np.log(uniform(rows, start * 1024 + at)) / odds
                first = np.lexsort((rows, race))[0]
                if np.isfinite(race[first]):
                    starts.append(start), races.append(race[first]), chosen.append(first)
            yield pa.RecordBatch.from_pydict(
                {
                    "start": pa.array(starts, pa.int32()), "race": pa.array(races, pa.float64()),
                    "row": pa.array(rows[chosen], pa.int64()) if chosen else pa.array([], pa.int64()),
                    "point": pa.array([points[c] for c in chosen], pa.list_(pa.float64())),
                }
            )

    first = F.min_by("point", F.struct("race", "row")).alias("point")
    return {r["start"]: r["point"] for r in stored.mapInArrow(draw, DRAWN).groupBy("start").agg(first).collect()}


def _totals(stored: DataFrame, sets: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, float]]:
    """For each start its centres moved to the mean of their rows, and the cost before."""
    order = sorted(sets)
    width = next(iter(sets.values())).shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {s: np.zeros((len(sets[s]), width + 2)) for s in order}
        for batch in batches:
            if not len(batch):
                continue
            points = _matrix(batch)
            for s in order:
                gaps = squared(points, sets[s])
                home = gaps.argmin(axis=1)
                for c in range(len(sets[s])):
                    mine = home == c
                    sums[s][c, :width] += points[mine].sum(axis=0)
                    sums[s][c, width] += mine.sum()
                    sums[s][c, width + 1] += gaps[mine, c].sum()
        names = np.array([*range(width), ROWS, COST], dtype=np.int32)
        for s in order:
            k = len(sets[s])
            yield pa.RecordBatch.from_pydict(
                {
                    "start": np.full(k * len(names), s, dtype=np.int32),
                    "cluster": np.repeat(np.arange(k, dtype=np.int32), len(names)),
                    "dimension": np.tile(names, k),
                    "total": sums[s].ravel(),
                }
            )

    totals = stored.mapInArrow(add, TOTALS).groupBy("start", "cluster", "dimension").agg(F.sum("total").alias("total"))
    means = {s: np.zeros_like(sets[s]) for s in order}
    rows = {s: np.zeros(len(sets[s])) for s in order}
    cost = dict.fromkeys(order, 0.0)
    for start, cluster, dimension, total in totals.collect():
        if dimension == ROWS:
            rows[start][cluster] = total
        elif dimension == COST:
            cost[start] += total
        else:
            means[start][cluster, dimension] = total
    moved = {
        s: np.where(rows[s][:, None] > 0, means[s] / np.maximum(rows[s], 1)[:, None], sets[s]) for s in order
    }
    return {s: (moved[s], cost[s]) for s in order}
