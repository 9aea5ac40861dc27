"""Isolation forest per symbol (Liu, Ting and Zhou, 2008).

Every feature row decides by hash which trees it joins, so drawing the samples is one pass
and only the drawn rows are shuffled. A tree is grown from its own sample of about
`SAMPLE` rows; rows are scored in groups of bounded size next to the forest of their symbol.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.shipping import ship
from tickwell.sources.durable import broadcast_if_small

# Forest settings.
TREES, SAMPLE, CONTAMINATION, SEED = 50, 256, 0.1, 42
GROUP_ROWS = 100_000
NODES = (
    "symbol string, tree int, node int, feature int, threshold double, "
    "left int, right int, length double, drawn double"
)
NODE_COLUMNS = [part.split()[0] for part in NODES.split(", ")]


def mean_path(n: np.ndarray | float) -> np.ndarray:
    """Expected path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2.0)
    grown = 2.0 * (np.log(np.maximum(safe - 1.0, 1.0)) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, grown))


def grow(sample: np.ndarray, seed: int) -> list[tuple[int, int, float, int, int, float]]:
    """Random axis-parallel splits down to single rows or the height limit."""
    draw = np.random.default_rng(seed)
    limit = int(np.ceil(np.log2(max(len(sample), 2))))
    nodes: list[tuple[int, int, float, int, int, float]] = []
    waiting = [(0, 0, np.arange(len(sample)))]
    issued = 1
    while waiting:
        node, depth, rows = waiting.pop()
        here = sample[rows]
        spread = here.max(axis=0) - here.min(axis=0)
        splittable = np.flatnonzero(spread > 0)
        if depth >= limit or len(rows) <= 1 or len(splittable) == 0:
            nodes.append((node, -1, 0.0, -1, -1, depth + float(mean_path(len(rows)))))
            continue
        feature = int(draw.choice(splittable))
        low = here[:, feature].min()
        cut = float(low + draw.random() * spread[feature])
        goes_left = here[:, feature] <= cut
        if goes_left.all():
            cut = float(low)
            goes_left = here[:, feature] <= cut
        nodes.append((node, feature, cut, issued, issued + 1, 0.0))
        waiting.append((issued, depth + 1, rows[goes_left]))
        waiting.append((issued + 1, depth + 1, rows[~goes_left]))
        issued += 2
    return nodes


def path_lengths(points: np.ndarray, forest: pd.DataFrame) -> np.ndarray:
    """Mean path length of each point over the trees of one forest."""
    total = np.zeros(len(points))
    index = np.arange(len(points))
    trees = 0
    for _, tree in forest.sort_values("node").groupby("tree"):
        feature, threshold = tree["feature"].to_numpy(), tree["threshold"].to_numpy()
        left, right = tree["left"].to_numpy(), tree["right"].to_numpy()
        at = np.zeros(len(points), dtype=int)
        while True:
            inner = feature[at] >= 0
            if not inner.any():
                break
            value = points[index, np.maximum(feature[at], 0)]
            step = np.where(value <= threshold[at], left[at], right[at])
            at = np.where(inner, step, at)
        total += tree["length"].to_numpy()[at]
        trees += 1
    return total / max(trees, 1)


def grow_forests(
    rows: DataFrame,
    features: Sequence[str],
    identity: Sequence[str] = ("symbol", "window_start"),
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = SEED,
) -> DataFrame:
    """Node table of all forests; `identity` names a row, so repeated runs agree."""
    ship(rows.sparkSession)
    sizes = rows.groupBy("symbol").agg(F.count("*").alias("size"))
    sized = rows.join(broadcast_if_small(sizes), "symbol")
    chance = F.least(F.lit(1.0), F.lit(float(sample)) / F.col("size"))

    def joins(tree):
        drawn = F.pmod(F.xxhash64(*identity, tree, F.lit(seed)), F.lit(1 << 30))
        return drawn / F.lit(float(1 << 30)) < chance

    chosen = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), joins)
    # The identity travels along only to give the rows of a tree a fixed order.
    columns = dict.fromkeys(["symbol", *identity, *features, "size"])
    drawn = sized.select(*columns, F.explode(chosen).alias("tree"))

    def build(keys: tuple, group: pd.DataFrame) -> pd.DataFrame:
        symbol, tree = keys
        ranked = group.sort_values(list(identity))
        salt = [ord(c) for c in str(symbol)]
        nodes = grow(ranked[list(features)].to_numpy(dtype=float), [seed, int(tree), *salt])
        grown = pd.DataFrame(nodes, columns=NODE_COLUMNS[2:-1])
        wanted = min(float(sample), float(group["size"].iloc[0]))
        return grown.assign(symbol=symbol, tree=tree, drawn=wanted)[NODE_COLUMNS]

    # Growing is heavy for its few bytes: an explicit number keeps the partitions apart,
    # where adaptive coalescing would go by size and put all trees into one task.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = drawn.repartition(parts, "symbol", "tree")
    return spread.groupBy("symbol", "tree").applyInPandas(build, NODES)


def anomaly_scores(
    rows: DataFrame,
    forests: DataFrame,
    features: Sequence[str],
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """`rows` with `anomaly_score` in (0, 1); higher is more isolated."""
    ship(rows.sparkSession)
    groups = rows.groupBy("symbol").agg(
        F.ceil(F.count("*") / group_rows).cast("int").alias("_groups")
    )
    groups = broadcast_if_small(groups)
    number = F.pmod(F.xxhash64(*rows.columns), F.col("_groups")).cast("int")
    placed = rows.join(groups, "symbol").withColumn("_group", number).drop("_groups")
    copies = F.explode(F.sequence(F.lit(0), F.col("_groups") - 1))
    everywhere = forests.join(groups, "symbol").withColumn("_group", copies).drop("_groups")
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", anomaly_score double"
    columns = rows.columns

    def score(points: pd.DataFrame, forest: pd.DataFrame) -> pd.DataFrame:
        if points.empty or forest.empty:
            return points[columns].assign(anomaly_score=pd.Series(dtype=float))
        lengths = path_lengths(points[list(features)].to_numpy(dtype=float), forest)
        scale = float(mean_path(forest["drawn"].iloc[0])) or 1.0
        return points[columns].assign(anomaly_score=np.power(2.0, -lengths / scale))

    return (
        placed.groupBy("symbol", "_group")
        .cogroup(everywhere.groupBy("symbol", "_group"))
        .applyInPandas(score, schema)
    )


def cutoffs(scored: DataFrame, contamination: float = CONTAMINATION) -> DataFrame:
    """Score above which the given share of training rows lies, per symbol.

    Feature rows are one per window, which bounds what the exact percentile holds.
    """
    return scored.groupBy("symbol").agg(
        F.percentile("anomaly_score", 1.0 - contamination).alias("cutoff")
    )


def flag_anomalies(scored: DataFrame, limits: DataFrame) -> DataFrame:
    return scored.join(broadcast_if_small(limits), "symbol").withColumn(
        "anomaly", F.col("anomaly_score") > F.col("cutoff")
    )


def anomaly_counts(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("symbol").agg(
        F.count("*").alias("rows"), F.count_if("anomaly").alias("anomalies")
    )
