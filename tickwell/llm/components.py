"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.common import cut

MOST_ROUNDS = 60


def star(links: DataFrame, large: bool) -> DataFrame:
    """One star step: neighbours are hung on the smallest id around each node.

    `links` holds (u, v) with v < u. The large step moves larger neighbours of every node, the small
    step the smaller ones. The smallest neighbour is a partial aggregation; the join that brings it
    back can be split where a node has very many links.
    """
    if large:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.where("u <> v").distinct()
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.union(own).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b) that is not itself the smallest of its component.

    Self-links and repeated links change nothing; an empty table gives an empty one. Each round is
    checkpointed to the shared folder, so a lost executor costs one round at most.
    """
    ordered = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = cut(ordered.where("u <> v").distinct())
    mark = fingerprint(now)
    for _ in range(MOST_ROUNDS):
        now = cut(star(star(now, True), False))
        was, mark = mark, fingerprint(now)
        if mark == was:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError("components did not settle")


def fingerprint(links: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(links.agg(F.count("*"), F.sum(mixed)).first())
