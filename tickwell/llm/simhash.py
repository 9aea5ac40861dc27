"""SimHash near-duplicates by vantage-point trees.

Distinct fingerprints are cut into blocks of bits; two that differ in at most `radius` bits differ in
at most `radius // blocks` bits of some block. For each block a vantage-point tree, built from a
bounded sample, deals the fingerprints to shards by their Hamming distance from vantage points. A
fingerprint lives in one shard of each tree and also visits the shards that its triangle bounds
cannot rule out. Inside a shard a second tree over all 64 bits finds the exact pairs, and only a
spanning forest of the links leaves the shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.llm.common import cut, free_name, table, text_of
from tickwell.llm.components import components
from tickwell.shipping import ship

RADIUS = 3
BLOCKS = 4
BITS = 64
SHINGLE = 3
SEED = 42
#: Distinct fingerprints a tree is built from at most, and that a shard should hold.
SAMPLE = 16_384
SHARD = 1_024
#: A larger shard is dealt to tiles of that many fingerprints by that many.
TILE = 8_192
#: Rows and columns of one distance matrix.
LEAF = 512


def fingerprint(text: str) -> int:
    """Majority bits of the hashes of all shingles, as a signed 64-bit number; no words give zero."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)), strict=False)))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, len(shingles))
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, into: str, column: str = "text") -> DataFrame:
    """Adds the fingerprint of each whole text as a long; null and empty texts get zero."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fingerprint(t.as_py() or "") for t in texts], pa.int64())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(into, F.arrow_udf(run, "bigint")(text_of(column)))


def masks(blocks: int) -> list[int]:
    edges = [round(k * BITS / blocks) for k in range(blocks + 1)]
    return [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:], strict=False)]


def apart(left: np.ndarray, right: np.ndarray | np.uint64, mask: int = (1 << BITS) - 1) -> np.ndarray:
    return np.bitwise_count((left ^ right) & np.uint64(mask)).astype(np.int16)


@dataclass(frozen=True)
class Node:
    """A vantage point and the distance that splits the rest, or a numbered leaf."""

    vantage: int = 0
    split: int = 0
    near: Node | None = None
    far: Node | None = None
    leaf: int = -1


def plant(sample: np.ndarray, mask: int, leaves: int) -> tuple[Node, int]:
    """A tree over the masked sample with about `leaves` leaves; returns it and their number."""
    count = 0

    def build(points: np.ndarray, wanted: float) -> Node:
        nonlocal count
        if wanted >= 2 and len(points) > 1:
            # The vantage point is the one of a few whose distances spread the points most evenly.
            best = None
            for v in points[:: max(1, len(points) // 8)][:8]:
                far = apart(points, v, mask)
                cut_at = int(np.sort(far)[(len(far) - 1) // 2])
                inside = int((far <= cut_at).sum())
                if inside == len(points):
                    cut_at -= 1
                    inside = int((far <= cut_at).sum())
                share = abs(2 * inside - len(points))
                if 0 < inside < len(points) and (best is None or share < best[0]):
                    best = (share, int(v), cut_at, far <= cut_at)
            if best is not None:
                _, v, cut_at, side = best
                part = wanted * side.mean()
                near, far_side = build(points[side], part), build(points[~side], wanted - part)
                return Node(v, cut_at, near, far_side)
        count += 1
        return Node(leaf=count - 1)

    return build(sample, leaves), count


def deal(root: Node, prints: np.ndarray, mask: int, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each leaf reached: its number, places of the fingerprints there, and which live there."""
    stack = [(root, np.arange(len(prints)), np.ones(len(prints), bool))]
    while stack:
        node, at, home = stack.pop()
        if not len(at):
            continue
        if node.leaf >= 0:
            yield node.leaf, at, home
            continue
        far = apart(prints[at], np.uint64(node.vantage), mask)
        near = far <= node.split
        visit_near, visit_far = far - reach <= node.split, far + reach > node.split
        stack.append((node.near, at[visit_near], (home & near)[visit_near]))
        stack.append((node.far, at[visit_far], (home & ~near)[visit_far]))


class Forest:
    """Union-find over array places, kept as smallest-label arrays."""

    def __init__(self, size: int) -> None:
        self.label = np.arange(size)

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        while len(left):
            a, b = self.label[left], self.label[right]
            open_ = a != b
            if not open_.any():
                return
            left, right, a, b = left[open_], right[open_], a[open_], b[open_]
            low = np.minimum(a, b)
            np.minimum.at(self.label, a, low)
            np.minimum.at(self.label, b, low)
            self.flatten()

    def flatten(self) -> None:
        while True:
            up = self.label[self.label]
            if np.array_equal(up, self.label):
                return
            self.label = up


def link(prints: np.ndarray, homes: np.ndarray, guests: np.ndarray, radius: int, forest: Forest) -> None:
    """Joins every home with every guest within the radius.

    Homes are split by their distance from a vantage point; a guest goes to each side that the
    triangle bound leaves open. Pairs that are already in one group are not looked at.
    """
    stack = [(homes, guests)]
    while stack:
        h, g = stack.pop()
        if not len(h) or not len(g):
            continue
        first = forest.label[h[0]]
        if (forest.label[h] == first).all() and (forest.label[g] == first).all():
            continue
        if len(h) > LEAF:
            vantage = prints[h[len(h) // 2]]
            far_h = apart(prints[h], vantage)
            split = int(np.partition(far_h, len(h) // 2)[len(h) // 2])
            near = far_h <= split
            if near.all():
                split -= 1
                near = far_h <= split
            if near.any():
                far_g = apart(prints[g], vantage)
                stack.append((h[near], g[far_g - radius <= split]))
                stack.append((h[~near], g[far_g + radius > split]))
            else:
                half = len(h) // 2
                stack += [(h[:half], g), (h[half:], g)]
            continue
        for at in range(0, len(g), LEAF):
            part = g[at : at + LEAF]
            close = apart(prints[h][:, None], prints[part][None, :]) <= radius
            a, b = np.nonzero(close)
            forest.join(h[a], part[b])


def spanning(homes: np.ndarray, guests: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever the full set of home-guest pairs connects."""
    prints, place = np.unique(np.concatenate((homes, guests)), return_inverse=True)
    forest = Forest(len(prints))
    link(prints, np.unique(place[: len(homes)]), np.unique(place[len(homes) :]), radius, forest)
    moved = np.flatnonzero(forest.label != np.arange(len(prints)))
    return prints[moved], prints[forest.label[moved]]


def shard_rows(prints: DataFrame, trees: list[tuple[Node, int]], blocks: int, radius: int, tiles: dict[int, int]) -> DataFrame:
    """(cell, print, home): fingerprints in the shards, and tiles of shards, that they live in or visit."""
    marks, base = masks(blocks), np.cumsum([0, *(n for _, n in trees)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k, (root, _) in enumerate(trees):
                for leaf, at, home in deal(root, values, marks[k], radius // blocks):
                    shard = int(base[k]) + leaf
                    parts = tiles.get(shard, 1)
                    for row in placed(shard, values[at], home, parts):
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, row)), ["cell", "print", "home"])

    return prints.select("print").mapInArrow(run, "cell string, print bigint, home boolean")


def placed(shard: int, prints: np.ndarray, home: np.ndarray, parts: int) -> Iterator[tuple]:
    """Rows of one shard; of a split one, each home meets each guest in exactly one tile."""
    if parts == 1:
        yield np.full(len(prints), str(shard)), prints.view(np.int64), home
        return
    group = (prints * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(parts)
    for part in range(parts):
        mine = group == part
        for other in range(parts):
            pairs = ((mine & home, f"{shard}/{part}/{other}", True), (mine, f"{shard}/{other}/{part}", False))
            for chosen, cell, role in pairs:
                some = prints[chosen].view(np.int64)
                if len(some):
                    yield np.full(len(some), cell), some, np.full(len(some), role)


def links(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, shard: int = SHARD, tile: int = TILE, sample: int = SAMPLE) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints of `prints` that are linked at `radius`.

    `prints` has one row for each distinct fingerprint. A pair that differs in no more bits is always
    found; nothing is capped. The trees hold at most `sample` nodes, so they and the table of shard
    sizes are small whatever the input. A shard beyond `tile` fingerprints is cut into tiles, each a
    task's work of its own.
    """
    ship(prints.sparkSession)
    total = prints.count()
    chosen = prints.orderBy(F.xxhash64("print"), "print").limit(sample).toPandas()["print"]
    points = chosen.to_numpy(np.int64).view(np.uint64)
    wanted = max(1, min(sample // 4, -(-total // shard)))
    trees = [plant(points, mask, wanted) for mask in masks(blocks)]
    sizes = shard_rows(prints, trees, blocks, radius, {}).groupBy("cell").count()
    tiles = {int(r["cell"]): -(-r["count"] // tile) for r in sizes.where(F.col("count") > tile).collect()}

    def run(cell: pa.Table) -> pa.Table:
        values = cell.column("print").to_numpy().view(np.uint64)
        home = cell.column("home").to_numpy()
        # In a whole shard the homes are guests too; in a tile the two roles are rows of their own.
        split = "/" in cell.column("cell")[0].as_py()
        a, b = spanning(values[home], values[~home] if split else values, radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    cells = shard_rows(prints, trees, blocks, radius, tiles)
    return cells.groupBy("cell").applyInArrow(run, "a bigint, b bigint")


def rooted(docs: DataFrame, radius: int) -> DataFrame:
    """(doc_id, print, mark, size, root, component_id) of every row of `docs`.

    `root` names the component, also where none of its rows has an id; `mark` and `size` tell texts apart.
    """
    texts = docs.select("doc_id", text_of().alias("text"))
    marked = texts.withColumns({"mark": F.xxhash64("text"), "size": F.length("text")})
    rows = cut(with_fingerprint(marked, "print").drop("text"))
    prints = cut(rows.groupBy("print").agg(F.min("doc_id").alias("least")))
    roots = cut(components(links(prints.select("print"), radius)).withColumnRenamed("node", "print"))
    found = prints.join(roots, "print", "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    lowest = found.groupBy("root").agg(F.min("least").alias("component_id"))
    named = found.join(lowest, "root").select("print", "root", "component_id")
    return rows.join(named, "print")


def near_groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, print, component_id) of every row of `docs`.

    `component_id` is the smallest doc_id reachable over links; a null doc_id counts only where there
    is no other. Documents without words have fingerprint zero and are linked like any other. Repeated
    rows come back as often as they came. Exact copies share one fingerprint and meet only as one.
    """
    return rooted(docs, radius).select("doc_id", "print", "component_id")


def one_of_each(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One document of each group of near-duplicates, with the columns it came with.

    It is the one with the smallest doc_id, rows without an id last; of several texts with that doc_id
    the first by hash. Rows that share a doc_id but not a group are documents of their own, so each
    group keeps one. Of rows that agree in id and text one stays, whatever their other columns say. An
    empty table stays empty.
    """
    # Narrow rows only: how often each document occurs, and the first document of each group.
    each = rooted(docs, radius).groupBy("root", "doc_id", "mark", "size").agg(F.count("*").alias("times"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "size", "times")
    first = cut(each.groupBy("root").agg(F.min(rank).alias("first")).select("first.*"))
    mark, size, kept = (free_name(docs, n) for n in ("mark_", "size_", "kept_"))
    marked = docs.withColumns({mark: F.xxhash64(text_of()), size: F.length(text_of())})

    def chosen(wanted: Column) -> DataFrame:
        some = first.where(wanted).select(F.struct("doc_id", "mark", "size").alias(kept))
        same = marked["doc_id"].eqNullSafe(F.col(f"{kept}.doc_id"))
        same = same & (marked[mark] == F.col(f"{kept}.mark")) & (marked[size] == F.col(f"{kept}.size"))
        return marked.join(some.hint("shuffle_hash"), same, "left_semi")

    # Documents that occur once need no more than the join; of the others the copies are folded before
    # they move, so a document that a third of all rows repeat is no task's whole work.
    once = chosen(F.col("times") == 1)
    several = chosen(F.col("times") > 1).dropDuplicates(["doc_id", mark, size])
    return once.union(several).drop(mark, size)


def op10(spark, sf_dir: str) -> DataFrame:
    found = near_groups(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
