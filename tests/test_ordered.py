"""Ordered operators against plain Python, with hot keys, tied times and tiny slices."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickwell.operators.ordered import blocks, ordered


def skewed(seed: int, size: int = 500):
    """One symbol holds most rows, and a third of all rows share one time."""
    draw = random.Random(seed)
    rows = []
    for _ in range(size):
        symbol = draw.choices(["hot", "b", "c"], [8, 1, 1])[0]
        time = 50 if draw.random() < 0.34 else draw.randrange(100)
        rows.append((symbol, time, float(draw.randrange(1, 1000))))
    return rows


def by_symbol(rows):
    groups = {}
    for i, (symbol, time, price) in enumerate(rows):
        groups.setdefault(symbol, []).append((time, i, price))
    return {s: sorted(g) for s, g in groups.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_lag_positions_and_running_max(sliced, price_frame, seed):
    rows = skewed(seed)
    series = ordered(price_frame(rows), "symbol", ("event_time", "event_id"))
    assert series.frame.select("slice").distinct().count() > 5
    largest = series.frame.groupBy("slice").count().agg(F.max("count")).first()[0]
    assert largest < 200
    done = series.lag("current_price", "before").positions().running_max("current_price", "peak")
    got = {
        r["event_id"]: (r["before"], r["position"], r["size"], r["peak"])
        for r in done.frame.collect()
    }
    want = {}
    for group in by_symbol(rows).values():
        peak = 0.0
        for n, (_, i, price) in enumerate(group):
            peak = max(peak, price)
            want[i] = (group[n - 1][2] if n else None, n + 1, len(group), peak)
    assert got == want


@pytest.mark.parametrize("size,reach", [(10, 3), (3, 10), (50, 49)])
def test_blocks_hold_a_whole_frame(spark, size, reach):
    rows = spark.range(1, 201).select(F.lit("a").alias("symbol"), F.col("id").alias("position"))
    frame = Window.partitionBy("block").orderBy("position").rowsBetween(-reach, -1)
    counted = (
        blocks(rows, "symbol", "position", reach, size)
        .withColumn("seen", F.count("*").over(frame))
        .where("not context")
    )
    got = {r["position"]: r["seen"] for r in counted.collect()}
    assert got == {n: min(n - 1, reach) for n in range(1, 201)}
    biggest = blocks(rows, "symbol", "position", reach, size).groupBy("block").count()
    assert biggest.agg(F.max("count")).first()[0] <= max(size, reach) + reach


def test_few_rows_and_none_take_the_same_way(spark, price_frame):
    rows = skewed(3, 20)
    for frame, size in ((price_frame(rows), 20), (price_frame(rows).where("false"), 0)):
        series = ordered(frame, "symbol", ("event_time", "event_id"))
        assert series.part == ["symbol", "slice"]
        done = series.lag("current_price", "before").positions().frame.collect()
        assert len(done) == size
        firsts = [r for r in done if r["position"] == 1]
        assert all(r["before"] is None for r in firsts)
        assert sum(r["before"] is None for r in done) == len(firsts)


@pytest.mark.parametrize("how", ["sliced", "whole"])
def test_lead_and_tiles_equal_plain_windows(spark, request, how):
    if how == "sliced":
        request.getfixturevalue("sliced")
    rows = [(s, t, None if t % 7 == 0 else float(t * t % 11)) for s, n in (("A", 211), ("B", 3), ("C", 1)) for t in range(n)]
    frame = spark.createDataFrame(rows, "symbol string, t int, v double").repartition(5)
    got = ordered(frame, "symbol", ("t",)).lead({"next_v": "v", "next_t": "t"})
    for count in (1, 4, 7):
        got = got.tiles(count, f"fold_{count}")
    plain = Window.partitionBy("symbol").orderBy("t")
    want = frame.withColumns(
        {"next_v": F.lead("v").over(plain), "next_t": F.lead("t").over(plain)}
        | {f"fold_{n}": F.ntile(n).over(plain) for n in (1, 4, 7)}
    )
    found = got.drop_slices().select(*want.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect())) and found.count() == 215
