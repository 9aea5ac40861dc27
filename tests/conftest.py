from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tickwell.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("TICKWELL_SHUFFLE", "4")
    session = local_session("tests", 8)
    yield session
    session.stop()


@pytest.fixture
def sliced(spark):
    """Ordered inputs are cut into many slices and blocks; nothing is broadcast by hint."""
    spark.conf.set("spark.tickwell.slices", "24")
    spark.conf.set("spark.tickwell.blockRows", "40")
    spark.conf.set("spark.tickwell.broadcastRows", "0")
    yield spark
    spark.conf.unset("spark.tickwell.slices")
    spark.conf.unset("spark.tickwell.blockRows")
    spark.conf.unset("spark.tickwell.broadcastRows")


@pytest.fixture
def price_frame(spark):
    """(symbol, time in seconds, price) triples as a price history."""

    def make(rows):
        listed = [(i, s, t, p) for i, (s, t, p) in enumerate(rows)]
        frame = spark.createDataFrame(
            listed, "event_id bigint, symbol string, seconds bigint, current_price double"
        )
        return frame.selectExpr(
            "event_id",
            "symbol",
            "cast(timestamp_seconds(seconds) as timestamp_ntz) as event_time",
            "current_price",
        )

    return make
