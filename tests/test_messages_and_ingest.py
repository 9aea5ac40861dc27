"""Message checks and ingest on the edge cases."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickwell.config import ETF
from tickwell.operators import quality
from tickwell.plans import ingest

GOOD = {
    "symbol": "SPY", "current_price": 47.3, "change": -0.7, "percent_change": -1.46,
    "high": 49, "low": 46.8, "open": 48.0, "timestamp": "2024-05-06T07:08:09",
    "data_source": "test",
}


def changed(**fields):
    return {k: v for k, v in {**GOOD, **fields}.items() if v is not ...}


@pytest.fixture
def topic(spark):
    def make(messages):
        rows = [
            (None, (m if isinstance(m, str) else json.dumps(m)).encode(), "t", 0, i, datetime(2024, 1, 1))
            for i, m in enumerate(messages)
        ]
        return spark.createDataFrame(
            rows,
            "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp",
        )

    return make


CASES = [
    (GOOD, []),
    ("{bad", ["malformed JSON"]),
    ("[1, 2]", ["malformed JSON"]),
    (changed(current_price="12.5"), ["field current_price: type string, expected number"]),
    (changed(current_price=0), ["price not positive: 0.0"]),
    (changed(current_price=-1.5), ["price not positive: -1.5"]),
    (changed(current_price=True), ["field current_price: type boolean, expected number"]),
    (changed(symbol="TEST"), ["symbol not recognised: TEST"]),
    (changed(timestamp="01/02/2024"), ["timestamp not ISO: 01/02/2024"]),
    (changed(data_source=...), ["missing field: data_source"]),
    (changed(high=None), ["field high: type null, expected number"]),
    (changed(low={"a": 1}, open=[1]), ["field low: type object, expected number",
                                      "field open: type array, expected number"]),
]


def test_issues(topic):
    checks = quality.check_messages(topic([c for c, _ in CASES]), ETF.symbols)
    rows = checks.orderBy("offset").collect()
    for row, (_, issues) in zip(rows, CASES):
        assert row["issues"] == issues
        assert row["is_valid"] == (not issues)
    assert rows[0]["valid_fields"] == 9 and rows[0]["total_expected"] == 9
    assert rows[0]["size_chars"] == len(json.dumps(GOOD))
    assert rows[1]["valid_fields"] is None and rows[1]["size_chars"] is None


def test_parse_drops_what_the_schema_does_not_fit(topic):
    rows = quality.parse_quotes(topic([GOOD, "{bad", changed(current_price="12.5")])).collect()
    assert [r["current_price"] for r in rows] == [47.3, None, None]
    rate = quality.parse_rate(quality.parse_quotes(topic([GOOD, "{bad"]))).first()
    assert tuple(rate) == (2, 1, 50.0)


@pytest.mark.parametrize(
    "valid,total,tier",
    [(90, 100, "excellent"), (899, 1000, "good"), (70, 100, "good"), (699, 1000, "problematic")],
)
def test_tiers(topic, valid, total, tier):
    messages = [GOOD] * valid + [changed(symbol="X")] * (total - valid)
    frame = topic(messages)
    row = quality.compatibility(frame, quality.check_messages(frame, ETF.symbols)).first()
    assert (row["tier"], row["compatible"]) == (tier, True)


def test_incompatible_topic_is_at_most_good(topic):
    frame = topic([GOOD] * 9 + [changed(change="x")])
    row = quality.compatibility(frame, quality.check_messages(frame, ETF.symbols)).first()
    assert row["type_issues"] == 1 and row["tier"] == "good"
    frame = topic([changed(change="x")] + [GOOD] * 9)
    row = quality.compatibility(frame, quality.check_messages(frame, ETF.symbols)).first()
    assert row["type_issues"] == 1 and row["tier"] == "good"


def test_empty_topic(topic):
    frame = topic([])
    summary = quality.summarise(quality.check_messages(frame, ETF.symbols)).first()
    assert tuple(summary) == (0, 0, 0, 0.0, 0.0)
    row = quality.compatibility(frame, quality.check_messages(frame, ETF.symbols)).first()
    assert row["compatible"] is False and row["tier"] == "problematic"


def test_schema_consistency(topic):
    few = quality.schema_consistency(topic([{"a": 1, "b": 1}, {"a": 1, "b": 2}])).first()
    assert few["issues"] == ["too few common fields"]
    wide = quality.schema_consistency(
        topic([changed(x=1, y=1), changed(z=1), GOOD, "{bad"])
    ).first()
    assert (wide["common_fields"], wide["other_fields"]) == (9, 3)
    assert wide["issues"] == ["inconsistent schema"]


def test_summary_and_top_issues(topic):
    frame = topic([GOOD, "{bad", "{bad", changed(symbol="X"), changed(symbol="Y"), changed(symbol="Y")])
    checks = quality.check_messages(frame, ETF.symbols)
    row = quality.summarise(checks).first()
    assert (row["total_messages"], row["valid_messages"], row["validity_rate"]) == (6, 1, 16.6667)
    top = [(r["issue"], r["occurrences"]) for r in quality.top_issues(checks, 2).collect()]
    assert top == [("malformed JSON", 2), ("symbol not recognised: Y", 2)]


@pytest.mark.parametrize("tail,expected", [([GOOD], 3), (["{bad", "{bad", GOOD, GOOD], 5), (["{bad"], 3)])
def test_first_messages_read_on_to_a_parsed_one(topic, tail, expected):
    frame = topic([GOOD, "{bad", *tail])
    assert quality.first_messages(frame, 3).count() == expected


def test_presence_counts_null_and_false_as_missing(topic):
    frame = topic([GOOD, changed(symbol=None), changed(symbol=False), changed(symbol=...), changed(symbol=True)])
    rows = {r["field"]: r for r in quality.field_presence(frame).collect()}
    assert (rows["symbol"]["present"], rows["symbol"]["missing"]) == (2, 3)
    assert rows["symbol"]["required"] and not rows["change"]["required"]
    assert rows["previous_close"]["present"] == 0


def test_structure_and_types(topic):
    assert tuple(quality.valid_structure(topic([GOOD])).first()) == (True, True)
    assert tuple(quality.valid_structure(topic([GOOD, "{bad"])).first()) == (False, False)
    assert tuple(quality.valid_structure(topic([GOOD, changed(current_price=None)])).first()) == (True, False)
    kinds = {
        (r["field"], r["kind"]): r["messages"]
        for r in quality.field_types(topic([GOOD, changed(high=None)])).collect()
    }
    assert kinds[("high", "number")] == 1 and kinds[("high", "null")] == 1
    assert kinds[("symbol", "string")] == 2


def test_topic_size_and_text(topic):
    frame = topic([GOOD, '{"symbol":"QQQ","current_price":12.5}'])
    assert tuple(quality.topic_size(frame).first()) == (1, 2)
    row = quality.text_extract(frame).orderBy("offset").collect()[1]
    assert (row["symbol"], row["current_price"], row["timestamp"]) == ("QQQ", "12.5", "N/A")


# --- ingest -------------------------------------------------------------------------------


def body(**fields):
    return json.dumps({"c": 10.0, "d": 1.0, "dp": 2.0, "h": 12.0, "l": 9.0, "o": 10.0, "pc": 9.0, **fields})


@pytest.fixture
def normalised(spark):
    def make(rows):
        raw = spark.createDataFrame(
            [(i, m, b, datetime(2024, 1, 1, 0, 0, i)) for i, (m, b) in enumerate(rows)],
            "n int, metadata struct<name string, url string>, body string, received_at timestamp",
        )
        return ingest.normalise(raw, ETF)

    return make


RESOLVED = [
    ((("spy_quote", None), body()), "SPY", "metadata_name", None),
    ((("x", "http://a/?symbol=QQQ"), body()), "QQQ", "url_extraction", "unknown_request_name: x"),
    (((None, "http://a/?symbol=IWM"), body()), "IWM", "url_extraction", "no_metadata_or_name"),
    ((("x", "http://a/IWM"), body()), "IWM", "pattern_matching", "url_no_symbol_found: http://a/IWM"),
    ((("x", None), body(note="IWM or QQQ")), "QQQ", "pattern_matching", "no_url_in_metadata"),
    ((None, body(note="SPY")), "SPY", "pattern_matching", None),
    ((None, body()), None, None, "no_symbol_pattern_found"),
    ((("x", "u"), body()), None, None, "no_symbol_pattern_found"),
]


def test_symbol_resolution(normalised):
    rows = normalised([r for r, *_ in RESOLVED]).orderBy("n").collect()
    for row, (_, symbol, source, error) in zip(rows, RESOLVED):
        assert (row["symbol"], row["debug_source"], row["debug_error"]) == (symbol, source, error)


def test_rejection_reasons(normalised):
    spy, nobody = ("spy_quote", None), ("x", "u")
    frame = normalised(
        [(spy, body(c=0)), (spy, body(c=None)), (nobody, body()), (nobody, body(c=0)), (spy, body(c="7.5"))]
    )
    got = [r["error_type"] for r in frame.orderBy("n").collect()]
    assert got == [
        ["no_price_data"], ["no_price_data"], ["no_symbol"], ["no_symbol", "no_price_data"], [],
    ]
    assert ingest.accepted(frame).count() + ingest.rejected(frame).count() == 5
    assert ingest.rejected(frame).select(F.explode("tags")).distinct().first()[0] == "debug_failed"


def test_derived_fields(normalised):
    spy = ("spy_quote", None)
    rows = ingest.accepted(normalised([(spy, body()), (spy, body(l=0)), (spy, body(o=None))])).orderBy("n").collect()
    assert (rows[0]["intraday_range"], rows[0]["intraday_volatility"]) == (3.0, 30.0)
    assert rows[1]["intraday_range"] is None and rows[2]["intraday_volatility"] is None
    assert rows[0]["doc_id"] == "SPY_1704067200"
    assert rows[0]["timestamp"] == "2024-01-01T00:00:00"
    assert (rows[0]["current_price"], rows[0]["previous_close"]) == (10.0, 9.0)
    assert rows[0]["tags"] == ["has_symbol", "processed", "valid_quote"]
