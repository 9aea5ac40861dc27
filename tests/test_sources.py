"""History files, defaults, caps, log triage and shared-folder settings."""

from __future__ import annotations

import os
import subprocess
import sys
from datetime import datetime

import pytest
from conftest import ROOT
from pyspark.sql import functions as F

from tickwell.config import Universe
from tickwell.functions import logs
from tickwell.operators import correlation, portfolio
from tickwell.sources import durable, history, registry, reports, tables, topics

AB = Universe(("A", "B"), "A")
DAY = 86400


@pytest.fixture
def rows(price_frame):
    return price_frame([("A", d * DAY, float(d + 1)) for d in range(10)] + [("X", 0, 1.0), ("B", 5 * DAY, 2.0)])


def test_history_by_date(spark, rows, tmp_path):
    history.write_history(rows, str(tmp_path / "h"))
    got = history.read_history(spark, str(tmp_path / "h"), datetime(1970, 1, 9), 3, AB)
    assert sorted(r["event_id"] for r in got.collect()) == [5, 6, 7, 8, 11]
    assert {"percent_change", "volatility_score", "price_range_pct"} <= set(got.columns)
    plan = got._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_history_from_json(spark, rows, tmp_path):
    history.write_history(rows, str(tmp_path / "j"), fmt="json")
    got = history.read_history(spark, str(tmp_path / "j"), datetime(1970, 1, 9), 3, AB, fmt="json")
    assert got.count() == 5


def test_range_ends_are_included(rows):
    got = history.time_range(rows, datetime(1970, 1, 4), 2, AB)
    assert sorted(r["event_id"] for r in got.collect()) == [1, 2, 3]


def test_defaults_only_for_absent_columns(rows):
    frame = rows.withColumn("percent_change", F.lit(None).cast("double"))
    row = history.with_defaults(frame).first()
    assert row["percent_change"] is None and row["volatility_score"] == 0.0


def test_doubled_range(spark):
    assert [tuple(r) for r in topics.doubled_range(spark, 3).collect()] == [(0, 0), (1, 2), (2, 4)]


def test_log_triage(spark):
    text = ["Starting pipeline", "Polling ERROR", "a RESPONSE came", "symbol WARN", "kafka up",
            "an ERROR", "a WARN", "nothing", "ERROR again and again"]
    lines = spark.createDataFrame(list(enumerate(text)), "line_no int, line string")
    counts = logs.pattern_counts(lines).first().asDict()
    assert (counts["errors"], counts["warnings"], counts["polling"], counts["response"]) == (3, 2, 1, 1)
    classes = {r["line_class"]: r["lines"] for r in logs.class_counts(lines).collect()}
    assert classes == {"pipeline_started": 1, "polling": 1, "data_received": 1, "kafka": 1,
                       "error": 2, "warning": 1, "other": 2}
    last = logs.last_matching(lines, "ERROR", 2, ("line_no",), 1, 8).collect()
    assert [(r["line_no"], r["line"]) for r in last] == [(8, "ERROR ag"), (5, "an ERROR")]


def test_broadcast_only_when_small(spark):
    small = durable.broadcast_if_small(spark.range(10), 10)
    large = durable.broadcast_if_small(spark.range(11), 10)
    assert "broadcast" in small._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in large._jdf.queryExecution().logical().toString().lower()


class Session:
    """Stands in for a session, which takes this setting only when it starts."""

    def __init__(self, master, configured=None):
        self.settings, self.master, self.folder = {"spark.checkpoint.dir": configured}, master, None
        self.conf = self.sparkContext = self

    def get(self, key, default):
        return self.settings[key] or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_comes_from_the_session():
    assert durable.scratch(Session("yarn", "s3://b/c/"), "x").startswith("s3://b/c/x-")
    local = Session("local[2]")
    assert durable.shared_dir(local) == local.folder == durable.shared_dir(local)
    with pytest.raises(ValueError):
        durable.shared_dir(Session("yarn"))


def test_drawdown_and_stress(spark, price_frame):
    prices = price_frame([("A", 1, 100.0), ("A", 2, 80.0), ("A", 3, 120.0), ("A", 4, 90.0)])
    assert portfolio.max_drawdown(prices).first()["max_drawdown"] == -0.25
    held = spark.createDataFrame([(1, "A", 2.0)], "account bigint, symbol string, quantity double")
    assert portfolio.portfolio_value(held, prices).first()["value"] == 180.0
    shocks = spark.createDataFrame([("down", "A", -0.5)], "scenario string, symbol string, shock double")
    row = portfolio.stress_test(held, prices, shocks).first()
    assert (row["stressed_value"], row["loss"]) == (90.0, -90.0)
    held = spark.createDataFrame(
        [(1, "A", 2.0), (1, "B", 5.0)], "account bigint, symbol string, quantity double"
    )
    other = spark.createDataFrame([("up", "C", 0.5)], shocks.schema)
    row = portfolio.stress_test(held, prices, other).first()
    assert (row["value"], row["stressed_value"], row["unpriced"]) == (180.0, 180.0, 1)
    # Repeated shocks add up; a scenario without a name is none.
    twice = spark.createDataFrame([("x", "A", -0.1), ("x", "A", -0.2), (None, "A", -0.9), ("y", "A", 0.5)], shocks.schema)
    rows = {r["scenario"]: r["stressed_value"] for r in portfolio.stress_test(held, prices, twice).collect()}
    assert rows == {"x": 126.0, "y": 270.0}


def test_matrix_leaves_out_times_of_unlisted_symbols(spark, monkeypatch):
    rows = spark.createDataFrame(
        [("A", 1, 1.0), ("B", 1, 2.0), ("A", 2, 2.0), ("B", 2, 1.0), ("A", 3, 5.0), ("C", 4, 9.0)],
        "symbol string, t bigint, v double",
    )
    narrow = correlation.correlation(rows, "t", "v", ["A", "B"]).collect()
    monkeypatch.setattr(correlation, "EXPRESSION_SYMBOLS", 1)
    assert sorted(narrow) == sorted(correlation.correlation(rows, "t", "v", ["A", "B"]).collect())


def test_no_version_before_the_first_training(spark, tmp_path):
    assert registry.latest_version(spark, str(tmp_path)) is None


def test_stream_reads_a_folder_of_files(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    stream = tables.event_stream(spark, str(tmp_path))
    query = stream.writeStream.format("memory").queryName("folder_events").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("folder_events").count() == events.count()


def test_workers_find_the_package_from_any_folder(tmp_path):
    code = (
        "import sys; sys.path.insert(0, %r); import __spark_entry__ as e; "
        "from tickwell.session import local_session; s = local_session('far', 2); "
        "print('ROWS', e.queries()['anomaly_counts'](s, '/root/testdata/sf0.001').count())" % ROOT
    )
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, capture_output=True, text=True)
    assert "ROWS 3" in ran.stdout, ran.stderr[-2000:]


def test_limit_alerts(spark):
    metrics = spark.createDataFrame([("A", 5.0, 1.0, 20)], "symbol string, var_95 double, volatility double, data_points bigint")
    limits = spark.createDataFrame(
        [("var_95", "A", ">", 4.0), ("var_95", "A", ">", 5.0), ("volatility", "A", "<", 2.0)],
        "metric string, symbol string, op string, threshold double",
    )
    got = {(r["metric"], r["threshold"]) for r in portfolio.limit_alerts(metrics, limits).collect()}
    assert got == {("var_95", 4.0), ("volatility", 2.0)}


def test_a_filed_report_replaces_only_itself(spark, tmp_path):
    shape = (
        "metrics map<string,struct<var:struct<var_95:double>,tracking_error:double,statistics:struct<data_points:bigint>>>, "
        "correlation_matrix map<string,map<string,double>>, document_id string, month string"
    )

    def document(name, month, value):
        return spark.createDataFrame([({"A": ((value,), None, (12,))}, {"A": {"A": 1.0, "B": None}}, name, month)], shape)

    path = str(tmp_path / "reports")
    for one in (document("x", "2024-01", 1.0), document("y", "2024-01", 2.0), document("x", "2024-02", 3.0), document("x", "2024-01", 4.0)):
        reports.put_report(one, path)
    found = reports.read_reports(spark, path, document("x", "2024-01", 0.0).schema)
    assert found.count() == 3
    rows = sorted((r.month, r.document_id, r["name"], r.value) for r in reports.report_figures(found).collect())
    assert [r for r in rows if r[2] == "var_95"] == [("2024-01", "x", "var_95", 4.0), ("2024-01", "y", "var_95", 2.0), ("2024-02", "x", "var_95", 3.0)]
    assert {r[2] for r in rows} == {"var_95", "data_points", "corr_A"}


def test_a_report_of_no_symbols(spark, tmp_path):
    shape = "metrics map<string,struct<var:struct<v:double>,tracking_error:double,statistics:struct<n:bigint>>>, correlation_matrix map<string,map<string,double>>, document_id string, month string"
    empty = spark.createDataFrame([({}, {}, "x", "2024-01")], shape)
    reports.put_report(empty, str(tmp_path / "r"))
    found = reports.read_reports(spark, str(tmp_path / "r"), empty.schema)
    assert found.count() == 1 and reports.report_figures(found).count() == 0
