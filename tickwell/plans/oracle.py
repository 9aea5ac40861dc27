"""The registered queries as plain SQL over the same tables, for side-by-side checks."""

from __future__ import annotations

from tickwell.plans.catalog import LIMITS, SHOCKS, WEIGHTS

S = "('view', 'click', 'purchase')"
NUMBERS = ("current_price", "change", "percent_change", "high", "low", "open")
STRINGS = ("symbol", "timestamp", "data_source")
CONTRACT = ("symbol", *NUMBERS, "timestamp", "data_source")


def with_(*parts: str, body: str) -> str:
    """`body` may open with a comma to add further named queries before its own select."""
    return "WITH " + ",\n".join(parts) + "\n" + body


def money(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,2)) AS VARCHAR)"


QUOTES = """
spread AS (
  SELECT event_id, ts AS event_time, event_type AS symbol, value AS current_price,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         CAST(round(value * 100) AS BIGINT) AS price_c
  FROM events),
cents AS (SELECT *, price_c + k - 50 AS open_c, price_c - k + 50 AS previous_c FROM spread),
quotes AS (
  SELECT event_id, event_time, symbol, current_price, k,
         (price_c - previous_c) / 100.0::DOUBLE AS change,
         ((price_c - previous_c) / 100.0::DOUBLE)
           / nullif(previous_c / 100.0::DOUBLE, 0) * 100 AS percent_change,
         (greatest(price_c, open_c) + k) / 100.0::DOUBLE AS high,
         (least(price_c, open_c) - k) / 100.0::DOUBLE AS low,
         open_c / 100.0::DOUBLE AS open,
         previous_c / 100.0::DOUBLE AS previous_close
  FROM cents)"""
VALID = f"valid AS (SELECT * FROM quotes WHERE current_price > 0 AND symbol IN {S})"
TICKS = f"""
ticks AS (
  SELECT event_id, ts AS event_time, event_type AS symbol, value AS current_price
  FROM events WHERE value > 0 AND event_type IN {S})"""
RETURNS = TICKS + """,
changes AS (
  SELECT *, (current_price / nullif(
      lag(current_price) OVER (PARTITION BY symbol ORDER BY event_time, event_id), 0) - 1) * 100
    AS returns FROM ticks),
series AS (SELECT * FROM changes WHERE returns IS NOT NULL)"""


def features(length: str, source: str = f"{QUOTES}, {VALID}") -> str:
    """`source` ends with the named query `valid`."""
    return f"""{source},
grouped AS (
  SELECT symbol, time_bucket(INTERVAL '{length}', event_time) AS window_start,
         time_bucket(INTERVAL '{length}', event_time) + INTERVAL '{length}' AS window_end,
         avg(current_price) AS avg_price, max(current_price) AS max_price,
         min(current_price) AS min_price, stddev_samp(current_price) AS price_volatility,
         avg(percent_change) AS avg_return, count(*) AS data_points,
         max(high) AS period_high, min(low) AS period_low,
         arg_min(current_price, (event_time, event_id)) AS period_open,
         arg_max(current_price, (event_time, event_id)) AS period_close
  FROM valid GROUP BY ALL),
moved AS (
  SELECT *, (period_close - period_open) / nullif(period_open, 0) * 100 AS price_momentum
  FROM grouped),
features AS (
  SELECT *, (period_high - period_low) / nullif(avg_price, 0) * 100 AS intraday_volatility,
         (period_close - period_low) / nullif(period_high - period_low, 0) AS price_position,
         data_points AS volume_proxy,
         (period_close - avg_price) / nullif(price_volatility, 0) AS bollinger_position,
         abs(price_momentum) * data_points AS trend_strength,
         CASE WHEN price_volatility > 2.0 THEN 'high' WHEN price_volatility < 0.5 THEN 'low'
              ELSE 'normal' END AS volatility_regime,
         CASE WHEN price_momentum > 0.5 THEN 1.0::DOUBLE
              WHEN price_momentum < -0.5 THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS target_direction
  FROM moved)"""


FEATURE_DOUBLES = (
    "avg_price", "max_price", "min_price", "price_volatility", "avg_return", "period_high",
    "period_low", "period_open", "period_close", "price_momentum", "intraday_volatility",
    "price_position", "bollinger_position", "trend_strength", "target_direction",
)
FEATURE_OUT = (
    "symbol, window_start, window_end, data_points, volume_proxy, volatility_regime, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in FEATURE_DOUBLES)
)

STATISTICS = """
statistics AS (
  SELECT symbol, round(avg(returns), 4) AS mean_return,
         round(stddev_samp(returns), 4) AS volatility, round(min(returns), 4) AS min_return,
         round(max(returns), 4) AS max_return, count(*) AS data_points
  FROM series GROUP BY symbol HAVING count(*) >= 10)"""


def tails(source: str, name: str = "tails") -> str:
    def at(level: float) -> str:
        return f"least(floor((1.0::DOUBLE - {level}::DOUBLE) * size) + 1, size)"

    columns = []
    for level, tag in ((0.95, "95"), (0.99, "99")):
        columns.append(
            f"round(abs(max(CASE WHEN rank = {at(level)} THEN returns END)), 4) AS var_{tag}"
        )
        columns.append(
            f"round(abs(avg(CASE WHEN rank <= {at(level)} THEN returns END)), 4) AS cvar_{tag}"
        )
    return f"""
{name} AS (
  SELECT symbol, {', '.join(columns)}
  FROM (SELECT symbol, returns, row_number() OVER (PARTITION BY symbol ORDER BY returns) AS rank,
               count(*) OVER (PARTITION BY symbol) AS size FROM {source})
  WHERE size >= 10 GROUP BY symbol)"""


TRACKING = """
placed AS (
  SELECT symbol, returns, count(*) OVER (PARTITION BY symbol) AS size,
         row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC, event_id DESC) AS back
  FROM series),
tracking AS (
  SELECT a.symbol, count(*) AS aligned,
         CASE WHEN count(*) < 10 THEN 0.0
              ELSE round(stddev_samp(a.returns - b.returns), 4) END AS tracking_error
  FROM placed a JOIN placed b ON a.back = b.back
  WHERE b.symbol = 'view' AND a.symbol <> 'view' AND a.size >= 10 GROUP BY a.symbol)"""
METRICS = """
metrics AS (
  SELECT s.*, t.* EXCLUDE (symbol), e.tracking_error
  FROM statistics s LEFT JOIN tails t USING (symbol) LEFT JOIN tracking e USING (symbol))"""


#: A feed in three parts: an event is late where an earlier part holds one two hours newer or more.
ARRIVALS = VALID + """,
came AS (
  SELECT *, epoch_us(event_time)
            + CASE WHEN event_id % 50 = 7 THEN 300 ELSE event_id % 60 END * 60000000 AS came
  FROM valid),
parted AS (
  SELECT c.*, (c.came - e.feed_start) * 3 // e.feed_span AS part
  FROM came c, (SELECT min(came) AS feed_start, max(came) - min(came) + 1 AS feed_span FROM came) e),
newest AS (SELECT part, max(event_time) AS newest FROM parted GROUP BY part),
judged AS (
  SELECT p.*, epoch_us(event_time) <= (
      SELECT epoch_ms(max(n.newest)) * 1000 - 7200000000 FROM newest n WHERE n.part < p.part) AS late
  FROM parted p)"""


def matrix(source: str, time: str, value: str) -> str:
    columns = ", ".join(
        f"coalesce(avg(CASE WHEN symbol = '{s}' THEN {value} END), 0) AS {s}"
        for s in ("view", "click", "purchase")
    )
    return f"wide AS (SELECT {time} AS at_time, {columns} FROM {source} GROUP BY 1)"


def correlations(all_pairs: bool) -> str:
    names = ("view", "click", "purchase")
    rows = [
        f"SELECT '{a}' AS symbol_a, '{b}' AS symbol_b, round(covar_samp({a}, {b}) "
        f"/ nullif(stddev_samp({a}) * stddev_samp({b}), 0), 6) AS corr FROM wide"
        for i, a in enumerate(names)
        for j, b in enumerate(names)
        if all_pairs or i < j
    ]
    return "\nUNION ALL ".join(rows)


SCAN = f"""
scan AS (
  SELECT event_id, ts AS event_time, event_type AS symbol, value AS current_price
  FROM events WHERE ts BETWEEN TIMESTAMP '2023-12-31' AND TIMESTAMP '2024-01-30'
    AND event_type IN {S})"""

RAW = QUOTES + f""",
request AS (
  SELECT *, event_id % 6 AS rule,
         CASE event_id % 6 WHEN 0 THEN symbol || '_quote' WHEN 1 THEN 'other_quote'
              WHEN 2 THEN 'other_quote' END AS name,
         CASE WHEN event_id % 6 IN (0, 1) THEN 'https://quotes.test/q?symbol=' || symbol
              WHEN event_id % 6 IN (2, 3) THEN 'https://quotes.test/' || symbol
              WHEN event_id % 6 = 4 THEN 'https://quotes.test/' END AS url
  FROM quotes),
found AS (
  SELECT *,
         CASE name WHEN 'view_quote' THEN 'view' WHEN 'click_quote' THEN 'click'
                   WHEN 'purchase_quote' THEN 'purchase' END AS by_name,
         CASE WHEN contains(url, 'symbol=view') THEN 'view'
              WHEN contains(url, 'symbol=click') THEN 'click'
              WHEN contains(url, 'symbol=purchase') THEN 'purchase' END AS by_url,
         CASE WHEN contains(concat_ws(' ', name, url), 'view') THEN 'view'
              WHEN contains(concat_ws(' ', name, url), 'click') THEN 'click'
              WHEN contains(concat_ws(' ', name, url), 'purchase') THEN 'purchase' END AS by_text
  FROM request),
resolved AS (
  SELECT event_id, event_time, k, coalesce(by_name, by_url, by_text) AS symbol,
         CASE WHEN by_name IS NOT NULL THEN 'metadata_name'
              WHEN by_url IS NOT NULL THEN 'url_extraction'
              WHEN by_text IS NOT NULL THEN 'pattern_matching' END AS debug_source,
         CASE WHEN coalesce(by_name, by_url, by_text) IS NULL THEN 'no_symbol_pattern_found'
              WHEN rule < 5 AND by_name IS NULL AND by_url IS NULL
                THEN coalesce('url_no_symbol_found: ' || url, 'no_url_in_metadata')
              WHEN rule < 5 AND by_name IS NULL
                THEN coalesce('unknown_request_name: ' || name, 'no_metadata_or_name') END
           AS debug_error,
         CASE WHEN k = 0 THEN NULL WHEN k = 1 THEN 0.0 ELSE current_price END AS current_price,
         change, CAST(k - 50 AS DOUBLE) AS percent_change, high, low, open, previous_close
  FROM found),
judged AS (
  SELECT *, symbol IS NOT NULL AND current_price IS NOT NULL AND current_price <> 0 AS ok,
         high > 0 AND low > 0 AND open > 0 AS usable
  FROM resolved)"""

MESSAGES = QUOTES + f""",
written AS (
  SELECT event_id, symbol AS key, event_id % 40 AS fault, CAST(event_id % 3 AS INTEGER) AS part,
         event_id // 3 AS pos,
         '{{"symbol":"' || symbol || '","current_price":'
         || CASE WHEN event_id % 40 = 1 THEN '"' || {money('current_price')} || '"'
                 ELSE {money('current_price')} END
         || CASE WHEN event_id % 40 = 0 THEN '' ELSE
           ',"change":' || CASE WHEN event_id % 40 = 4 THEN 'null' ELSE {money('change')} END
           || ',"percent_change":' || CAST(k - 50 AS VARCHAR)
           || ',"high":' || CASE WHEN event_id % 40 = 5 THEN 'true' ELSE {money('high')} END
           || ',"low":' || {money('low')} || ',"open":' || {money('open')}
           || ',"previous_close":' || {money('previous_close')}
           || ',"timestamp":"' || CASE WHEN event_id % 40 = 3
                THEN strftime(event_time, '%d/%m/%Y')
                ELSE strftime(event_time, '%Y-%m-%dT%H:%M:%S') END || '"'
           || CASE WHEN event_id % 40 = 2 THEN '' ELSE ',"data_source":"feed"' END
           || '}}' END AS value
  FROM quotes),
topic AS (SELECT *, TRY_CAST(value AS JSON) AS doc FROM written)"""


def kind(name: str) -> str:
    return f"""CASE json_type(doc, '$.{name}') WHEN 'VARCHAR' THEN 'string'
      WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' WHEN 'OBJECT' THEN 'object'
      WHEN 'ARRAY' THEN 'array' WHEN 'DOUBLE' THEN 'number' WHEN 'BIGINT' THEN 'number'
      WHEN 'UBIGINT' THEN 'number' END"""


def wanted(name: str) -> str:
    return "number" if name in NUMBERS else "string"


KINDS = "kinds AS (SELECT *, " + ", ".join(f"{kind(n)} AS t_{n}" for n in CONTRACT) + " FROM topic)"
PROBLEMS = ",\n".join(
    f"CASE WHEN t_{n} IS NULL THEN 'missing field: {n}' WHEN t_{n} <> '{wanted(n)}' "
    f"THEN 'field {n}: type ' || t_{n} || ', expected {wanted(n)}' END"
    for n in CONTRACT
)
CHECKS = f"""
checks AS (
  SELECT key, part, pos, doc IS NOT NULL AS parsed,
         CASE WHEN doc IS NOT NULL THEN length(value) END AS size_chars,
         CASE WHEN doc IS NOT NULL THEN {' + '.join(
             f"(CASE WHEN t_{n} = '{wanted(n)}' THEN 1 ELSE 0 END)" for n in CONTRACT)} END
           AS valid_fields,
         CASE WHEN doc IS NOT NULL THEN 9 END AS total_expected,
         CASE WHEN doc IS NULL THEN ['malformed JSON'] ELSE list_filter([
           {PROBLEMS},
           CASE WHEN (doc->>'$.symbol') NOT IN {S}
                THEN 'symbol not recognised: ' || (doc->>'$.symbol') END,
           CASE WHEN t_current_price = 'number'
                  AND CAST(doc->>'$.current_price' AS DOUBLE) <= 0
                THEN 'price not positive: '
                  || CAST(CAST(doc->>'$.current_price' AS DOUBLE) AS VARCHAR) END,
           CASE WHEN NOT regexp_matches(doc->>'$.timestamp',
                  '^\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}')
                THEN 'timestamp not ISO: ' || (doc->>'$.timestamp') END
         ], lambda x: x IS NOT NULL) END AS issues
  FROM kinds),
verdicts AS (
  SELECT *, len(issues) = 0 AND coalesce(valid_fields, 0) >= 3 AS is_valid FROM checks)"""
CHECKED = ",\n".join([MESSAGES, KINDS, CHECKS])
SUMMARY = """
summary AS (
  SELECT count(*) AS total_messages, count(*) FILTER (is_valid) AS valid_messages,
         count(*) - count(*) FILTER (is_valid) AS invalid_messages,
         round(count(*) FILTER (is_valid) * 100.0::DOUBLE / count(*), 4) AS validity_rate,
         round(sum(coalesce(size_chars, 0))::DOUBLE / count(*), 4) AS average_size
  FROM verdicts)"""
COMMON = """
counted AS (
  SELECT field, count(*) AS messages
  FROM (SELECT unnest(json_keys(doc)) AS field FROM topic WHERE doc IS NOT NULL) GROUP BY field),
commonality AS (
  SELECT field, messages,
         messages = (SELECT count(*) FROM topic WHERE doc IS NOT NULL) AS is_common
  FROM counted),
consistency AS (
  SELECT count(*) FILTER (is_common) AS common_fields,
         count(*) FILTER (NOT is_common) AS other_fields,
         string_agg(field, '; ' ORDER BY field) FILTER (is_common) AS common
  FROM commonality)"""
EARLY = f"""
early AS (
  SELECT * FROM (SELECT part, pos, unnest({list(NUMBERS)!r}) AS field,
                        unnest([{', '.join(f't_{n}' for n in NUMBERS)}]) AS kind
                 FROM kinds)
  WHERE kind IS NOT NULL AND kind <> 'number')"""
PRESENCE = (
    ("symbol", "current_price", "timestamp"),
    ("change", "percent_change", "high", "low", "open", "previous_close"),
)


def truthy(name: str) -> str:
    return (
        f"coalesce(json_type(doc, '$.{name}') <> 'NULL' AND (doc->>'$.{name}') <> 'false', false)"
    )


def presence() -> str:
    rows = [
        f"SELECT '{n}' AS field, {str(group == 0).lower()} AS required, "
        f"count(*) FILTER ({truthy(n)}) AS present, count(*) FILTER (NOT {truthy(n)}) AS missing "
        "FROM topic"
        for group, names in enumerate(PRESENCE)
        for n in names
    ]
    return "\nUNION ALL ".join(rows)


def extracted(name: str, quoted: bool) -> str:
    pattern = f'"{name}":"([^"]*)"' if quoted else f'"{name}":([0-9.]*)'
    return f"coalesce(nullif(regexp_extract(value, '{pattern}', 1), ''), 'N/A') AS {name}"


POSITIONS = """
positions AS (
  SELECT o_custkey AS account,
         CASE l_partkey % 3 WHEN 0 THEN 'view' WHEN 1 THEN 'click' ELSE 'purchase' END AS symbol,
         sum(l_quantity) AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
latest AS (
  SELECT symbol, arg_max(current_price, (event_time, event_id)) AS price
  FROM ticks GROUP BY symbol)"""


def values(rows: list[tuple], names: str) -> str:
    def text(v):
        return f"'{v}'" if isinstance(v, str) else f"{v}::DOUBLE"

    listed = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return f"{names} AS (SELECT * FROM (VALUES {listed}))"


LIMIT_METRICS = (
    "mean_return", "volatility", "min_return", "max_return", "var_95", "cvar_95", "var_99",
    "cvar_99", "tracking_error",
)
ROLL = "OVER (ORDER BY at_time ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"


def rolling() -> str:
    rows = [
        f"SELECT at_time AS day, '{a}' AS symbol_a, '{b}' AS symbol_b, round(covar_samp({a}, {b}) "
        f"{ROLL} / nullif((stddev_samp({a}) {ROLL}) * (stddev_samp({b}) {ROLL}), 0), 6) AS corr, "
        "row_number() OVER (ORDER BY at_time) AS n FROM wide"
        for a, b in (("view", "click"), ("view", "purchase"), ("click", "purchase"))
    ]
    return "SELECT * EXCLUDE (n) FROM (" + "\nUNION ALL ".join(rows) + ") WHERE n >= 10"


LINES = """
lines AS (
  SELECT event_id,
         concat('[', strftime(ts, '%Y-%m-%dT%H:%M:%S'), '][',
                CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END,
                '] ',
                CASE event_id % 7 WHEN 0 THEN 'Starting pipeline' WHEN 1 THEN 'Polling by http_poller'
                  WHEN 2 THEN 'response holds current_price' WHEN 3 THEN 'Sent to kafka'
                  ELSE 'queue is empty' END,
                ' in event ', event_id, ' ', props) AS line
  FROM events)"""
LINE_CLASS = """
  CASE WHEN contains(line, 'Starting pipeline') THEN 'pipeline_started'
       WHEN contains(line, 'Polling') OR contains(line, 'request') THEN 'polling'
       WHEN contains(line, 'response') OR contains(line, 'current_price')
         OR contains(line, 'symbol') THEN 'data_received'
       WHEN contains(line, 'kafka') OR contains(line, 'Sent') OR contains(line, 'bootstrap')
         THEN 'kafka'
       WHEN contains(line, 'ERROR') THEN 'error' WHEN contains(line, 'WARN') THEN 'warning'
       ELSE 'other' END"""

DAILY = RETURNS + ", " + matrix("(SELECT *, date_trunc('day', event_time) AS day FROM series)", "day", "returns")
ORACLE: dict[str, str] = {
    "valid_ticks": with_(TICKS, body="SELECT * FROM ticks"),
    "returns": with_(
        RETURNS,
        body="SELECT event_id, symbol, event_time, round(returns, 6) AS returns FROM series",
    ),
    "return_statistics": with_(RETURNS, STATISTICS, body="SELECT * FROM statistics"),
    "var_cvar": with_(RETURNS, tails("series"), body="SELECT * FROM tails"),
    "tracking_error": with_(RETURNS, TRACKING, body="SELECT * FROM tracking"),
    "tracking_error_time_aligned": with_(
        RETURNS,
        body="""
, hourly AS (SELECT symbol, time_bucket(INTERVAL '1 hour', event_time) AS bucket,
                    avg(returns) AS returns FROM series GROUP BY ALL)
SELECT a.symbol, count(*) AS aligned,
       CASE WHEN count(*) < 10 THEN 0.0 ELSE round(stddev_samp(a.returns - b.returns), 4) END
         AS tracking_error
FROM hourly a JOIN hourly b ON a.bucket = b.bucket
WHERE b.symbol = 'view' AND a.symbol <> 'view' GROUP BY a.symbol""",
    ),
    "return_correlation": with_(
        RETURNS, matrix("series", "event_time", "returns"), body=correlations(True)
    ),
    "return_correlation_daily": with_(DAILY, body=correlations(True)),
    "momentum_correlation_pairs": with_(
        features("1 day"),
        matrix("features", "window_start", "price_momentum"),
        body=correlations(False),
    ),
    "risk_report": with_(
        RETURNS, STATISTICS, tails("series"), TRACKING, METRICS, body="SELECT * FROM metrics"
    ),
    "risk_document_filed": with_(
        RETURNS, STATISTICS, tails("series"), TRACKING, METRICS,
        matrix("series", "event_time", "returns"),
        body=f""", pairs AS ({correlations(True)}),
figures AS (
  SELECT * FROM (UNPIVOT (SELECT symbol, CAST(data_points AS DOUBLE) AS data_points, {", ".join(
      LIMIT_METRICS)} FROM metrics)
    ON COLUMNS(* EXCLUDE symbol) INTO NAME name VALUE value)),
filed AS (
  SELECT 'risk_metrics_20240130_000000' AS document_id, * FROM figures
  UNION ALL SELECT 'benchmark_only', * FROM figures WHERE symbol = 'view'
  UNION ALL SELECT d.id, symbol_a, 'corr_' || symbol_b, corr
  FROM pairs, (VALUES ('risk_metrics_20240130_000000'), ('benchmark_only')) AS d(id) WHERE corr IS NOT NULL)
SELECT '2024-01' AS month, document_id, symbol, name, round(value, 6) AS value FROM filed""",
    ),
    "history_dated": f"""
SELECT CAST(ts AS DATE) AS date, event_type AS symbol, count(*) AS ticks, round(sum(value), 4) AS total,
       min(ts) AS first_time, 0.0::DOUBLE AS change
FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-16' AND TIMESTAMP '2024-01-30' AND event_type IN {S}
GROUP BY 1, 2""",
    "history_range_scan": with_(
        SCAN,
        body="SELECT *, 0.0::DOUBLE AS percent_change, 0.0::DOUBLE AS volatility_score, "
        "0.0::DOUBLE AS price_range_pct FROM scan",
    ),
    "symbols_seen": "SELECT count(*) AS rows, count(DISTINCT event_type) AS symbols FROM events",
    "window_features_5m": with_(
        features("5 minutes"), body=f"SELECT {FEATURE_OUT} FROM features"
    ),
    "window_features_1d": with_(features("1 day"), body=f"SELECT {FEATURE_OUT} FROM features"),
    "volatility_regime_counts": with_(
        features("1 hour"),
        body="SELECT volatility_regime, target_direction, count(*) AS windows FROM features "
        "GROUP BY ALL",
    ),
    "latest_feature_per_symbol": with_(
        features("1 day"),
        body=f"SELECT {FEATURE_OUT} FROM features "
        "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) = 1",
    ),
    "next_period_targets": with_(
        features("1 day"),
        body="SELECT symbol, window_start, target_direction, lead(target_direction) "
        "OVER (PARTITION BY symbol ORDER BY window_start) AS next_direction FROM features",
    ),
    "momentum_matrix": with_(
        features("1 day"),
        matrix("features", "window_start", "price_momentum"),
        body="SELECT at_time AS window_start, round(view, 6) AS view, round(click, 6) AS click, "
        "round(purchase, 6) AS purchase FROM wide",
    ),
    "ingest_valid": with_(
        RAW,
        body="""
SELECT event_id, symbol, debug_source, current_price, round(change, 6) AS change, percent_change,
       round(high, 6) AS high, round(low, 6) AS low, round(open, 6) AS open,
       round(previous_close, 6) AS previous_close,
       CASE WHEN usable THEN round(high - low, 2) END AS intraday_range,
       CASE WHEN usable THEN round((high - low) / open * 100, 4) END AS intraday_volatility,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S') AS timestamp, 'finnhub' AS data_source,
       'real_time_quote' AS data_type,
       symbol || '_' || CAST(CAST(floor(epoch(event_time)) AS BIGINT) AS VARCHAR) AS doc_id,
       'has_symbol; processed; valid_quote' AS tags
FROM judged WHERE ok""",
    ),
    "ingest_rejected": with_(
        RAW,
        body="""
SELECT event_id, symbol, current_price, debug_error, 'debug_failed' AS tags,
       concat_ws('; ', CASE WHEN symbol IS NULL THEN 'no_symbol' END,
         CASE WHEN coalesce(current_price, 0) = 0 THEN 'no_price_data' END) AS error_type
FROM judged WHERE NOT ok""",
    ),
    "ingest_symbol_source": with_(
        RAW,
        body="SELECT symbol, debug_source, count(*) AS quotes, count(debug_error) AS with_error "
        "FROM judged GROUP BY ALL",
    ),
    "parse_rate": with_(
        MESSAGES,
        KINDS,
        body="""
SELECT count(*) AS messages, count(*) FILTER (t_current_price = 'number') AS parsed,
       round(count(*) FILTER (t_current_price = 'number') * 100.0::DOUBLE / count(*), 4)
         AS parse_rate
FROM kinds""",
    ),
    "parsed_quotes": with_(
        MESSAGES,
        KINDS,
        body=f"""
SELECT key AS kafka_key, key AS symbol, """
        + ", ".join(
            f"CASE WHEN t_{n} = 'number' THEN CAST(doc->>'$.{n}' AS DOUBLE) END AS {n}"
            for n in NUMBERS
        )
        + f""",
       CAST(doc->>'$.previous_close' AS DOUBLE) AS previous_close,
       doc->>'$.timestamp' AS timestamp, doc->>'$.data_source' AS data_source
FROM kinds WHERE t_current_price = 'number' AND CAST(doc->>'$.current_price' AS DOUBLE) > 0
  AND key IN {S}""",
    ),
    "parsed_sample": with_(
        MESSAGES,
        KINDS,
        body="""
SELECT key AS symbol, CAST(doc->>'$.current_price' AS DOUBLE) AS current_price,
       doc->>'$.timestamp' AS timestamp
FROM kinds WHERE t_current_price = 'number' ORDER BY part, pos LIMIT 3""",
    ),
    "message_fields": with_(
        MESSAGES,
        body="""
, keyed AS (SELECT part, pos, doc, unnest(json_keys(doc)) AS field FROM topic
            WHERE doc IS NOT NULL),
typed AS (SELECT part, pos, field, json_type(doc, '$.' || field) AS t FROM keyed)
SELECT part AS "partition", pos AS "offset", field,
       CASE t WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean'
         WHEN 'NULL' THEN 'null' ELSE 'number' END AS kind
FROM typed""",
    ),
    "message_checks": with_(
        CHECKED,
        body='SELECT key, part AS "partition", pos AS "offset", parsed, size_chars, valid_fields, '
        "total_expected, array_to_string(issues, '; ') AS issues, is_valid FROM verdicts",
    ),
    "message_summary": with_(CHECKED, SUMMARY, body="SELECT * FROM summary"),
    "top_issues": with_(
        CHECKED,
        body="SELECT issue, count(*) AS occurrences FROM (SELECT unnest(issues) AS issue "
        "FROM verdicts) GROUP BY issue ORDER BY occurrences DESC, issue LIMIT 3",
    ),
    "first_message_verdicts": with_(
        CHECKED,
        body='SELECT part AS "partition", pos AS "offset", is_valid, '
        "array_to_string(issues[1:2], '; ') AS issues FROM verdicts ORDER BY part, pos LIMIT 3",
    ),
    "first_messages": with_(
        MESSAGES,
        body="""
, placed AS (SELECT *, row_number() OVER (ORDER BY part, pos) AS n FROM topic)
SELECT part AS "partition", pos AS "offset", value FROM placed
WHERE n <= (SELECT min(n) FROM placed WHERE n >= 10 AND doc IS NOT NULL)""",
    ),
    "first_message": with_(
        MESSAGES,
        body='SELECT part AS "partition", pos AS "offset", value, '
        "CAST(length(value) AS INTEGER) AS size_chars FROM topic ORDER BY part, pos LIMIT 1",
    ),
    "field_commonality": with_(MESSAGES, COMMON, body="SELECT * FROM commonality"),
    "schema_consistency": with_(
        MESSAGES,
        COMMON,
        body="""
SELECT *, concat_ws('; ', CASE WHEN common_fields < 3 THEN 'too few common fields' END,
  CASE WHEN other_fields > 2 THEN 'inconsistent schema' END) AS issues FROM consistency""",
    ),
    "non_numeric_fields": with_(
        MESSAGES,
        KINDS,
        EARLY,
        body='SELECT part AS "partition", pos AS "offset", field, kind FROM early',
    ),
    "compatibility_tier": with_(
        CHECKED,
        SUMMARY,
        COMMON,
        EARLY,
        body="""
SELECT total_messages, validity_rate, common_fields, other_fields,
       (SELECT count(*) FROM early) AS type_issues,
       common_fields >= 3 AND other_fields <= 2 AND (SELECT count(*) FROM early) = 0 AS compatible,
       CASE WHEN validity_rate >= 90 AND common_fields >= 3 AND other_fields <= 2
              AND (SELECT count(*) FROM early) = 0 THEN 'excellent'
            WHEN validity_rate >= 70 THEN 'good' ELSE 'problematic' END AS tier
FROM summary, consistency""",
    ),
    "field_presence": with_(MESSAGES, body=presence()),
    "critical_checks": with_(
        MESSAGES,
        KINDS,
        body=f"""
SELECT part AS "partition", pos AS "offset",
       coalesce(t_symbol = 'string', false) AS symbol_is_string,
       coalesce(t_current_price = 'number' AND CAST(doc->>'$.current_price' AS DOUBLE) > 0, false)
         AS price_is_positive_number,
       coalesce(regexp_matches(doc->>'$.timestamp',
         '^\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}'), false) AS timestamp_is_iso,
       coalesce((doc->>'$.symbol') IN {S}, false) AS symbol_known,
       coalesce(regexp_matches(doc->>'$.current_price', '^[0-9]+\\.?[0-9]*$')
         AND TRY_CAST(doc->>'$.current_price' AS DOUBLE) > 0, false) AS price_text_ok,
       coalesce(length(doc->>'$.timestamp') > 0, false) AS timestamp_given
FROM kinds""",
    ),
    "valid_structure": with_(
        MESSAGES,
        body=f"SELECT bool_and(doc IS NOT NULL) AS valid_json, bool_and({truthy('symbol')} "
        f"AND {truthy('current_price')}) AS valid_structure FROM topic",
    ),
    "field_types": with_(
        MESSAGES,
        body="""
, keyed AS (SELECT doc, unnest(json_keys(doc)) AS field FROM topic WHERE doc IS NOT NULL),
typed AS (SELECT field, json_type(doc, '$.' || field) AS t FROM keyed)
SELECT field, CASE t WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean'
    WHEN 'NULL' THEN 'null' ELSE 'number' END AS kind, count(*) AS messages
FROM typed GROUP BY ALL""",
    ),
    "topic_size": with_(
        MESSAGES,
        body="SELECT count(*) AS partitions, CAST(sum(end_offset) AS BIGINT) AS messages FROM "
        "(SELECT part, max(pos) + 1 AS end_offset FROM topic GROUP BY part)",
    ),
    "text_extract": with_(
        MESSAGES,
        body=f"""SELECT part AS "partition", pos AS "offset", {extracted('symbol', True)},
       {extracted('current_price', False)}, {extracted('timestamp', True)} FROM topic""",
    ),
    "vendor_reply": with_(
        QUOTES,
        body=f"""
, reply AS (SELECT *, length('{{"c":,"d":,"dp":,"h":,"l":,"o":,"pc":}}')
    + length(CASE k WHEN 0 THEN 'null' WHEN 1 THEN '0'
             WHEN 2 THEN '"' || {money('current_price')} || '"' ELSE {money('current_price')} END)
    + length({money('change')}) + length(CAST(k - 50 AS VARCHAR)) + length({money('high')})
    + length({money('low')}) + length({money('open')}) + length({money('previous_close')}) AS size
  FROM quotes)
SELECT count(*) AS replies, count(*) AS json_replies, count(*) * 7 AS fields,
       CAST(max(size) AS INTEGER) AS largest, count(*) FILTER (k NOT IN (0, 2)) AS with_numeric_c,
       count(*) FILTER (k NOT IN (0, 2)) AS number_c, count(*) AS number_d,
       count(*) AS number_dp, count(*) AS number_h, count(*) AS number_l, count(*) AS number_o,
       count(*) AS number_pc
FROM reply""",
    ),
    "drawdown": with_(
        TICKS,
        body="""
, peaks AS (SELECT symbol, current_price, max(current_price) OVER (PARTITION BY symbol
    ORDER BY event_time, event_id) AS peak FROM ticks)
SELECT symbol, round(min(current_price / peak - 1), 6) AS max_drawdown, count(*) AS ticks
FROM peaks GROUP BY symbol""",
    ),
    "portfolio_value": with_(
        TICKS,
        POSITIONS,
        body="SELECT account, round(coalesce(sum(quantity * price), 0), 4) AS value, count(*) AS holdings, "
        "count(*) FILTER (price IS NULL) AS unpriced "
        "FROM positions LEFT JOIN latest USING (symbol) GROUP BY account",
    ),
    "stress_test": with_(
        TICKS,
        POSITIONS,
        values(SHOCKS, "shocks(scenario, symbol, shock)"),
        body="""
SELECT scenario, account, round(coalesce(sum(quantity * price), 0), 4) AS value,
       round(coalesce(sum(quantity * price * (1 + coalesce(shock, 0))), 0), 4) AS stressed_value,
       round(coalesce(sum(quantity * price * (1 + coalesce(shock, 0))) - sum(quantity * price), 0), 4) AS loss,
       count(*) FILTER (price IS NULL) AS unpriced
FROM positions CROSS JOIN (SELECT DISTINCT scenario FROM shocks)
LEFT JOIN latest USING (symbol) LEFT JOIN shocks USING (scenario, symbol)
GROUP BY scenario, account""",
    ),
    "limit_alerts": with_(
        RETURNS,
        STATISTICS,
        tails("series"),
        TRACKING,
        METRICS,
        values(LIMITS, "limits(metric, symbol, op, threshold)"),
        body="SELECT metric, symbol, value, op, threshold FROM ("
        + " UNION ALL ".join(
            f"SELECT symbol, '{m}' AS metric, {m} AS value FROM metrics" for m in LIMIT_METRICS
        )
        + ") JOIN limits USING (metric, symbol) WHERE (op = '>' AND value > threshold) "
        "OR (op = '<' AND value < threshold)",
    ),
    "portfolio_var": with_(
        RETURNS,
        f"""
hourly AS (SELECT symbol, time_bucket(INTERVAL '1 hour', event_time) AS bucket,
                  avg(returns) AS returns FROM series GROUP BY ALL),
weighted AS (SELECT 'portfolio' AS symbol, bucket, sum(returns * CASE symbol {' '.join(
    f"WHEN '{s}' THEN {w}::DOUBLE" for s, w in WEIGHTS.items())} END) AS returns
  FROM hourly GROUP BY bucket)""",
        tails("weighted"),
        body="SELECT * FROM tails",
    ),
    "rolling_correlation": with_(DAILY, body=rolling()),
    "var_backtest": with_(
        RETURNS,
        body="""
, rolled AS (
  SELECT symbol, returns, list(returns) OVER (PARTITION BY symbol ORDER BY event_time, event_id
    ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING) AS history FROM series),
judged AS (
  SELECT symbol, returns < list_sort(history)[CAST(floor((1.0::DOUBLE - 0.95::DOUBLE) * 100)
    AS BIGINT) + 1] AS breach FROM rolled WHERE len(history) = 100)
SELECT symbol, count(*) AS tested, count(*) FILTER (breach) AS breaches,
       round(avg(CAST(breach AS DOUBLE)), 6) AS breach_rate,
       round(1.0::DOUBLE - 0.95::DOUBLE, 6) AS expected_rate
FROM judged GROUP BY symbol""",
    ),
    "feature_drift": with_(
        features("1 day"),
        body="""
, long AS (
  UNPIVOT (SELECT window_start >= TIMESTAMP '2024-01-16' AS recent, price_momentum,
                  intraday_volatility, price_position, volume_proxy::DOUBLE AS volume_proxy,
                  trend_strength FROM features)
  ON price_momentum, intraday_volatility, price_position, volume_proxy, trend_strength
  INTO NAME feature VALUE value),
ranges AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM long WHERE NOT recent
           GROUP BY feature),
binned AS (
  SELECT feature, greatest(0, least(9, floor(coalesce((value - lo) / nullif(hi - lo, 0) * 10, 0))))
           AS bin, recent
  FROM long JOIN ranges USING (feature)),
counts AS (
  SELECT feature, bin, count(*) FILTER (NOT recent) AS older, count(*) FILTER (recent) AS newer
  FROM binned GROUP BY ALL),
shares AS (
  SELECT feature, greatest(older / sum(older) OVER (PARTITION BY feature), 0.0001::DOUBLE) AS p,
         greatest(coalesce(newer / nullif(sum(newer) OVER (PARTITION BY feature), 0), 0),
                  0.0001::DOUBLE) AS q
  FROM counts)
SELECT feature, round(sum((q - p) * ln(q / p)), 6) AS stability_index FROM shares
GROUP BY feature""",
    ),
    "temporal_folds": with_(
        features("1 day"),
        body="""
, placed AS (SELECT symbol, window_start,
    ntile(4) OVER (PARTITION BY symbol ORDER BY window_start) AS fold FROM features),
sizes AS (SELECT symbol, fold, count(*) AS test_rows, min(window_start) AS test_start,
                 max(window_start) AS test_end FROM placed GROUP BY ALL)
SELECT symbol, CAST(fold AS INTEGER) AS fold, test_rows, test_start, test_end,
       CAST(sum(test_rows) OVER (PARTITION BY symbol ORDER BY fold
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS train_rows
FROM sizes QUALIFY fold > 1""",
    ),
    "stream_window_features": with_(
        features("5 minutes"),
        body=f"SELECT {FEATURE_OUT} FROM features WHERE window_end <= (SELECT "
        "max(event_time) - INTERVAL '10 minutes' FROM valid)",
    ),
    "stream_returns": with_(
        RETURNS,
        body="SELECT event_id, symbol, event_time, round(returns, 6) AS returns FROM series",
    ),
    "stream_keyed_returns": with_(
        QUOTES,
        ARRIVALS,
        body="""SELECT event_id, symbol, event_time, round(returns, 6) AS returns FROM (
  SELECT event_id, symbol, event_time, (current_price / nullif(
      lag(current_price) OVER (PARTITION BY symbol ORDER BY event_time, event_id), 0) - 1) * 100
    AS returns FROM judged WHERE NOT coalesce(late, false)) WHERE returns IS NOT NULL""",
    ),
    "topic_features": with_(
        features(
            "5 minutes",
            RAW
            + """,
valid AS (
  SELECT event_id, date_trunc('second', event_time) AS event_time, symbol, current_price,
         percent_change, high, low
  FROM judged WHERE ok AND current_price > 0)""",
        ),
        body=f"""SELECT {FEATURE_OUT} FROM features
WHERE window_end <= (SELECT max(event_time) FROM valid) - INTERVAL 10 MINUTE""",
    ),
    "topic_offsets": with_(
        MESSAGES,
        body="""
SELECT part AS partition, count(*) AS messages, min(pos) AS first_offset, max(pos) AS last_offset,
       sum(strlen(value)) AS bytes, count(DISTINCT key) AS keys
FROM (SELECT *, max(pos) OVER (PARTITION BY part) AS newest FROM topic)
WHERE pos BETWEEN 100 AND newest - 50 GROUP BY part""",
    ),
    "stream_journal": with_(
        QUOTES,
        ARRIVALS,
        body="""SELECT query, input_rows, CASE WHEN query = 'returns' THEN late_rows END AS late_rows,
       date_trunc('milliseconds', newest) - delay AS watermark
FROM (SELECT count(*) AS input_rows, count(*) FILTER (late) AS late_rows, max(event_time) AS newest FROM judged),
     (VALUES ('returns', INTERVAL 2 HOUR), ('features', INTERVAL 10 MINUTE)) AS q(query, delay)""",
    ),
    "stream_ingest": with_(
        RAW,
        body="SELECT symbol, CASE WHEN ok THEN 'valid' ELSE 'rejected' END AS route, "
        "count(*) AS quotes FROM judged GROUP BY ALL",
    ),
    "model_versions": with_(
        features("1 hour"),
        body="""
, seen AS (SELECT 0::BIGINT AS version, * FROM features WHERE window_start < TIMESTAMP '2024-01-16'
           UNION ALL SELECT 1::BIGINT, * FROM features),
spans AS (SELECT version, count(*) AS rows, min(window_start) AS since, max(window_start) AS until,
                 count(DISTINCT symbol) AS symbols, count(DISTINCT window_start) AS windows
          FROM seen GROUP BY version HAVING count(*) >= 10),
sizes AS (SELECT version, symbol, count(*) AS rows, count(DISTINCT coalesce(price_momentum, 0) > 0) AS classes
          FROM seen GROUP BY ALL HAVING count(*) >= 5),
models AS (
  SELECT version, symbol, 'direction' AS kind, NULL::BIGINT AS trained_rows FROM sizes WHERE rows >= 8 AND classes = 2
  UNION ALL SELECT version, symbol, 'volatility', rows FROM sizes WHERE rows >= 6
  UNION ALL SELECT version, '*', 'anomaly', NULL FROM spans
  UNION ALL SELECT version, 'market', 'regime', NULL FROM spans WHERE symbols >= 2 AND windows >= 3)
SELECT version, CASE WHEN version > (SELECT min(version) FROM spans) THEN (SELECT min(version) FROM spans) END AS parent,
       symbol, kind, rows, since, until, trained_rows
FROM models JOIN spans USING (version)""",
    ),
    "log_pattern_counts": with_(
        LINES,
        body="SELECT count(*) AS lines, count(*) FILTER (contains(line, 'ERROR')) AS errors, "
        "count(*) FILTER (contains(line, 'WARN')) AS warnings, "
        + ", ".join(
            f"count(*) FILTER (contains(lower(line), '{w}')) AS {w}"
            for w in ("http_poller", "polling", "request", "response")
        )
        + " FROM lines",
    ),
    "log_line_classes": with_(
        LINES, body=f"SELECT {LINE_CLASS} AS line_class, count(*) AS lines FROM lines GROUP BY 1"
    ),
    "log_last_errors": with_(
        LINES,
        body="SELECT event_id, substring(line, 1, 100) AS line "
        "FROM lines WHERE contains(line, 'ERROR') ORDER BY event_id DESC LIMIT 3",
    ),
}
