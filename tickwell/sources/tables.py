"""Quotes, messages and positions read out of the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.config import Universe

# The event types that play the part of traded symbols; the other types are unknown symbols.
EVENT_UNIVERSE = Universe(("view", "click", "purchase"), "view")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("long")


def as_quotes(events: DataFrame) -> DataFrame:
    """Full quotes: the event value is the price, `props.k` spreads the day's range around it."""
    read = events.select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("current_price"),
        F.from_json("props", "k bigint")["k"].alias("k"),
        cents(F.col("value")).alias("price_c"),
    )
    k = F.col("k")
    spread = read.withColumns(
        {"open_c": F.col("price_c") + k - 50, "previous_c": F.col("price_c") - k + 50}
    )
    change = (F.col("price_c") - F.col("previous_c")) / F.lit(100.0)
    previous = F.col("previous_c") / F.lit(100.0)
    return spread.select(
        "event_id",
        "event_time",
        "symbol",
        "current_price",
        change.alias("change"),
        (F.try_divide(change, previous) * 100).alias("percent_change"),
        ((F.greatest("price_c", "open_c") + F.col("k")) / F.lit(100.0)).alias("high"),
        ((F.least("price_c", "open_c") - F.col("k")) / F.lit(100.0)).alias("low"),
        (F.col("open_c") / F.lit(100.0)).alias("open"),
        previous.alias("previous_close"),
        "k",
    )


def quotes(spark: SparkSession, folder: str) -> DataFrame:
    return as_quotes(table(spark, folder, "events"))


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when the source has fewer splits than that.

    For parsing, which is heavy for its bytes. A large table has more splits than there are
    cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def as_prices(events: DataFrame) -> DataFrame:
    """Only the columns a return needs, so the scan reads four columns."""
    return events.select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("current_price"),
    )


def price_history(spark: SparkSession, folder: str) -> DataFrame:
    return as_prices(table(spark, folder, "events"))


def money_text(amount: str) -> Column:
    return F.col(amount).cast("decimal(18,2)").cast("string")


def as_messages(quotes: DataFrame) -> DataFrame:
    """Topic rows carrying each quote as JSON text, some of them damaged by a fixed rule.

    The rule uses the event number: of every 40 consecutive events, one each has cut-off
    text, a quoted price, no data source, a local date, a null change, a boolean high.
    """
    fault = F.pmod("event_id", F.lit(40))
    price = money_text("current_price")
    iso = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss")
    local = F.date_format("event_time", "dd/MM/yyyy")
    parts = [
        F.lit('{"symbol":"'), F.col("symbol"),
        F.lit('","current_price":'),
        F.when(fault == 1, F.concat(F.lit('"'), price, F.lit('"'))).otherwise(price),
        F.lit(',"change":'), F.when(fault == 4, "null").otherwise(money_text("change")),
        F.lit(',"percent_change":'), (F.col("k") - 50).cast("string"),
        F.lit(',"high":'), F.when(fault == 5, "true").otherwise(money_text("high")),
        F.lit(',"low":'), money_text("low"),
        F.lit(',"open":'), money_text("open"),
        F.lit(',"previous_close":'), money_text("previous_close"),
        F.lit(',"timestamp":"'), F.when(fault == 3, local).otherwise(iso), F.lit('"'),
        F.when(fault == 2, "").otherwise(',"data_source":"feed"'),
        F.lit("}"),
    ]
    whole = F.concat(*parts)
    text = F.when(fault == 0, F.substring_index(whole, ',"change"', 1)).otherwise(whole)
    return quotes.select(
        F.col("symbol").cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit("quotes").alias("topic"),
        F.pmod("event_id", F.lit(3)).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 3).cast("long").alias("offset"),
        F.col("event_time").cast("timestamp").alias("timestamp"),
        "event_id",
    )


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return as_messages(as_quotes(spread(table(spark, folder, "events"))))


def as_raw_quotes(quotes: DataFrame) -> DataFrame:
    """Vendor replies with request metadata; a fixed rule removes what each step relies on."""
    case = F.pmod("event_id", F.lit(6))
    name = (
        F.when(case == 0, F.concat("symbol", F.lit("_quote")))
        .when(case == 1, F.lit("other_quote"))
        .when(case == 2, F.lit("other_quote"))
    )
    url = (
        F.when(case.isin(0, 1), F.concat(F.lit("https://quotes.test/q?symbol="), "symbol"))
        .when(case.isin(2, 3), F.concat(F.lit("https://quotes.test/"), "symbol"))
        .when(case == 4, F.lit("https://quotes.test/"))
    )
    price = (
        F.when(F.col("k") == 0, "null")
        .when(F.col("k") == 1, "0")
        .when(F.col("k") == 2, F.concat(F.lit('"'), money_text("current_price"), F.lit('"')))
        .otherwise(money_text("current_price"))
    )
    body = F.concat(
        F.lit('{"c":'), price,
        F.lit(',"d":'), money_text("change"),
        F.lit(',"dp":'), (F.col("k") - 50).cast("string"),
        F.lit(',"h":'), money_text("high"),
        F.lit(',"l":'), money_text("low"),
        F.lit(',"o":'), money_text("open"),
        F.lit(',"pc":'), money_text("previous_close"),
        F.lit("}"),
    )
    return quotes.select(
        "event_id",
        F.col("event_time").alias("received_at"),
        F.when(case < 5, F.struct(name.alias("name"), url.alias("url"))).alias("metadata"),
        body.alias("body"),
    )


def raw_quotes(spark: SparkSession, folder: str) -> DataFrame:
    return as_raw_quotes(as_quotes(spread(table(spark, folder, "events"))))


def positions(spark: SparkSession, folder: str) -> DataFrame:
    """Quantity per account and symbol out of the order lines."""
    symbols = EVENT_UNIVERSE.symbols
    place = F.pmod("l_partkey", F.lit(len(symbols)))
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", place.alias("at"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    # Lines shrink to one row per order before they move, however many an order has, and the
    # join then finds them partitioned by its key.
    per_order = lines.groupBy("l_orderkey").agg(
        *[F.sum(F.when(F.col("at") == i, F.col("l_quantity"))).alias(s) for i, s in enumerate(symbols)]
    )
    held = per_order.join(orders, per_order["l_orderkey"] == orders["o_orderkey"])
    return (
        held.unpivot("o_custkey", list(symbols), "symbol", "quantity")
        .where(F.col("quantity").isNotNull())
        .groupBy(F.col("o_custkey").alias("account"), "symbol")
        .agg(F.sum("quantity").alias("quantity"))
    )


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One log line per event: errors from its type, the activity from its number."""
    level = F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "signup", "WARN")
    activity = F.pmod("event_id", F.lit(7))
    said = (
        F.when(activity == 0, "Starting pipeline")
        .when(activity == 1, "Polling by http_poller")
        .when(activity == 2, "response holds current_price")
        .when(activity == 3, "Sent to kafka")
        .otherwise("queue is empty")
    )
    parts = [
        F.lit("["), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("]["),
        F.coalesce(level, F.lit("INFO")), F.lit("] "), said,
        F.lit(" in event "), F.col("event_id").cast("string"), F.lit(" "), F.col("props"),
    ]
    return table(spark, folder, "events").select("event_id", F.concat_ws("", *parts).alias("line"))


def arrivals(ticks: DataFrame, parts: int) -> DataFrame:
    """Ticks with the part of the feed they arrive in: a minute or more late by a fixed rule.

    One event in 50 comes five hours late, the others up to an hour. The time from the first to the
    last arrival is cut into equal parts.
    """
    minutes = F.when(F.pmod("event_id", F.lit(50)) == 7, 300).otherwise(F.pmod("event_id", F.lit(60)))
    came = ticks.withColumn("came", F.unix_micros(F.col("event_time").cast("timestamp")) + minutes * 60_000_000)
    ends = came.agg(F.min("came").alias("feed_start"), (F.max("came") - F.min("came") + 1).alias("feed_span"))
    part = F.expr(f"(came - feed_start) * {parts} div feed_span")
    return came.crossJoin(F.broadcast(ends)).withColumn("part", part.cast("int")).drop("came", "feed_start", "feed_span")


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The event table, one file or a folder of them, as a stream.

    Watermarks need a time with a zone.
    """
    schema = table(spark, folder, "events").schema
    # A pattern, since a plain path of a stream has to be a folder.
    stream = spark.readStream.schema(schema).parquet(f"{folder}/events.parque[t]")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))
