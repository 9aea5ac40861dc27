"""Message topics and landing folders as sources and sinks.

The format is a parameter: `kafka` where the connector is installed, `filetopic` for a log of files
with offsets (`file_topic.register` first), or a plain file format. All hold the columns of a broker
topic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tickwell.config import TOPIC_SCHEMA
from tickwell.sources.file_topic import FORMAT

RAW_SCHEMA = "metadata struct<name string, url string>, body string, received_at timestamp"
# Start at the newest offset on a stream, read everything in a batch.
STREAM_START = {"startingOffsets": "latest", "failOnDataLoss": "false"}
BATCH_RANGE = {"startingOffsets": "earliest", "endingOffsets": "latest"}


def _broker(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic}


def read_topic_stream(
    spark: SparkSession, fmt: str, location: str, servers: str = "", **options: str
) -> DataFrame:
    """`location` is a topic name for kafka and a folder for file formats."""
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        return reader.options(**_broker(servers, location), **STREAM_START, **options).load()
    if fmt == FORMAT:
        return reader.options(**STREAM_START | options).load(location)
    return reader.schema(TOPIC_SCHEMA).options(**options).load(location)


def read_topic(
    spark: SparkSession, fmt: str, location: str, servers: str = "", **options: str
) -> DataFrame:
    """Everything the topic holds now."""
    reader = spark.read.format(fmt)
    if fmt == "kafka":
        return reader.options(**_broker(servers, location), **BATCH_RANGE, **options).load()
    if fmt == FORMAT:
        return reader.options(**BATCH_RANGE | options).load(location)
    return reader.schema(TOPIC_SCHEMA).options(**options).load(location)


def read_raw_quotes(
    spark: SparkSession, location: str, stream: bool = False, **options: str
) -> DataFrame:
    """Vendor replies landed as JSON lines with request name, URL and body text."""
    reader = spark.readStream if stream else spark.read
    return reader.format("json").schema(RAW_SCHEMA).options(**options).load(location)


def as_topic_values(rows: DataFrame, key: Column | None = None) -> DataFrame:
    """Each row as one JSON text, with an optional key."""
    value = F.to_json(F.struct("*")).alias("value")
    return rows.select(value) if key is None else rows.select(key.alias("key"), value)


def as_topic_rows(rows: DataFrame, key: Column, time: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Each row as a message: key, JSON text, its time, and the columns to order by."""
    value = F.to_json(F.struct(*[c for c in rows.columns if c != time])).cast("binary")
    return rows.select(key.cast("binary").alias("key"), value.alias("value"), F.col(time).alias("timestamp"), *keep)


def publish(
    rows: DataFrame, fmt: str, location: str, servers: str = "", key: Column | None = None
) -> None:
    """Batch publication; used for single records as well."""
    writer = as_topic_values(rows, key).write.format(fmt).mode("append")
    if fmt == "kafka":
        writer.option("kafka.bootstrap.servers", servers).option("topic", location).save()
    else:
        writer.save(location)


def publish_stream(
    rows: DataFrame, fmt: str, location: str, checkpoint: str, servers: str = ""
) -> DataStreamWriter:
    writer = (
        as_topic_values(rows)
        .writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if fmt == "kafka":
        return writer.option("kafka.bootstrap.servers", servers).option("topic", location)
    return writer.option("path", location)


def dead_letters(rows: DataFrame, time: str = "received_at") -> DataFrame:
    return rows.withColumn("date", F.to_date(time))


def write_dead_letters(rows: DataFrame, path: str, time: str = "received_at") -> None:
    """Rejected rows as JSON lines, one folder per date."""
    dead_letters(rows, time).write.mode("append").partitionBy("date").json(path)


def has_messages(topic: DataFrame) -> bool:
    return not topic.isEmpty()


def doubled_range(spark: SparkSession, n: int) -> DataFrame:
    """The connectivity check: numbers and their doubles."""
    return spark.range(n).withColumn("value", F.col("id") * 2)
