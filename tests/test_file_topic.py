"""The file topic: offsets, ranges, lost offsets, and a stream that is resumed."""

from __future__ import annotations

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tickwell.sources import file_topic, topics
from tickwell.streaming import jobs


def rows(spark, low, high, keys=3):
    return spark.range(low, high).select(
        F.concat(F.lit("k"), F.col("id") % keys).cast("binary").alias("key"),
        F.concat(F.lit("value "), "id").cast("binary").alias("value"),
        F.timestamp_seconds(F.lit(1_700_000_000) - F.col("id")).alias("timestamp"),
        F.col("id").alias("n"),
    )


@pytest.fixture
def topic(spark, tmp_path, sliced):
    file_topic.register(spark)
    path = str(tmp_path / "topic")
    file_topic.publish_log(rows(spark, 0, 60), path, "quotes", ("timestamp", "n"), 4, segment_rows=7)
    return path


def read(spark, path, **options):
    return topics.read_topic(spark, file_topic.FORMAT, path, **options)


def test_offsets_follow_the_order_of_each_partition(spark, topic):
    file_topic.publish_log(rows(spark, 60, 75), topic, "quotes", ("timestamp", "n"), 4, segment_rows=7)
    found = read(spark, topic)
    assert found.columns == list(file_topic.COLUMNS) and found.count() == 75
    held = {}
    for r in found.collect():
        held.setdefault(r.partition, []).append((r.offset, r.timestamp, bytes(r.key), r.topic))
    for messages in held.values():
        messages.sort()
        assert [o for o, *_ in messages] == list(range(len(messages)))
        # Fifteen later values of a third of the keys each come after all of the first publication.
        times = [t for _, t, *_ in messages]
        first = len([t for t in times if t.timestamp() > 1_700_000_000 - 60])
        assert times[:first] == sorted(times[:first]) and times[first:] == sorted(times[first:])
    keys = [{k for _, _, k, _ in messages} for messages in held.values()]
    assert sum(map(len, keys)) == 3


def test_messages_without_key_or_value_are_kept(spark, tmp_path):
    file_topic.register(spark)
    frame = rows(spark, 0, 4).withColumns({"key": F.lit(None).cast("binary")})
    frame = frame.unionByName(frame.withColumns({"value": F.lit(None).cast("binary"), "n": F.col("n") + 10}))
    file_topic.publish_log(frame, str(tmp_path / "t"), "quotes", ("timestamp", "n"), 2)
    found = read(spark, str(tmp_path / "t"))
    assert found.count() == 8 and found.where("value is null").count() == 4


def test_ranges_and_files(spark, topic):
    log = file_topic.Log(topic)
    ends, files = log.end(), log.listed()
    assert all(f.last - f.first < 7 for f in files) and sum(f.last - f.first + 1 for f in files) == 60
    start, stop = {p: 3 for p in ends}, {p: min(o, 12) for p, o in ends.items()}
    opened = log.slices(start, stop, True)
    assert len(opened) < len(files)
    found = read(spark, topic, startingOffsets=json.dumps(start), endingOffsets=json.dumps(stop))
    got = sorted((r.partition, r.offset) for r in found.collect())
    assert got == sorted((int(p), o) for p in ends for o in range(3, stop[p]))
    marks = {p: -2 for p in ends}, {p: -1 for p in ends}
    assert read(spark, topic, startingOffsets=json.dumps(marks[0]), endingOffsets=json.dumps(marks[1])).count() == 60
    assert read(spark, topic, startingOffsets="latest").count() == 0


def test_an_empty_topic(spark, tmp_path):
    file_topic.register(spark)
    assert read(spark, str(tmp_path / "none")).count() == 0


def test_lost_offsets(spark, topic, tmp_path):
    path = str(tmp_path / "copy")
    files = file_topic.Log(topic).listed()
    gone = {p: 0 for p in file_topic.Log(topic).end()}
    # The log without its first segments, as retention leaves it.
    kept = [f for f in files if f.first >= 7]
    for f in kept:
        target = f.path.replace(topic, path)
        os.makedirs(os.path.dirname(target), exist_ok=True)
        shutil.copy(f.path, target)
    want = sum(f.last - f.first + 1 for f in kept)
    assert read(spark, path).count() == want
    asked = json.dumps({p: 1 for p in gone if any(str(f.partition) == p for f in kept)})
    with pytest.raises(Exception, match="are gone"):
        read(spark, path, startingOffsets=asked).count()
    assert read(spark, path, startingOffsets=asked, failOnDataLoss="false").count() == want


def test_a_stream_goes_on_from_its_offsets(spark, topic, tmp_path):
    out, marks = str(tmp_path / "out"), str(tmp_path / "c")

    def run(**options):
        stream = topics.read_topic_stream(spark, file_topic.FORMAT, topic, **options)
        jobs.catch_up(jobs.append_batches(stream, out, marks, "100 milliseconds"))
        return spark.read.parquet(out).count()

    # Without a start a new stream reads only what comes after it.
    assert run() == 0
    file_topic.publish_log(rows(spark, 60, 70, keys=9), topic, "quotes", ("timestamp", "n"), 6)
    assert run() == 10
    file_topic.publish_log(rows(spark, 70, 75), topic, "quotes", ("timestamp", "n"), 6)
    assert run() == 15 and run() == 15
    values = spark.read.parquet(out).select(F.col("value").cast("string")).distinct()
    assert values.count() == 15


def test_a_stream_from_the_earliest_offsets(spark, topic, tmp_path):
    stream = topics.read_topic_stream(spark, file_topic.FORMAT, topic, startingOffsets="earliest")
    out = str(tmp_path / "out")
    jobs.append_batches(stream, out, str(tmp_path / "c"), None).awaitTermination()
    assert spark.read.parquet(out).count() == 60
