"""A topic kept in files, with offsets: a Python data source to read it, and its writer.

The log lies in folders `partition=<p>/segment=<first offset>`; a file of a segment holds a run of
offsets of one partition, and its footer says which. Readers plan from footers, so a range of offsets
opens only the files that hold it, and a stream's progress is the next offset of each partition.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tickwell.config import TOPIC_SCHEMA
from tickwell.operators.ordered import ordered
from tickwell.shipping import ship
from tickwell.sources.durable import cut

FORMAT = "filetopic"
SEGMENT_ROWS = 1_000_000
EARLIEST, LATEST = "earliest", "latest"
#: Fixed order of the columns of a read topic.
COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp")

Offsets = dict[str, int]


@dataclass(frozen=True)
class LogFile:
    """A run of offsets of one partition; both ends belong to it."""

    partition: int
    path: str
    first: int
    last: int


@dataclass
class Slice(InputPartition):
    """The offsets from `start` to before `end` of one file."""

    partition: int
    path: str
    start: int
    end: int


class Log:
    """The files of a topic as they lie there now; a footer is read once."""

    def __init__(self, location: str) -> None:
        self.files, self.root = fs.FileSystem.from_uri(location) if ":" in location else (fs.LocalFileSystem(), location)
        self.known: dict[str, LogFile | None] = {}

    def listed(self) -> list[LogFile]:
        found = self.files.get_file_info(fs.FileSelector(self.root, recursive=True, allow_not_found=True))
        paths = [f.path for f in found if f.is_file and f.path.endswith(".parquet") and "/_" not in f.path[len(self.root) :]]
        for path in paths:
            if path not in self.known:
                self.known[path] = self.described(path)
        return sorted((f for p in paths if (f := self.known[p])), key=lambda f: (f.partition, f.first, f.last))

    def described(self, path: str) -> LogFile | None:
        """What the footer says; a file without rows is no part of the log."""
        partition = int(path.split("/partition=")[1].split("/")[0])
        with self.files.open_input_file(path) as opened:
            footer = pq.read_metadata(opened)
        at = footer.schema.names.index("offset")
        seen = [footer.row_group(g).column(at).statistics for g in range(footer.num_row_groups)]
        if not seen:
            return None
        return LogFile(partition, path, min(s.min for s in seen), max(s.max for s in seen))

    def start(self) -> Offsets:
        out: Offsets = {}
        for f in self.listed():
            out[str(f.partition)] = min(f.first, out.get(str(f.partition), f.first))
        return out

    def end(self) -> Offsets:
        out: Offsets = {}
        for f in self.listed():
            out[str(f.partition)] = max(f.last + 1, out.get(str(f.partition), 0))
        return out

    def slices(self, start: Offsets, end: Offsets, lost_is_error: bool) -> list[Slice]:
        """What to read for the offsets from `start` to before `end`; a partition without a start begins at 0.

        Offsets that no file holds any more are lost: an error, or passed over.
        """
        files, out = self.listed(), []
        for name, stop in end.items():
            at = start.get(name, 0)
            for f in files:
                if f.partition != int(name) or f.last < at or f.first >= stop:
                    continue
                if f.first > at and lost_is_error and (name in start or at > 0):
                    raise LostOffsets(f"partition {name}: offsets {at} to {f.first - 1} are gone")
                out.append(Slice(f.partition, f.path, max(at, f.first), min(stop, f.last + 1)))
                at = out[-1].end
            if at < stop and lost_is_error:
                raise LostOffsets(f"partition {name}: offsets {at} to {stop - 1} are gone")
        return out

    def read(self, part: Slice | None) -> Iterator[pa.RecordBatch]:
        """Rows in order of their offsets; only row groups that the range touches are opened.

        Where there is nothing to read, Spark asks for one part that is None.
        """
        if part is None:
            return
        with self.files.open_input_file(part.path) as opened:
            source = pq.ParquetFile(opened)
            at = source.metadata.schema.names.index("offset")
            groups = []
            for g in range(source.metadata.num_row_groups):
                seen = source.metadata.row_group(g).column(at).statistics
                if seen.max >= part.start and seen.min < part.end:
                    groups.append(g)
            columns = [c for c in COLUMNS if c != "partition"]
            for batch in source.iter_batches(row_groups=groups, columns=columns):
                offset = batch.column("offset")
                held = batch.filter(pc.and_(pc.greater_equal(offset, part.start), pc.less(offset, part.end)))
                if held.num_rows:
                    yield shaped(held, part.partition)


class LostOffsets(RuntimeError):
    """Offsets were asked for that the log does not hold any more."""


def shaped(batch: pa.RecordBatch, partition: int) -> pa.RecordBatch:
    kinds = {"key": pa.binary(), "value": pa.binary(), "topic": pa.string(), "offset": pa.int64(), "timestamp": pa.timestamp("us", "UTC")}
    columns = [
        pa.array([partition] * batch.num_rows, pa.int32()) if c == "partition" else batch.column(c).cast(kinds[c]) for c in COLUMNS
    ]
    return pa.RecordBatch.from_arrays(columns, list(COLUMNS))


def asked(text: str, log: Log) -> Offsets:
    """`earliest`, `latest`, or offsets by partition; there -2 stands for earliest and -1 for latest."""
    if text in (EARLIEST, LATEST):
        return log.start() if text == EARLIEST else log.end()
    named = {str(p): int(o) for p, o in json.loads(text).items()}
    known = {-2: log.start(), -1: log.end()}
    return {p: known[o].get(p, 0) if o in known else o for p, o in named.items()}


class Options:
    def __init__(self, options) -> None:
        self.log = Log(options["path"])
        self.starting = options.get("startingOffsets")
        self.ending = options.get("endingOffsets", LATEST)
        self.lost_is_error = str(options.get("failOnDataLoss", "true")).lower() == "true"


class TopicReader(Options, DataSourceReader):
    """Everything between two sets of offsets; from the earliest to the latest where none are given."""

    def partitions(self) -> list[Slice]:
        end = asked(self.ending, self.log)
        start = asked(self.starting or EARLIEST, self.log)
        return self.log.slices(start, {p: o for p, o in end.items() if o > start.get(p, 0)}, self.lost_is_error)

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return self.log.read(partition)


class TopicStreamReader(Options, DataSourceStreamReader):
    """All that is new since the last batch; a new stream starts at the latest offsets unless told otherwise.

    Partitions that appear later are read from their first offset.
    """

    def initialOffset(self) -> Offsets:  # noqa: N802
        return asked(self.starting or LATEST, self.log)

    def latestOffset(self) -> Offsets:  # noqa: N802
        return self.log.end()

    def partitions(self, start: Offsets, end: Offsets) -> list[Slice]:
        return self.log.slices(start, end, self.lost_is_error)

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return self.log.read(partition)

    def commit(self, end: Offsets) -> None:
        pass


class FileTopic(DataSource):
    """Options: path, startingOffsets, endingOffsets (batch), failOnDataLoss (default true)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return TOPIC_SCHEMA

    def reader(self, schema) -> TopicReader:
        return TopicReader(self.options)

    def streamReader(self, schema) -> TopicStreamReader:  # noqa: N802
        return TopicStreamReader(self.options)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(FileTopic)


def numbered(rows: DataFrame, order: tuple[str, ...], partitions: int, ends: Offsets) -> DataFrame:
    """Rows with their partition, by the hash of the key, and the next free offsets there.

    Offsets follow `order`, which must tell rows of one partition apart. Rows without a key go by the
    hash of their value. A busy partition is numbered in slices, not in one task.
    """
    place = F.pmod(F.xxhash64(F.coalesce("key", "value")), F.lit(partitions)).cast("int")
    at = ordered(rows.withColumn("partition", place), "partition", order).positions("offset", "held").drop_slices()
    free = F.coalesce(*[F.when(F.col("partition") == int(p), F.lit(o)) for p, o in ends.items()], F.lit(0))
    return at.withColumn("offset", (F.col("offset") - 1 + free).cast("bigint")).drop("held")


def append_log(rows: DataFrame, path: str, segment_rows: int = SEGMENT_ROWS) -> None:
    """Adds numbered rows (the columns of a topic); each segment is one task and one file.

    A job that fails leaves no file behind that a reader would see. Two writers of one partition at a
    time would give out the same offsets, so a topic has one writer.
    """
    segment = (F.floor(F.col("offset") / segment_rows) * segment_rows).cast("bigint")
    kept = rows.select(*[F.col(c) for c in COLUMNS], segment.alias("segment"))
    placed = kept.repartition("partition", "segment").sortWithinPartitions("partition", "segment", "offset")
    placed.write.mode("append").partitionBy("partition", "segment").parquet(path)


def publish_log(rows: DataFrame, path: str, topic: str, order: tuple[str, ...], partitions: int, segment_rows: int = SEGMENT_ROWS) -> None:
    """Rows with `key`, `value`, `timestamp` and the columns of `order`, added at the end of the topic."""
    named = rows.withColumn("topic", F.lit(topic))
    append_log(cut(numbered(named, order, partitions, Log(path).end())), path, segment_rows)
