"""Document fingerprints by SimHash over weighted terms, and search of them by permuted block tables.

Each term of a text votes with its weight on every bit of the fingerprint, for or against by the bits of
its hash. Fingerprints are then cut into more blocks than the radius has bits: two that lie within the
radius agree on all blocks but at most that many. Each table leads with one choice of the blocks that
have to agree, so every such pair shares the lead of at least one table, and is taken from the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.common import cut, partitions, settle, table, text_of
from tickwell.shipping import ship
from tickwell.sources.durable import broadcast_if_small

BITS, BYTES = 128, 16
RADIUS = 6
SEED = 11
#: A term is a word or two words in a row; a longer word is taken in pieces of that many bytes.
PIECE = 24
#: Weight of a term that occurs once; every doubling adds as much again.
ONCE = 16
#: Words whose hashes a task remembers, and terms whose bits it lays out at once.
KNOWN, SLICE = 400_000, 1 << 14
#: A larger bucket is dealt to tiles of that many fingerprints; rows of one distance matrix.
TILE, ROWS = 8_192, 512


def mixed(values: np.ndarray) -> np.ndarray:
    """A second hash of 64-bit numbers: products and shifts that spread every bit."""
    out = (values ^ (values >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return out ^ (out >> np.uint64(32))


class Fingerprinter:
    """Fingerprints of texts as 16 bytes; remembers the hashes of words it has met."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def hashes(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()
        if any(len(w) > PIECE for w in words):
            words = [w[at : at + PIECE] for w in words for at in range(0, len(w), PIECE)]
        if len(self.known) > KNOWN:
            self.known.clear()
        known = self.known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word, SEED)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def __call__(self, text: str) -> bytes:
        words = self.hashes(text)
        if not len(words):
            return bytes(BYTES)
        pairs = mixed(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
        terms, times = np.unique(np.concatenate((words, pairs)), return_counts=True)
        weights = np.rint(ONCE * (1 + np.log2(times))).astype(np.float32)
        votes = np.zeros(BITS)
        for at in range(0, len(terms), SLICE):
            part = terms[at : at + SLICE]
            both = np.column_stack((part, mixed(~part))).view(np.uint8)
            # Whole numbers below 2^24, so the products add up exactly in any order.
            votes += weights[at : at + SLICE] @ np.unpackbits(both, axis=1).astype(np.float32)
        return np.packbits(2 * votes > weights.sum(dtype=np.float64)).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal bits."""
    return 1 - (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() / BITS


def with_fingerprint(docs: DataFrame, into: str, column: str = "text") -> DataFrame:
    """Adds the fingerprint of each whole text as 16 bytes; null, empty and blank texts get zero.

    Equal texts get equal fingerprints, wherever they lie. Other columns and the number of rows stay.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = Fingerprinter()
        for texts in batches:
            yield pa.array([of(t.as_py() or "") for t in texts], pa.binary())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(into, F.arrow_udf(run, "binary")(text_of(column)))


def leads(total: int, radius: int) -> list[bytes]:
    """The leading bits of each table: every choice of the blocks that have to agree.

    With more blocks a table leads with more bits and there are more tables. There are as few blocks as
    leave leads long enough to tell `total` fingerprints apart, so buckets do not grow with the input.
    """
    blocks = radius + 1
    while BITS * (blocks - radius) // blocks < total.bit_length() and blocks < radius + 4:
        blocks += 1
    edges = [round(k * BITS / blocks) for k in range(blocks + 1)]
    marks = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:], strict=False)]
    return [sum(chosen).to_bytes(BYTES) for chosen in combinations(marks, blocks - radius)]


def words_of(prints: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(prints), np.uint64).reshape(len(prints), 2)


def close(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and distances of the pairs of fingerprints within the radius."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for at in range(0, len(left), ROWS):
        for to in range(0, len(right), TILE):
            a, b = left[at : at + ROWS, None], right[None, to : to + TILE]
            apart = np.bitwise_count(a[:, :, 0] ^ b[:, :, 0])
            apart += np.bitwise_count(a[:, :, 1] ^ b[:, :, 1])
            i, j = np.nonzero(apart <= radius)
            found.append((i + at, j + to, apart[i, j].astype(np.int64)))
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def first_met(a: np.ndarray, b: np.ndarray, marks: np.ndarray, number: int) -> np.ndarray:
    """Pairs that no earlier table has in one bucket."""
    fresh = np.ones(len(a), bool)
    for mark in marks[:number]:
        fresh &= ((a ^ b) & mark).any(axis=1)
    return fresh


def buckets(prints: DataFrame, marks: list[bytes], tile: int) -> DataFrame:
    """(number, lead, low, high, side, print, docs): the tables, dealt to buckets and tiles of large ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = words_of(batch.column(0).to_pylist())
            for number, mark in enumerate(marks):
                lead = (values & words_of([mark])).tobytes()
                cells = [lead[at : at + BYTES] for at in range(0, len(lead), BYTES)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(cells), number, np.int32)), pa.array(cells, pa.binary()), *batch.columns],
                    ["number", "lead", "print", "docs"],
                )

    rows = prints.select("print", "docs").mapInArrow(run, "number int, lead binary, print binary, docs bigint")
    large = rows.groupBy("number", "lead").agg(F.count("*").alias("size")).where(F.col("size") > tile)
    dealt = rows.join(broadcast_if_small(cut(large)), ["number", "lead"], "left")
    tiles = F.coalesce(F.ceil(F.col("size") / tile), F.lit(1)).cast("int")
    side = F.pmod(F.xxhash64("print"), tiles).cast("int")
    spread = dealt.withColumn("tiles", tiles).withColumn("side", side)
    each = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    low, high = F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high")
    return each.select("number", "lead", low, high, "side", "print", "docs")


def met(rows: DataFrame, marks: list[bytes], radius: int) -> DataFrame:
    """For each fingerprint of a bucket with others near it, the number of documents that have those."""
    lead = np.array([words_of([m])[0] for m in marks])

    def pairs(number: int, low: int, high: int, sides: np.ndarray, prints: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        values = words_of(prints)
        at, to = np.flatnonzero(sides == low), np.flatnonzero(sides == high)
        i, j, _ = close(values[at], values[to], radius)
        i, j = at[i], to[j]
        if low == high:
            i, j = i[i < j], j[i < j]
        fresh = first_met(values[i], values[j], lead, number)
        return i[fresh], j[fresh]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, ([], [], [])

        def serve() -> Iterator[pa.RecordBatch]:
            sides, prints, docs = held
            if len(prints) < 2:
                return
            i, j = pairs(cell[0], cell[2], cell[3], np.array(sides), prints)
            if len(i):
                count = np.array(docs, np.int64)
                near = np.zeros(len(prints), np.int64)
                np.add.at(near, i, count[j])
                np.add.at(near, j, count[i])
                some = np.flatnonzero(near)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([prints[k] for k in some], pa.binary()), pa.array(near[some])], ["print", "near"]
                )

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for number, mark, low, high, side, print_, docs in zip(*columns, strict=True):
                if (number, mark, low, high) != cell:
                    yield from serve()
                    cell, held = (number, mark, low, high), ([], [], [])
                for values, value in zip(held, (side, print_, docs), strict=True):
                    values.append(value)
        yield from serve()

    key = ("number", "lead", "low", "high")
    dealt = rows.repartition(partitions(rows.sparkSession), *key).sortWithinPartitions(*key)
    return dealt.mapInArrow(run, "print binary, near bigint")


def neighbours(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(print, n_near): for every row of `prints` (print, docs), how many other documents lie within the radius.

    `prints` holds each fingerprint once, with the number of its documents. Nothing is capped: a bucket
    beyond `tile` fingerprints is dealt to tiles, and only sums leave a bucket. An empty table gives an
    empty one.
    """
    ship(prints.sparkSession)
    marks = leads(prints.count(), radius)
    found = met(buckets(prints, marks, tile), marks, radius)
    others = found.groupBy("print").agg(F.sum("near").alias("near"))
    total = F.coalesce("near", F.lit(0)) + F.col("docs") - 1
    return prints.join(others, "print", "left").select("print", total.alias("n_near"))


EDITED = "part bigint, edge string, doc_id bigint, text string, n_chars bigint, edited_sha256 string, print binary, edited_print binary, near_edited double, near_next double"


def edited(text: str, following: str) -> str:
    """The second half of the text (the shorter one) overwritten by the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


class Chain:
    """Collects the rows of one partition; a row is done when its successor is known."""

    def __init__(self, part: int) -> None:
        self.of, self.part = Fingerprinter(), part

    def done(self, doc_id, text: str, print_: bytes, following: str, next_print: bytes) -> tuple:
        changed = edited(text, following)
        digest = hashlib.sha256(changed.encode()).hexdigest()
        own = print_ if changed == text else self.of(changed)
        near = likeness(print_, own), likeness(print_, next_print)
        return (self.part, None, doc_id, None, len(text), digest, print_, own, *near)

    def open_(self, edge: str, doc_id, text: str, print_: bytes) -> tuple:
        return (self.part, edge, doc_id, text, len(text), None, print_, None, None, None)


def packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}
    fields = [f.split() for f in EDITED.split(", ")]
    columns = [pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])


def next_edits(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, print, edited_print, near_edited, near_next) of every row of `docs`.

    The following document is the one with the next smaller doc_id; after the last comes the first, so a
    lone document follows itself. Rows with one doc_id follow each other by the hash of their text; null
    ids come last. Null texts count as empty. Texts move once, into ranges of that order that hold about
    as many rows each, copies of one row spread as well; the last row of a range meets the first one of
    the next range afterwards, in a join with one row for each range.
    """
    ship(docs.sparkSession)
    order = [F.desc_nulls_last("doc_id"), F.col("mark"), F.col("salt")]
    keyed = docs.select("doc_id", text_of().alias("text")).withColumns({"mark": F.xxhash64("text"), "salt": F.rand(SEED)})
    ranged = keyed.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, last = Chain(TaskContext.get().partitionId()), None
        for batch in batches:
            rows = []
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = value.as_py()
                print_ = last[2] if last is not None and last[1] == text else chain.of(text)
                if last is None:
                    rows.append(chain.open_("first", doc_id, text, print_))
                else:
                    rows.append(chain.done(*last, text, print_))
                last = (doc_id, text, print_)
            if rows:
                yield packed(rows)
        if last is not None:
            yield packed([chain.open_("last", *last)])

    found = settle(ranged.select("doc_id", "text").mapInArrow(run, EDITED), "fingerprint-edits")
    firsts = found.where("edge = 'first'")
    after = Window.orderBy("part")
    # One row for each range of the order.
    parts = firsts.select("part", F.lead("part").over(after).alias("next"), F.first("part").over(after).alias("start"))
    parts = parts.select("part", F.coalesce("next", "start").alias("next"))
    heads = firsts.select(F.col("part").alias("next"), F.col("text").alias("head"), F.col("print").alias("head_print"))
    lasts = found.where("edge = 'last'").select("part", "doc_id", "text", "print")
    edges = lasts.join(parts, "part").join(heads, "next").select("part", "doc_id", "text", "print", "head", "head_print")

    def close_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = Chain(-1)
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True))
            if rows:
                yield packed([chain.done(*row) for row in rows])

    whole = found.where("edge is null").union(edges.mapInArrow(close_edges, EDITED))
    return whole.select("doc_id", "n_chars", "edited_sha256", "print", "edited_print", "near_edited", "near_next")


def op11(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of each document, its edited text and its successor, and how many others lie near it."""
    edits = settle(next_edits(table(spark, sf_dir, "documents").select("doc_id", "text")), "fingerprints")
    prints = settle(edits.groupBy("print").agg(F.count("*").alias("docs")), "fingerprint-list")
    found = edits.join(neighbours(prints), "print")
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("print")).alias("fingerprint"),
        F.lower(F.hex("edited_print")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "n_near",
    )
