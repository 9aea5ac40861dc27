"""Spelling variants by blocked Gram matrices of letter counts.

A word is the vector of its letter counts. One insertion or deletion moves it by a squared distance of
one, one replacement by two, so words are near only if their squared distance says so, and only if their
lengths are equal or adjacent. The same holds for any group of letters: its count differs by at most one.
Words are therefore kept in blocks by the counts of a few letter groups, which add up to the length; a
block meets itself and those blocks that one edit leads to. Where two blocks meet, a product of their
count matrices gives all squared distances at once, and only pairs that pass are compared letter by
letter. No pair of words leaves the meeting, only counts and the best partner of each word.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.common import partitions, settle, table
from tickwell.shipping import ship

RUN = re.compile("[a-zÀ-ÿ]+")
#: A run is damaged where this number divides its checksum.
DAMAGE = 97
LEAST_LENGTH, LEAST_COUNT, FORM_FACTOR = 5, 3, 2
GROUPS = 8
#: Words of one block row, and of the guests that one product takes.
BLOCK, GUESTS = 2_048, 8_192
#: Words counted in memory before they are passed on to Spark's aggregation.
HELD = 200_000
#: Letters of an alphabet that fits one byte, a letter after the other; the rest of the bytes is unused.
LETTER = np.full(256, -1, np.int64)
LETTER[[*range(0x61, 0x7B), *range(0xC0, 0x100)]] = np.arange(90)
LETTERS = 90


def counted(text: str, doc_id: int | None) -> Iterator[tuple[str, int]]:
    """Words of a text, damaged as the rule says, with their counts there. A null id is written as nothing."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall(text.encode().lower().decode())).items():
        mark = zlib.crc32(run.encode(), start)
        if mark % DAMAGE == 0:
            at = mark % len(run)
            run = run[:at] + run[at + 1 :]
        yield run, n


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words of `docs` (doc_id, text) that are long and frequent enough.

    Null texts have no words. Repeated rows count as often as they come. Each task adds up what it can
    hold; Spark adds up the rest, so no word is one task's work.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"]
            )
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for word, n in counted(text.as_py() or "", doc_id):
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) >= HELD:
                    yield flush()
        if held:
            yield flush()

    found = docs.select("doc_id", "text").mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def counts_of(letters: np.ndarray) -> np.ndarray:
    """Letter counts, a row for each word."""
    words = len(letters)
    places = LETTER[letters] + np.arange(words)[:, None] * LETTERS
    return np.bincount(places.ravel(), minlength=words * LETTERS).reshape(words, LETTERS)


def grouped(words: pa.Array, groups: int) -> Iterator[bytes]:
    """For each word the counts of its letters by group, as the bytes of 32-bit numbers."""
    flat = np.frombuffer("".join(words.to_pylist()).encode("latin-1"), np.uint8)
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(words)), lengths)
    counts = np.bincount(row * groups + LETTER[flat] % groups, minlength=len(words) * groups)
    packed = counts.astype(">u4").tobytes()
    return (packed[at : at + 4 * groups] for at in range(0, len(packed), 4 * groups))


def steps(groups: int) -> np.ndarray:
    """Moves to other blocks, half of them: from a word to a longer one, or a letter from group to group.

    The other half are the same moves seen from the other word, so each pair of words meets once.
    """
    one = np.eye(groups, dtype=np.int64)
    swaps = [one[g] - one[h] for g in range(groups) for h in range(g)]
    return np.array([*one, *swaps])


def block_rows(words: DataFrame, groups: int, most: int) -> DataFrame:
    """(key, part, letters, n): the words of each block, at most `most` in a row, letters one byte each."""

    def keyed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(grouped(batch, groups), pa.binary())

    keyed.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, part, letters, ns = None, 0, [], []

        def row() -> pa.RecordBatch:
            values = ([key], [part], ["".join(letters).encode("latin-1")], [np.array(ns, "<i8").tobytes()])
            kinds = (pa.binary(), pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds, strict=True)], ["key", "part", "letters", "n"]
            )

        for batch in batches:
            for new, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if letters and (new != key or len(letters) == most):
                    yield row()
                    part = part + 1 if new == key else 0
                    letters, ns = [], []
                elif new != key:
                    part = 0
                key = new
                letters.append(word)
                ns.append(n)
        if letters:
            yield row()

    # Ranges of (key, word), not hashes of the key: a very large block is spread over several tasks,
    # and `first` tells its rows apart.
    with_key = words.select(F.arrow_udf(keyed, "binary")("word").alias("key"), "word", "n")
    ranged = with_key.repartitionByRange(partitions(words.sparkSession), "key", "word")
    made = ranged.sortWithinPartitions("key", "word").mapInArrow(run, "key binary, part bigint, letters binary, n binary")
    return made.withColumn("part", F.shiftleft(F.spark_partition_id().cast("bigint"), 32) + F.col("part"))


def meetings(rows: DataFrame, groups: int) -> DataFrame:
    """(cell, part, guest, letters, n): each block row at home, and as a guest wherever it has to meet others.

    A guest goes to every row of the blocks that a step leads to, and to the later rows of its own.
    Blocks without words are not visited. The list of visits has keys only; the words follow it once.
    """
    moves = steps(groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts = batch.column(0).to_pylist(), batch.column(1)
            at = np.array([np.frombuffer(k, ">u4") for k in keys], np.int64).reshape(len(keys), groups)
            for move in moves:
                to = at + move
                fine = (to >= 0).all(axis=1)
                packed = to[fine].astype(">u4").tobytes()
                cells = [packed[p : p + 4 * groups] for p in range(0, len(packed), 4 * groups)]
                chosen = pa.array(np.flatnonzero(fine))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells, pa.binary()), batch.column(0).take(chosen), parts.take(chosen)],
                    ["cell", "key", "part"],
                )

    names = rows.select("key", "part")
    homes = names.select(F.col("key").alias("cell"), F.col("part").alias("home"))
    visits = names.mapInArrow(run, "cell binary, key binary, part bigint").join(homes, "cell")
    own = names.withColumn("cell", F.col("key")).join(homes, "cell").where(F.col("part") < F.col("home"))
    guests = visits.unionByName(own).join(rows, ["key", "part"])
    at_home = rows.select(F.col("key").alias("cell"), F.col("part").alias("home"), F.lit(False).alias("guest"), "letters", "n")
    return at_home.unionByName(guests.select("cell", "home", F.lit(True).alias("guest"), "letters", "n"))


class Words:
    """Words of one length: letters, counts of letters and of occurrences."""

    def __init__(self, letters: np.ndarray, n: np.ndarray) -> None:
        self.letters, self.n = letters, n
        self.counts = counts_of(letters).astype(np.float32)
        self.norms = (self.counts**2).sum(axis=1)
        self._text: np.ndarray | None = None

    @property
    def text(self) -> np.ndarray:
        if self._text is None:
            self._text = np.ascontiguousarray(self.letters).view(f"S{self.letters.shape[1]}").ravel()
        return self._text


def unpacked(letters: list[bytes], n: list[bytes]) -> Words:
    counts = np.frombuffer(b"".join(n), "<i8")
    return Words(np.frombuffer(b"".join(letters), np.uint8).reshape(len(counts), -1), counts)


def near(home: Words, guest: Words, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs that differ by one edit; guests are as long as the homes or one letter shorter.

    Squared distances by the Gram product decide which pairs are compared at all. With `same` the guests
    are the homes themselves, and each pair comes back once.
    """
    longer = home.letters.shape[1] - guest.letters.shape[1]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(0, len(home.n), 512):
        part = slice(at, at + 512)
        squared = home.norms[part, None] + guest.norms[None, :] - 2 * (home.counts[part] @ guest.counts.T)
        i, j = np.nonzero(squared == (1 if longer else 2))
        i = i + at
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), 1 << 16):
            a, b = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
            edited = one_missing(home.letters[a], guest.letters[b]) if longer else (home.letters[a] != guest.letters[b]).sum(axis=1) == 1
            found.append((a[edited], b[edited]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def one_missing(long: np.ndarray, short: np.ndarray) -> np.ndarray:
    """Whether a short word is the long one without one letter: common start and end cover it."""
    size = short.shape[1]
    start = np.cumprod(long[:, :size] == short, axis=1, dtype=np.int32).sum(axis=1)
    end = np.cumprod((long[:, 1:] == short)[:, ::-1], axis=1, dtype=np.int32).sum(axis=1)
    return start + end >= size


def partners(words: Words, others: Words, mine: np.ndarray, theirs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For words with pairs: their place, how many pairs, and the place of the best other.

    The best has the largest count; of equal ones the smallest in code-point order.
    """
    involved, back = np.unique(theirs, return_inverse=True)
    order = np.lexsort((others.text[involved], -others.n[involved]))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    places, which, sizes = np.unique(mine, return_inverse=True, return_counts=True)
    best = np.full(len(places), len(order))
    np.minimum.at(best, which, rank[back])
    return places, sizes, involved[order[best]]


SIDES = "word string, n_near bigint, best_n bigint, best string"


def sides(home: Words, guest: Words, same: bool = False) -> Iterator[pa.RecordBatch]:
    a, b = near(home, guest, same)
    if same:
        views = [(home, home, np.concatenate((a, b)), np.concatenate((b, a)))]
    else:
        views = [(home, guest, a, b), (guest, home, b, a)]
    for words, others, mine, theirs in views:
        if len(mine):
            places, sizes, best = partners(words, others, mine, theirs)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([w.decode("latin-1") for w in words.text[places].tolist()]),
                    pa.array(sizes, pa.int64()),
                    pa.array(others.n[best], pa.int64()),
                    pa.array([w.decode("latin-1") for w in others.text[best].tolist()]),
                ],
                ["word", "n_near", "best_n", "best"],
            )


def met(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Home rows come before their guests; up to about `most` guests are gathered for one product."""
    cell, home, waiting = None, None, {}

    def serve(longer: int) -> Iterator[pa.RecordBatch]:
        letters, ns, _ = waiting.pop(longer)
        yield from sides(home, unpacked(letters, ns))

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("cell", "home", "guest", "letters", "n")]
        for key, part, guest, letters, n in zip(*columns, strict=True):
            if not guest:
                for longer in list(waiting):
                    yield from serve(longer)
                cell, home = (key, part), unpacked([letters], [n])
                yield from sides(home, home, True)
                continue
            if (key, part) != cell:
                raise RuntimeError("a guest without its home")
            words = len(n) // 8
            held = waiting.setdefault(len(letters) // words, [[], [], 0])
            held[0].append(letters)
            held[1].append(n)
            held[2] += words
            if held[2] >= most:
                yield from serve(len(letters) // words)
    for longer in list(waiting):
        yield from serve(longer)


def variants(
    words: DataFrame, groups: int = GROUPS, factor: int = FORM_FACTOR, block: int = BLOCK, guests: int = GUESTS
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every row of `words` (word, n), each word once.

    Words are made of a-z and U+00C0 to U+00FF, as `vocabulary` gives them; null words are left out.
    `form` is the near word of largest n (ties: smallest) where that n is at least `factor` times the
    word's own, `root` the end of the chain of forms.
    """
    spark = words.sparkSession
    ship(spark)
    words = settle(words.select("word", "n").where("word is not null"), "spelling-words")
    rows = settle(block_rows(words, groups, block), "spelling-blocks")
    seats = meetings(rows, groups).repartition(partitions(spark), "cell", "home")
    found = seats.sortWithinPartitions("cell", "home", "guest").mapInArrow(lambda batches: met(batches, guests), SIDES)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    strong = -F.col("best.n") >= factor * F.col("n")
    judged = words.join(summed, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(strong, F.col("best.word")).alias("form"),
        F.when(strong, -F.col("best.n")).alias("form_n"),
    )
    judged = settle(judged, "spelling-forms")
    roots = roots_of(judged.where("form is not null").select("word", F.col("form").alias("root")))
    return judged.join(roots, "word", "left").select(*judged.columns, F.coalesce("root", "word").alias("root"))


def roots_of(links: DataFrame) -> DataFrame:
    """(word, root): each word's chain of links followed to its end.

    Every round doubles the steps taken. Counts at least double from link to link, so a chain has no
    more links than a count has bits, and six rounds end the longest one possible; the loop ends by itself.
    """
    now = settle(links, "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next")
        moved = settle(moved, "spelling-roots")
        now = moved.drop("next")
        if moved.where("next is not null").isEmpty():
            return now


def op13(spark, sf_dir: str) -> DataFrame:
    """Every word of `documents` with its near words, its form and its root."""
    found = variants(vocabulary(table(spark, sf_dir, "documents")))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
