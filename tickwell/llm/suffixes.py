"""Suffix-array dedup: bytes covered by a 100-byte string that starts earlier in the corpus.

Of all suffixes only those at anchors are sorted: a position is an anchor if the hash of the 40 bytes
from it is the least in some 100-byte string. Equal strings have equal anchors, so an equal pair is
found through any of them. Anchors whose 40 bytes occur once are dropped first. Each task sorts the
rest of its documents into a run by what follows the anchor and then by what precedes it, and sends
the run front-coded, cut by ranges of suffixes. A range is merged by a loser tree whose nodes know how
long a prefix each head shares with the last winner and never compare it again; the shared prefixes
that the merge yields are the groups of equal strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.common import table
from tickwell.shipping import ship

LENGTH = 100
SEED = 40
#: Bytes before an anchor that a string around it can reach.
REACH = LENGTH - SEED
KEY = LENGTH + REACH
#: Bytes of text whose anchors are worked out together.
PIECE = 2_000_000
#: Documents whose suffixes set the borders between ranges, about; only the balance depends on it.
SAMPLE = 3_000
#: Bytes of text for each shard, about; what a task holds follows from it, whatever the input.
SHARD_BYTES = 16 << 20
#: Stands for a null doc_id, so that such rows come last.
LAST = np.int64(2**63 - 1)

FACTOR = 0x9E3779B97F4A7C15
ROWS = "shard int, kind int, doc_id bigint, data binary"
#: What a row carries between the steps.
TEXT, CANDIDATES, ANCHORS, RUN, SPANS, STRINGS = range(6)


def packed(*arrays: np.ndarray) -> bytes:
    """Equally long arrays as one compressed block, bytes of equal weight side by side."""
    size = len(arrays[0])
    head = np.array([size, *(a.dtype.itemsize * 256 + ord(a.dtype.kind) for a in arrays)], np.int64)
    parts = [np.ascontiguousarray(a).view(np.uint8).reshape(size, -1).T.tobytes() for a in arrays]
    return zstandard.compress(np.int64(len(arrays)).tobytes() + head.tobytes() + b"".join(parts), 1)


def unpacked(data: bytes) -> list[np.ndarray]:
    data = zstandard.decompress(data)
    count = int(np.frombuffer(data, np.int64, 1)[0])
    size, *kinds = np.frombuffer(data, np.int64, 1 + count, 8).tolist()
    at, arrays = 16 + 8 * count, []
    for kind in kinds:
        width = kind // 256
        flat = np.frombuffer(data, np.uint8, size * width, at).reshape(width, size).T
        arrays.append(np.ascontiguousarray(flat).view(f"{chr(kind % 256)}{width}").reshape(size))
        at += size * width
    return arrays


def gathered(blocks: list[bytes], kinds: list[type]) -> list[np.ndarray]:
    """The columns of all blocks, end to end."""
    read = [unpacked(b) for b in blocks]
    return [np.concatenate([np.empty(0, kind), *(r[k] for r in read)]) for k, kind in enumerate(kinds)]


def batch(rows: list[tuple]) -> pa.RecordBatch:
    shard, kind, doc, data = zip(*rows, strict=True)
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
    arrays = [pa.array(v, t) for v, t in zip((shard, kind, doc, data), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["shard", "kind", "doc_id", "data"])


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def seed_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 40 bytes from each position on, by doubling; positions too near the end fall out."""
    grown = {1: data.astype(np.uint64) + np.uint64(1)}
    for span in (1, 2, 4, 8, 16):
        power = np.uint64(pow(FACTOR, span, 1 << 64))
        grown[2 * span] = grown[span][:-span] * power + grown[span][span:]
        if span != 8:
            del grown[span]
    power = np.uint64(pow(FACTOR, 8, 1 << 64))
    size = len(data) - SEED + 1
    return mixed(grown[32][:size] * power + grown[8][32 : 32 + size])


def least(values: np.ndarray, span: int, pick: np.ufunc) -> np.ndarray:
    """The least (or greatest) of each `span` neighbours, by doubling."""
    width = 1
    while 2 * width <= span:
        values = pick(values[:-width], values[width:])
        width *= 2
    rest = span - width
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and position of the anchors of one text."""
    hashes, places = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for at in range(0, max(len(data) - LENGTH + 1, 0), PIECE):
        part = data[at : at + PIECE + LENGTH - 1]
        values = seed_hashes(part)
        low = least(values, REACH + 1, np.minimum)
        # An anchor is the least of some string: the greatest of the leasts around it is its own.
        edge = np.zeros(REACH, np.uint64)
        own = least(np.concatenate((edge, low, edge)), REACH + 1, np.maximum)
        chosen = np.flatnonzero(own == values)
        hashes.append(values[chosen] >> np.uint64(16))
        places.append(chosen + at)
    return np.concatenate(hashes), np.concatenate(places)


def tag_of(text: bytes) -> int:
    """Tells texts of one doc_id, or of none, apart."""
    return xxhash.xxh3_64_intdigest(text)


def shard_of(doc: np.ndarray, tag: np.ndarray, shards: int) -> np.ndarray:
    code = mixed(doc.view(np.uint64) * np.uint64(FACTOR) + tag.astype(np.uint64))
    return ((code >> np.uint64(33)) % np.uint64(shards)).astype(np.int32)


def text_block(texts: list[tuple[int | None, bytes]]) -> bytes:
    """Texts with their ids, null ones included, as one compressed block."""
    named = np.array([doc is not None for doc, _ in texts])
    doc = np.array([int(LAST) if doc is None else doc for doc, _ in texts], np.int64)
    facts = packed(named.view(np.uint8), doc, np.array([len(t) for _, t in texts], np.int64))
    return np.int64(len(facts)).tobytes() + facts + zstandard.compress(b"".join(t for _, t in texts), 3)


def texts_of(data: bytes) -> Iterator[tuple[int | None, bytes]]:
    size = int(np.frombuffer(data, np.int64, 1)[0])
    named, doc, lengths = (v.tolist() for v in unpacked(data[8 : 8 + size]))
    flat, at = zstandard.decompress(data[8 + size :]), 0
    for known, number, length in zip(named, doc, lengths, strict=True):
        yield (number if known else None), flat[at : at + length]
        at += length


def scattered(shard: np.ndarray, shards: int, kind: int, arrays: list[np.ndarray]) -> list[tuple]:
    """One row for each shard with the array entries that belong there."""
    order = np.argsort(shard, kind="stable")
    edges = np.searchsorted(shard[order], np.arange(shards + 1))
    return [
        (s, kind, None, packed(*(v[order[a:b]] for v in arrays)))
        for s, (a, b) in enumerate(zip(edges, edges[1:], strict=False))
        if b > a
    ]


def find_candidates(shards: int):
    """Texts to anchors, dealt by their hash; those that repeat in these texts need no comparison."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            held: list[tuple[np.ndarray, ...]] = []
            size = 0
            for doc, text in zip(part.column("doc_id").to_pylist(), part.column("data"), strict=True):
                data = text.as_buffer().to_pybytes()
                values, places = anchors(np.frombuffer(data, np.uint8))
                if len(values):
                    key = LAST if doc is None else doc
                    held.append((values, np.full(len(values), key), np.full(len(values), tag_of(data), np.uint64), places))
                    size += len(values)
                if size > 400_000:
                    yield from deal(held)
                    held, size = [], 0
            yield from deal(held)

    def deal(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        values, doc, tag, place = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.argsort(values, kind="stable")
        values, doc, tag, place = values[order], doc[order], tag[order], place[order].astype(np.uint64)
        first = np.concatenate(([True], values[1:] != values[:-1]))
        again = ~first | np.concatenate((~first[1:], [False]))
        rows = scattered((values[first] % np.uint64(shards)).astype(np.int32), shards, CANDIDATES, [values[first], doc[first], tag[first], place[first]])
        if again.any():
            found = [doc[again], tag[again], place[again]]
            rows += scattered(shard_of(found[0], found[1], shards), shards, ANCHORS, found)
        yield batch(rows)

    return run


def keep_repeated(shards: int):
    """Anchors whose hash came from more than one slice of texts, dealt by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = []
        for part in batches:
            for row in part.to_pylist():
                if row["kind"] == CANDIDATES:
                    blocks.append(row["data"])
                else:
                    yield batch([tuple(row.values())])
        values, doc, tag, place = gathered(blocks, [np.uint64, np.int64, np.uint64, np.uint64])
        order = np.argsort(values, kind="stable")
        same = values[order][1:] == values[order][:-1]
        again = order[np.concatenate((same, [False])) | np.concatenate(([False], same))] if len(order) else order
        if len(again):
            doc, tag, place = doc[again], tag[again], place[again]
            yield batch(scattered(shard_of(doc, tag, shards), shards, ANCHORS, [doc, tag, place]))

    return run


class Records:
    """Suffixes at anchors: keys, what of them lies in the text, and where they come from."""

    names = ("right", "left", "doc", "tag", "place")

    def __init__(self, keys: np.ndarray, right, left, doc, tag, place) -> None:
        self.keys, self.right, self.left, self.doc, self.tag, self.place = keys, right, left, doc, tag, place

    def take(self, at) -> Records:
        return Records(self.keys[at], *(getattr(self, n)[at] for n in self.names))

    def spans(self) -> list[np.ndarray]:
        """All bytes of strings around these anchors."""
        return [self.doc, self.tag, self.place - self.left, self.place + self.right]


def records_of(texts: dict[tuple[int, int], bytes], doc: np.ndarray, tag: np.ndarray, place: np.ndarray) -> Records:
    """Keys of the anchors: the bytes after each, then those before it from right to left."""
    order = np.lexsort((place, tag, doc))
    doc, tag, place = doc[order], tag[order], place[order].astype(np.int64)
    if len(doc):
        new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (place[1:] != place[:-1])))
        doc, tag, place = doc[new], tag[new], place[new]
    keys = np.zeros((len(doc), KEY), np.uint8)
    right, left = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
    first = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])))) if len(doc) else []
    ahead, behind = np.arange(LENGTH), -1 - np.arange(REACH)
    for a, b in zip(first, [*first[1:], len(doc)], strict=False):
        text = texts[int(doc[a]), int(tag[a])]
        flat = np.frombuffer(bytes(REACH) + text + bytes(LENGTH), np.uint8)
        at = place[a:b, None] + REACH
        keys[a:b, :LENGTH] = flat[at + ahead]
        keys[a:b, LENGTH:] = flat[at + behind]
        right[a:b] = np.minimum(LENGTH, len(text) - place[a:b])
        left[a:b] = np.minimum(REACH, place[a:b])
    return Records(keys, right, left, doc, tag, place)


def shared_prefix(keys: np.ndarray) -> np.ndarray:
    """How many bytes each key shares with the one before it."""
    if not len(keys):
        return np.empty(0, np.int64)
    unlike = keys[1:] != keys[:-1]
    found = np.where(unlike.any(axis=1), unlike.argmax(axis=1), keys.shape[1])
    return np.concatenate(([0], found))


def drop_copies(found: Records, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First of each group of sorted records with equal surroundings, and which record leads each.

    Whatever surrounds a later one starts earlier around the first, so all of it goes.
    """
    size = len(found.doc)
    same = (shared == KEY) & (np.diff(found.right, prepend=-1) == 0) & (np.diff(found.left, prepend=-1) == 0)
    group = np.cumsum(~same)
    order = np.lexsort((found.place, found.tag, found.doc, group))
    lead = np.zeros(size, bool)
    if size:
        lead[order[np.concatenate(([True], group[order][1:] != group[order][:-1]))]] = True
    return lead, group


def as_strings(keys: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(keys).view(f"S{keys.shape[1]}").reshape(-1) if len(keys) else np.empty(0, f"S{KEY}")


def sort_runs(shards: int, borders: np.ndarray):
    """Texts and their anchors to sorted runs, front-coded and cut at the borders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[tuple[int, int], bytes] = {}
        blocks = []
        for part in batches:
            for row in part.to_pylist():
                if row["kind"] == TEXT:
                    for doc, text in texts_of(row["data"]):
                        texts[int(LAST) if doc is None else doc, tag_of(text)] = text
                else:
                    blocks.append(row["data"])
        doc, tag, place = gathered(blocks, [np.int64, np.uint64, np.uint64])
        found = records_of(texts, doc, tag, place)
        del texts
        found = found.take(np.argsort(as_strings(found.keys), kind="stable"))
        shared = shared_prefix(found.keys)
        lead, _ = drop_copies(found, shared)
        rows = []
        copies = found.take(~lead)
        if len(copies.doc):
            rows += scattered(shard_of(copies.doc, copies.tag, shards), shards, SPANS, copies.spans())
        found = found.take(lead)
        edges = [0, *np.searchsorted(as_strings(found.keys), borders, side="left").tolist(), len(found.doc)]
        for number, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            if b > a:
                rows.append((number, RUN, None, front_coded(found.take(slice(a, b)))))
        for at in range(0, len(rows), 64):
            yield batch(rows[at : at + 64])

    return run


def front_coded(run: Records) -> bytes:
    """A sorted run: of each key only what it does not share with the one before."""
    shared = shared_prefix(run.keys)
    tails = run.keys[np.arange(KEY) >= shared[:, None]]
    facts = packed(shared.astype(np.uint8), run.right.astype(np.uint8), run.left.astype(np.uint8), run.doc, run.tag, run.place)
    return np.int64(len(facts)).tobytes() + facts + zstandard.compress(tails.tobytes(), 3)


class Run:
    """A front-coded run that is read from its first key on."""

    def __init__(self, data: bytes) -> None:
        size = int(np.frombuffer(data, np.int64, 1)[0])
        shared, self.right, self.left, self.doc, self.tag, self.place = unpacked(data[8 : 8 + size])
        self.shared = shared.tolist()
        self.tails = zstandard.decompress(data[8 + size :])
        self.at, self.offset = -1, 0
        self.key = b""
        self.size = len(self.shared)

    def forward(self) -> int:
        """Moves to the next key and returns how much it shares with the last, -1 at the end."""
        self.at += 1
        if self.at == self.size:
            return -1
        shared = self.shared[self.at]
        upto = self.offset + KEY - shared
        self.key = self.key[:shared] + self.tails[self.offset : upto]
        self.offset = upto
        return shared


def first_unlike(left: bytes, right: bytes, at: int) -> int:
    """First byte from `at` on where two keys differ, or their length."""
    while at < KEY:
        a, b = left[at : at + 16], right[at : at + 16]
        if a != b:
            width = len(a)
            unlike = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
            return at + width - 1 - (unlike.bit_length() - 1) // 8
        at += 16
    return KEY


def merged(runs: list[Run]) -> Iterator[tuple[int, int, int]]:
    """(run, place in it, prefix shared with the key before) in sorted order.

    A loser tree. `shared[r]` is the prefix that the head of run r has in common with the last winner.
    Of two heads the one that shares more is smaller; only if they share equally are they compared, and
    then from there on. The loser keeps what it shares with the head that beat it.
    """
    count = len(runs)
    shared = [run.forward() for run in runs]
    leaves = 1 << max(count - 1, 0).bit_length()
    shared += [-1] * (leaves - count)
    losers = [0] * leaves

    def contest(a: int, b: int) -> tuple[int, int]:
        sa, sb = shared[a], shared[b]
        if sa != sb:
            return (a, b) if sa > sb else (b, a)
        if sa < 0:
            return a, b
        left, right = runs[a].key, runs[b].key
        at = first_unlike(left, right, sa)
        if at == KEY or left[at] < right[at]:
            shared[b] = at
            return a, b
        shared[a] = at
        return b, a

    level = list(range(leaves))
    base = leaves // 2
    while len(level) > 1:
        winners = []
        for k in range(0, len(level), 2):
            winner, losers[base + k // 2] = contest(level[k], level[k + 1])
            winners.append(winner)
        level, base = winners, base // 2
    winner = level[0]
    while shared[winner] >= 0:
        run = runs[winner]
        yield winner, run.at, shared[winner]
        shared[winner] = run.forward()
        node = (winner + leaves) // 2
        while node:
            winner, losers[node] = contest(winner, losers[node])
            node //= 2


def merge_ranges(shards: int, borders: np.ndarray):
    """Runs of a range to spans; strings of groups that a border cuts go on to be compared by hash."""
    prefixes = {bytes(b[:SEED].ljust(SEED, b"\0")) for b in borders.tolist()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges: dict[int, list[bytes]] = {}
        for part in batches:
            for row in part.to_pylist():
                if row["kind"] == RUN:
                    ranges.setdefault(row["shard"], []).append(row["data"])
                else:
                    yield batch([tuple(row.values())])
        for blocks in ranges.values():
            found, shared = merge(blocks)
            rows = resolve(found, shared, shards, prefixes)
            for at in range(0, len(rows), 64):
                yield batch(rows[at : at + 64])

    return run


def merge(blocks: list[bytes]) -> tuple[Records, np.ndarray]:
    runs = [Run(b) for b in blocks]
    order, shared, keys = [], [], []
    starts = np.concatenate(([0], np.cumsum([r.size for r in runs])))
    for number, at, prefix in merged(runs):
        order.append(int(starts[number]) + at)
        shared.append(prefix)
        keys.append(runs[number].key)
    flat = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, KEY)
    at = np.array(order, np.int64)
    facts = [np.concatenate([getattr(r, n) for r in runs])[at] for n in Records.names]
    return Records(flat, facts[0].astype(np.int64), facts[1].astype(np.int64), *facts[2:]), np.array(shared, np.int64)


def resolve(found: Records, shared: np.ndarray, shards: int, prefixes: set[bytes]) -> list[tuple]:
    """Spans of all strings in sorted records that start earlier among them.

    A string is an offset before the anchor. Strings with equal offset are equal if the bytes after the
    anchor are, which the shared prefixes tell, and the bytes before it, which are told apart one by one
    as the offset grows; a record whose left side nobody shares drops out.
    """
    lead, group = drop_copies(found, shared)
    copies = found.take(~lead)
    rows = scattered(shard_of(copies.doc, copies.tag, shards), shards, SPANS, copies.spans()) if len(copies.doc) else []
    # Between two leads lies the least of the prefixes on the way.
    at = np.flatnonzero(lead)
    if not len(at):
        return rows
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    shared = shared[first].copy()
    shared[0] = 0
    found = found.take(at)
    cluster = np.cumsum(shared < SEED)
    cut = np.array([bytes(k) in prefixes for k in found.keys[:, :SEED]])
    rank = np.empty(len(at), np.int64)
    rank[np.lexsort((found.place, found.tag, found.doc))] = np.arange(len(at))
    removed = np.zeros((len(at), REACH + 1), bool)
    strings: list[np.ndarray] = []
    active = np.arange(len(at))
    left = cluster
    for offset in range(REACH + 1):
        if offset:
            _, left = np.unique(left[active] * 256 + found.keys[active, LENGTH + offset - 1], return_inverse=True)
        else:
            _, left = np.unique(left[active], return_inverse=True)
        fits = (found.left[active] >= offset) & (found.right[active] >= LENGTH - offset)
        right = np.cumsum(shared < LENGTH - offset)[active]
        inside = np.flatnonzero(fits)
        order = inside[np.lexsort((rank[active[inside]], left[inside], right[inside]))]
        if len(order):
            new = np.concatenate(([True], (left[order][1:] != left[order][:-1]) | (right[order][1:] != right[order][:-1])))
            removed[active[order[~new]], offset] = True
            firsts = active[order[new]]
            firsts = firsts[cut[firsts]]
            if len(firsts):
                strings.append(np.stack((firsts, np.full(len(firsts), offset)), axis=1))
        # A left side that only one record has cannot be shared at a greater offset either.
        often = (np.bincount(left)[left] > 1) | cut[active]
        often &= found.left[active] > offset
        full = np.zeros(len(at), np.int64)
        full[active] = left
        active = active[often]
        left = full
        if not len(active):
            break
    rows += span_rows(found, removed, shards)
    rows += string_rows(found, strings, shards)
    return rows


def span_rows(found: Records, removed: np.ndarray, shards: int) -> list[tuple]:
    """Runs of neighbouring offsets as spans of bytes."""
    edges = np.diff(np.pad(removed.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, low = np.nonzero(edges == 1)
    _, high = np.nonzero(edges == -1)
    if not len(row):
        return []
    spans = [found.doc[row], found.tag[row], found.place[row] - high + 1, found.place[row] - low + LENGTH]
    return scattered(shard_of(spans[0], spans[1], shards), shards, SPANS, spans)


def string_rows(found: Records, strings: list[np.ndarray], shards: int) -> list[tuple]:
    """Digests of the first of each string of a cut group, dealt by digest."""
    if not strings:
        return []
    pairs = np.concatenate(strings)
    digests = np.empty((len(pairs), 2), np.uint64)
    for k, (at, offset) in enumerate(pairs.tolist()):
        key = found.keys[at].tobytes()
        text = key[LENGTH : LENGTH + offset][::-1] + key[: LENGTH - offset]
        digests[k] = np.frombuffer(hashlib.blake2b(text, digest_size=16).digest(), np.uint64)
    at = pairs[:, 0]
    start = found.place[at] - pairs[:, 1]
    arrays = [digests[:, 0].copy(), digests[:, 1].copy(), found.doc[at], found.tag[at], start]
    return scattered((arrays[0] % np.uint64(shards)).astype(np.int32), shards, STRINGS, arrays)


def compare_strings(shards: int):
    """Strings of cut groups: all but the earliest of each digest are spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = []
        for part in batches:
            for row in part.to_pylist():
                if row["kind"] == STRINGS:
                    blocks.append(row["data"])
                else:
                    yield batch([tuple(row.values())])
        one, two, doc, tag, start = gathered(blocks, [np.uint64, np.uint64, np.int64, np.uint64, np.int64])
        order = np.lexsort((start, tag, doc, two, one))
        one, two, doc, tag, start = (v[order] for v in (one, two, doc, tag, start))
        new = np.concatenate(([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1]))) if len(one) else np.empty(0, bool)
        first = np.maximum.accumulate(np.where(new, np.arange(len(one)), 0))
        # One string may have come by two of its anchors; it is not later than itself.
        later = np.flatnonzero((doc != doc[first]) | (tag != tag[first]) | (start != start[first]))
        if len(later):
            spans = [doc[later], tag[later], start[later], start[later] + LENGTH]
            yield batch(scattered(shard_of(spans[0], spans[1], shards), shards, SPANS, spans))

    return run


def union_of(begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes; spans that touch are one."""
    if not len(begin):
        return []
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.concatenate(([True], begin[1:] > reach[:-1])))
    return list(zip(begin[new].tolist(), reach[np.append(new[1:] - 1, len(reach) - 1)].tolist(), strict=True))


RESULT = "doc_id bigint, n_bytes bigint, spans array<struct<begin:bigint,end:bigint>>, kept binary"


def remove_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and their spans to what is left of each text."""
    texts, blocks = [], []
    for part in batches:
        for row in part.to_pylist():
            if row["kind"] == TEXT:
                texts += texts_of(row["data"])
            else:
                blocks.append(row["data"])
    doc, tag, begin, end = gathered(blocks, [np.int64, np.uint64, np.int64, np.int64])
    order = np.lexsort((begin, tag, doc))
    doc, tag, begin, end = doc[order], tag[order], begin[order], end[order]
    edges = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])))) if len(doc) else []
    where = {(int(doc[a]), int(tag[a])): (a, b) for a, b in zip(edges, [*edges[1:], len(doc)], strict=False)}
    struct = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
    for at in range(0, len(texts), 512):
        rows = []
        for key, text in texts[at : at + 512]:
            a, b = where.get((int(LAST) if key is None else key, tag_of(text)), (0, 0))
            spans = union_of(begin[a:b], end[a:b])
            borders = [0, *(x for span in spans for x in span), len(text)]
            kept = b"".join(text[x:y] for x, y in zip(borders[::2], borders[1::2], strict=True))
            rows.append((key, len(text), [{"begin": x, "end": y} for x, y in spans], kept))
        columns = zip(*rows, strict=True)
        kinds = (pa.int64(), pa.int64(), pa.list_(struct), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "n_bytes", "spans", "kept"])


def borders_of(rows: DataFrame, total: int, shards: int) -> np.ndarray:
    """Keys that cut the suffixes of a bounded sample of documents into equal ranges."""
    share = max(1, total // SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for text in part.column("data"):
                data = text.as_buffer().to_pybytes()
                _, places = anchors(np.frombuffer(data, np.uint8))
                # Some anchors of each text, chosen by their place, are enough for borders.
                places = places[:: max(1, len(places) // 16)]
                if len(places):
                    zero = np.zeros(len(places), np.int64)
                    keys = records_of({(0, 0): data}, zero, zero.astype(np.uint64), places).keys
                    yield pa.RecordBatch.from_arrays([pa.array(as_strings(keys).tolist(), pa.binary())], ["key"])

    some = rows.where(F.pmod(F.xxhash64("doc_id", F.length("data")), F.lit(share)) == 0)
    keys = sorted(bytes(r["key"]) for r in some.mapInArrow(run, "key binary").collect())
    if not keys:
        return np.empty(0, f"S{KEY}")
    return np.unique(np.array([keys[len(keys) * k // shards] for k in range(1, shards)], f"S{KEY}"))


def remove_repeats(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: what is removed, and the bytes that stay.

    Texts are UTF-8 bytes, a null one is empty. Documents are ordered by doc_id, null ones last; rows
    that share a doc_id but not the text are ordered by a 64-bit hash of the text, and fully repeated rows
    are one document, reported as often as they came. Texts under 100 bytes stay whole, and a document
    of which an exact copy comes earlier goes altogether.

    There is a shard for each `shard_bytes` of text; a very large input takes a larger value, and
    executors that can hold some twenty times as much. One plan of five exchanges without actions in
    between, so lost executors are made good by lineage; two of them move the texts. Each step deals
    its rows in compressed blocks of columns. An anchor that a third of all documents hold sends one
    row for each slice of texts, equal surroundings go on once for each task, and a group with very
    many different surroundings is cut by the borders between ranges and settled by digests of its
    strings.
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.lit(0).alias("shard"), F.lit(TEXT).alias("kind"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("data"))
    total, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.length("data")), F.lit(0))).first()
    shards = max(1, -(-size // shard_bytes))
    borders = borders_of(rows, total, shards)

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            texts = list(zip(part.column("doc_id").to_pylist(), (t.as_buffer().to_pybytes() for t in part.column("data")), strict=True))
            keys = np.array([int(LAST) if d is None else d for d, _ in texts], np.int64)
            shard = shard_of(keys, np.array([tag_of(t) for _, t in texts], np.uint64), shards)
            order = np.argsort(shard, kind="stable").tolist()
            edges = np.searchsorted(shard[order], np.arange(shards + 1)).tolist()
            for s, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                if b > a:
                    yield batch([(s, TEXT, None, text_block([texts[k] for k in order[a:b]]))])

    placed = rows.mapInArrow(home, ROWS)
    candidates = rows.mapInArrow(find_candidates(shards), ROWS).repartitionById(shards, "shard")
    repeated = candidates.mapInArrow(keep_repeated(shards), ROWS)
    runs = placed.union(repeated).repartitionById(shards, "shard").mapInArrow(sort_runs(shards, borders), ROWS)
    ranges = runs.repartitionById(shards, "shard").mapInArrow(merge_ranges(shards, borders), ROWS)
    spans = ranges.repartitionById(shards, "shard").mapInArrow(compare_strings(shards), ROWS)
    return placed.union(spans).repartitionById(shards, "shard").mapInArrow(remove_spans, RESULT)


def op1(spark, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
