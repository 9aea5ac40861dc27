"""Language-model scoring by an Elias-Fano n-gram trie.

Level one lists the hashes of all training words, level n all n-grams of n words. An n-gram is a number relative to its context: context id times the number of words, plus word id. Each
level is cut by context into shards, which are files in the shared folder: an Elias-Fano list of these
numbers, whose places are the ids that the next level builds on, one byte of quantised discounted
probability for each n-gram, and one of back-off weight for each context; a shard's smallest value sets
the range of its bytes. Scoring maps the files into
memory, so what a task holds is bounded, and looks up all words of a slice of texts at once.
"""

from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.llm.common import scratch, slices, table, text_of
from tickwell.llm.elias_fano import EliasFano, local, mapped, store
from tickwell.shipping import ship

ORDER = 3
#: N-grams of two words or more are kept from this count on: all of them.
LEAST = 1
#: Bytes of text for each shard of a level.
SHARD_BYTES = 1 << 24
DISCOUNT = 0.75
ADDED = 0.1
#: Characters of text handled together.
SLICE = 4_000_000
#: The end of a text is a token of its own; no word contains a line break.
END = b"\n"


def codes(values: np.ndarray) -> tuple[np.ndarray, float]:
    """Log10 of values in (0, 1] as bytes, and their step, which makes the smallest value the last byte."""
    logs = np.maximum(-np.log10(values), 0)
    step = float(logs.max(initial=0)) / 255 or 1.0
    return np.rint(logs / step).astype(np.uint8), step


def decoded(values: np.ndarray, step: float) -> np.ndarray:
    """A byte has 256 values, so their powers are worked out once."""
    return (10.0 ** (-step * np.arange(256)))[values]


@dataclass
class Level:
    """Where the shards of a level lie and which contexts and ids each of them holds."""

    path: str
    contexts: np.ndarray
    sizes: np.ndarray
    widths: np.ndarray
    opened: dict = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "opened": {}}

    @property
    def bases(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.sizes)))

    def part(self, shard: int) -> tuple[EliasFano, dict[str, np.ndarray]]:
        if shard not in self.opened:
            prefix = f"{self.path}/{shard}"
            ef = EliasFano.load(prefix, int(self.sizes[shard]), int(self.widths[shard]))
            arrays = {n: mapped(f"{prefix}-{n}.npy") for n in ("count", "prob", "back", "steps")}
            self.opened[shard] = (ef, arrays)
        return self.opened[shard]

    def look(self, context: np.ndarray, word: np.ndarray, words: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Id, count and probability of each n-gram (-1, 0, 0 if absent), back-off of each context.

        `context` must be sorted. In level one the context is the word's own hash.
        """
        ids = np.full(len(context), -1)
        found = {"count": np.zeros(len(context), np.int64), "prob": np.zeros(len(context)), "back": np.ones(len(context))}
        edges = np.searchsorted(context, self.contexts)
        bases = self.bases
        for shard in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
            a, b = edges[shard], edges[shard + 1]
            ef, arrays = self.part(shard)
            relative = context[a:b] - self.contexts[shard]
            key = relative if words == 0 else relative * np.uint64(words) + word[a:b]
            place = ef.find(key)
            hit = place >= 0
            ids[a:b] = np.where(hit, place + bases[shard], -1)
            safe = place[hit]
            found["count"][a:b][hit] = arrays["count"][safe]
            if words:
                found["prob"][a:b][hit] = decoded(arrays["prob"][safe], arrays["steps"][0])
                found["back"][a:b] = decoded(arrays["back"][relative.astype(np.int64)], arrays["steps"][1])
        return ids, found


@dataclass
class Model:
    """Levels, the number of training tokens and of distinct ones."""

    levels: list[Level] = field(default_factory=list)
    tokens: int = 0
    words: int = 0


def tokens_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct tokens, sorted; each token's place among them; tokens of each text."""
    index: defaultdict[bytes, int] = defaultdict()
    index.default_factory = index.__len__  # a new word gets the next number
    at, lengths = [], []
    for text in texts:
        words = text.encode().lower().split()
        words.append(END)
        at.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
        lengths.append(len(words))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in index), np.uint64, len(index))
    order = np.argsort(hashes, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    every = np.concatenate(at) if at else np.empty(0, np.int64)
    return hashes[order], place[every], np.array(lengths, np.int64)


def contexts_of(model: Model, texts: list[str]) -> Iterator[tuple[int, np.ndarray, dict]]:
    """Walks the trie along the texts: for each level its ids at every token, and what it found."""
    hashes, at, lengths = tokens_of(texts)
    ids, found = model.levels[0].look(hashes, hashes, 0)
    word = ids[at]
    first = np.zeros(len(at), bool)
    first[np.concatenate(([0], np.cumsum(lengths)[:-1]))] = True
    yield 1, word, {"lengths": lengths, "first": first, "word": word, "count": found["count"][at]}
    node = word
    for number, level in enumerate(model.levels[1:], 2):
        previous = np.concatenate(([-1], node[:-1]))
        previous[first] = -1
        known = np.flatnonzero(previous >= 0)
        # An unknown word is no successor of anything; its context still backs off.
        successor = np.where(word[known] >= 0, word[known], model.words)
        # Each pair of context and word is looked up once, however often the slice has it.
        pairs, which = np.unique(previous[known] * (model.words + 1) + successor, return_inverse=True)
        context, successor = np.divmod(pairs.astype(np.uint64), np.uint64(model.words + 1))
        ids, found = level.look(context, successor, model.words + 1)
        node = np.full(len(at), -1)
        node[known] = ids[which]
        yield number, node, {"known": known, "which": which, "found": found}


def next_keys(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (context, word) keys one level beyond the model, and how often each occurs."""
    if not model.levels:
        hashes, at, _ = tokens_of(texts)
        return hashes, np.bincount(at, minlength=len(hashes))
    facts: dict = {}
    for number, node, found in contexts_of(model, texts):
        if number == 1:
            facts = found
    previous = np.concatenate(([-1], node[:-1]))
    previous[facts["first"]] = -1
    good = (previous >= 0) & (facts["word"] >= 0)
    keys = previous[good].astype(np.uint64) * np.uint64(model.words + 1) + facts["word"][good].astype(np.uint64)
    return np.unique(keys, return_counts=True)


def run_of(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """A sorted run as bytes: widths, gaps between keys, counts, each as narrow as they fit."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    parts = [narrow(gaps[1:]), narrow(counts.astype(np.uint64))]
    head = np.array([len(keys), int(keys[0]), *(p.itemsize for p in parts)], np.uint64)
    return head.tobytes() + b"".join(p.tobytes() for p in parts)


def narrow(values: np.ndarray) -> np.ndarray:
    top = int(values.max()) if len(values) else 0
    return values.astype(np.min_scalar_type(top))


def read_run(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    size, first, wide, broad = np.frombuffer(data, np.uint64, 4).tolist()
    at = 32
    gaps = np.frombuffer(data, f"u{wide}", size - 1, at).astype(np.uint64)
    counts = np.frombuffer(data, f"u{broad}", size, at + wide * (size - 1)).astype(np.int64)
    return np.cumsum(np.concatenate((np.array([first], np.uint64), gaps)), dtype=np.uint64), counts


def grow(texts: DataFrame, model: Model, path: str, shards: int, least: int) -> Model:
    """Counts the n-grams one word longer than the model's and adds their level.

    Runs of distinct keys with counts are exchanged, a few bytes for each key; a frequent n-gram
    sends one key for each slice of texts, not one for each occurrence.
    """
    level = len(model.levels) + 1
    span = 1 << 64 if level == 1 else int(model.levels[-1].bases[-1])
    if level > 1 and span * (model.words + 1) >= 1 << 63:
        raise OverflowError(f"level {level} has {span} contexts of {model.words} words, beyond 63 bits")
    edges = [span * k // shards for k in range(shards + 1)]
    contexts = np.array([min(e, (1 << 64) - 1) for e in edges], np.uint64)
    scale = 1 if level == 1 else model.words + 1
    cuts = np.array([min(e * scale, (1 << 64) - 1) for e in edges[1:-1]], np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0), SLICE):
                keys, counts = next_keys(model, part)
                bounds = [0, *np.searchsorted(keys, cuts).tolist(), len(keys)]
                rows = [(s, run_of(keys[a:b], counts[a:b])) for s, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)) if b > a]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["shard", "run"]
                    )

    folder = f"{local(path)}/level{level}"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[int, list[bytes]] = {}
        for batch in batches:
            for shard, run in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                runs.setdefault(shard, []).append(run.as_py())
        for shard, held in runs.items():
            parts = [read_run(r) for r in held]
            keys, counts = summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
            row = write_shard(model, folder, shard, level, keys, counts, edges, scale, least)
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (shard, *row)], ["shard", "size", "width", "total"])

    runs = texts.mapInArrow(count, "shard int, run binary").repartitionById(shards, "shard")
    rows = {r["shard"]: r for r in runs.mapInArrow(build, "shard bigint, size bigint, width bigint, total bigint").collect()}
    none = np.empty(0, np.uint64)
    sizes, widths, tokens = np.zeros(shards, np.int64), np.zeros(shards, np.int64), model.tokens
    for shard in range(shards):
        if shard in rows:
            size, width, total = rows[shard]["size"], rows[shard]["width"], rows[shard]["total"]
        else:
            size, width, total = write_shard(model, folder, shard, level, none, none.astype(np.int64), edges, scale, least)
        sizes[shard], widths[shard] = size, width
        tokens += total if level == 1 else 0
    grown = Level(folder, contexts, sizes, widths)
    return Model([*model.levels, grown], tokens, int(sizes.sum()) if level == 1 else model.words)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def write_shard(model: Model, folder: str, shard: int, level: int, keys: np.ndarray, counts: np.ndarray, edges: list[int], scale: int, least: int) -> tuple[int, int, int]:
    """Files of one shard; returns its size, the width of its low bits and the sum of its counts."""
    total = int(counts.sum())
    keys = keys - np.uint64(edges[shard] * scale)
    span = edges[shard + 1] - edges[shard]
    prob = back = np.empty(0, np.uint8)
    steps = (1.0, 1.0)
    if level > 1:
        kept = counts >= least
        keys, counts = keys[kept], counts[kept]
        context = (keys // np.uint64(scale)).astype(np.int64)
        often = context_counts(model.levels[-1], edges[shard], edges[shard + 1])
        # What the successors leave, from whole counts: above zero at any size.
        rest = often - np.bincount(context, counts, minlength=span) + DISCOUNT * np.bincount(context, minlength=span)
        prob, prob_step = codes((counts - DISCOUNT) / often[context])
        back, back_step = codes(rest / often)
        steps = (prob_step, back_step)
    ef = EliasFano.build(keys, span * scale)
    os.makedirs(folder, exist_ok=True)
    prefix = f"{folder}/{shard}"
    ef.save(prefix)
    for name, values in (("count", narrow(counts)), ("prob", prob), ("back", back), ("steps", np.array(steps))):
        store(f"{prefix}-{name}.npy", values)
    return ef.size, ef.width, total


def context_counts(level: Level, begin: int, end: int) -> np.ndarray:
    """Counts of the ids from begin to end, which may lie in several shards."""
    bases = level.bases
    parts = [np.empty(0, np.int64)]
    for shard in range(len(level.sizes)):
        a, b = max(begin, int(bases[shard])), min(end, int(bases[shard + 1]))
        if a < b:
            parts.append(level.part(shard)[1]["count"][a - bases[shard] : b - bases[shard]])
    return np.concatenate(parts)


def train(docs: DataFrame, path: str, order: int = ORDER, column: str = "text", least: int = LEAST) -> Model:
    """A model of all whole texts of `docs`, its files below `path` in the shared folder.

    It holds every n-gram of the texts; a larger `least` leaves out rarer ones of two words or more.
    There are as many shards as the texts have `SHARD_BYTES`, so a shard does not grow with the input.
    """
    ship(docs.sparkSession)
    texts = docs.select(text_of(column).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    model = Model()
    for _ in range(order):
        model = grow(texts, model, path, max(1, -(-total // SHARD_BYTES)), least)
    return model


def score_texts(model: Model, texts: list[str]) -> list[np.ndarray]:
    """Tokens, known tokens, base score and score of each text."""
    prob = np.empty(0)
    base = np.empty(0)
    for number, _, found in contexts_of(model, texts):
        if number == 1:
            lengths, known = found["lengths"], found["count"] > 0
            prob = (found["count"] + ADDED) / (model.tokens + ADDED * (model.words + 1))
            base = np.log10(prob)
            continue
        known_here, which, looked = found["known"], found["which"], found["found"]
        prob[known_here] = looked["prob"][which] + looked["back"][which] * prob[known_here]
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    sums = [np.add.reduceat(v, starts) for v in (known.astype(np.int64), base, np.log10(prob))]
    return [lengths, *sums]


SCORES = "struct<n_tokens:bigint,n_known:bigint,base_score:double,score:double>"


def with_scores(docs: DataFrame, model: Model, into: str, column: str = "text") -> DataFrame:
    """Adds a struct: tokens with the end, known ones, log10 of unigrams, log10 of the whole model.

    Null and empty texts have one token, the end. Other columns stay; no shuffle. An empty training
    set leaves every token unknown and both scores at zero.
    """
    ship(docs.sparkSession)
    names = ("n_tokens", "n_known", "base_score", "score")

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = [score_texts(model, part) for part in slices(texts, SLICE)]
            columns = [pa.array(np.concatenate([r[k] for r in rows])) for k in range(4)] if rows else [pa.array([], pa.int64())] * 2 + [pa.array([], pa.float64())] * 2
            yield pa.StructArray.from_arrays(columns, names=list(names))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(into, F.arrow_udf(run, SCORES)(text_of(column)))


def held_out(every: int, column: str = "doc_id") -> Column:
    """True for ids whose checksum is divisible; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % every == 0, F.lit(False))


def op7(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs.where(~held_out(10)), scratch(spark, "language-model"))
    scored = with_scores(docs, model, "scores")
    return scored.select(
        "doc_id",
        held_out(10).alias("held_out"),
        "scores.n_tokens",
        "scores.n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "scores.base_score",
        "scores.score",
    )


