"""Byte pair encoding and decoding over a pair occurrence index.

The distinct pieces of a slice of texts are laid end to end, cut into words. An index maps each mergeable pair to
all its positions there; a heap holds the ranks that occur. The lowest rank is taken off, all its
positions are merged at once, and only the positions beside a merge enter the index again.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickwell.llm.common import slices, table, text_of
from tickwell.shipping import ship

VOCABULARY = "word_bpe_49k.json"
#: Characters of text whose new words are encoded together.
SLICE = 2_000_000
#: Pieces remembered between slices; beyond it a worker starts afresh.
REMEMBERED = 150_000

# Fixed values of the vocabulary's word pattern: contractions, letters, one digit, the rest.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Past these letters the character tables of Python, its regex module and the vocabulary's library
#: belong to different Unicode versions; there the library itself cuts and lower-cases. Separators
#: that only Python takes for white space are treated alike.
FOREIGN = regex.compile(r"[^\x00-\u052f]")
CONTROL = regex.compile(r"[\x1c-\x1f]")

RESULT = "struct<ids:array<int>,decoded:string>"


def byte_characters() -> list[str]:
    """The printable stand-in of each byte: itself where it prints, else the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


class Merges:
    """Vocabulary and ranked pairs as arrays."""

    def __init__(self, source: bytes) -> None:
        read = json.loads(source)
        model = read["model"]
        vocabulary = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in read["added_tokens"]}
        self.tokens = [""] * (1 + max(*vocabulary.values(), *self.special.values()))
        for token, number in chain(vocabulary.items(), self.special.items()):
            self.tokens[number] = token
        self.width = len(self.tokens)
        shown = byte_characters()
        self.inner = np.array([vocabulary[c] for c in shown])
        self.final = np.array([vocabulary[c + self.end] for c in shown])
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.left = np.array([vocabulary[a] for a, _ in pairs])
        self.right = np.array([vocabulary[b] for _, b in pairs])
        self.made = np.array([vocabulary[a + b] for a, b in pairs])
        codes = self.left * self.width + self.right
        self.order = np.argsort(codes, kind="stable")
        self.codes = codes[self.order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the pair never merges."""
        codes = left * self.width + right
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.order[at], -1)


class PairIndex:
    """All positions of each active pair in a run of words."""

    def __init__(self, merges: Merges, words: list[bytes]) -> None:
        self.merges = merges
        flat = np.frombuffer(b"".join(words), np.uint8)
        self.ends = np.cumsum([len(w) for w in words])
        last = self.ends - 1
        self.symbol = merges.inner[flat]
        self.symbol[last] = merges.final[flat[last]]
        count = len(flat)
        self.after = np.arange(1, count + 1)
        self.after[last] = -1
        self.before = np.arange(-1, count - 1)
        self.before[np.concatenate(([0], self.ends[:-1]))] = -1
        self.alive = np.ones(count, bool)
        self.lists: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self.enter(np.flatnonzero(self.after >= 0))

    def enter(self, places: np.ndarray) -> None:
        """Puts the pairs that start at these places into the lists of their ranks."""
        ranks = self.merges.ranks(self.symbol[places], self.symbol[self.after[places]])
        places, ranks = places[ranks >= 0], ranks[ranks >= 0]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        first = np.flatnonzero(np.concatenate(([True], ranks[1:] != ranks[:-1])))
        bounds = np.append(first, len(ranks)).tolist()
        for k, rank in enumerate(ranks[first].tolist()):
            held = self.lists.get(rank)
            if held is None:
                self.lists[rank] = held = []
                heapq.heappush(self.active, rank)
            held.append(places[bounds[k] : bounds[k + 1]])

    def merge_all(self) -> None:
        while self.active:
            rank = heapq.heappop(self.active)
            self.merge(rank, self.lists.pop(rank))

    def merge(self, rank: int, lists: list[np.ndarray]) -> None:
        left, right = self.merges.left[rank], self.merges.right[rank]
        places = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        after = self.after[places]
        # A listed place may have been swallowed or changed since it was entered.
        good = self.alive[places] & (self.symbol[places] == left) & (after >= 0)
        good &= self.symbol[after] == right
        places, after = places[good], after[good]
        if left == right and len(places) > 1:
            # In a run of equal symbols every second pair merges, from the left.
            starts = np.concatenate(([True], after[:-1] != places[1:]))
            number = np.arange(len(places))
            run = np.maximum.accumulate(np.where(starts, number, 0))
            keep = (number - run) % 2 == 0
            places, after = places[keep], after[keep]
        if not len(places):
            return
        following = self.after[after]
        self.symbol[places] = self.merges.made[rank]
        self.alive[after] = False
        self.after[places] = following
        inside = following >= 0
        self.before[following[inside]] = places[inside]
        preceding = self.before[places]
        self.enter(np.unique(np.concatenate((preceding[preceding >= 0], places[inside]))))

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words in order, and how many each word has."""
        upto = np.cumsum(self.alive)[self.ends - 1]
        return self.symbol[self.alive], np.diff(upto, prepend=0)


class Encoder:
    """Encodes texts piece by piece between blanks, remembering the pieces it has seen."""

    def __init__(self, source: bytes) -> None:
        self.merges = Merges(source)
        reader = Tokenizer.from_buffer(source)
        self.normalizer, self.cutter = reader.normalizer, reader.pre_tokenizer[0]
        names = sorted(self.merges.special, key=len, reverse=True)
        self.mark = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.forget()

    def forget(self) -> None:
        """Only the special tokens are known, each as a piece that is never cut."""
        special = self.merges.special
        self.known = {name: k for k, name in enumerate(special)}
        self.ids = np.fromiter(special.values(), np.int32, len(special))
        self.starts = np.arange(len(special))
        self.counts = np.ones(len(special), np.int64)

    def learn(self, pieces: list[str]) -> None:
        if not pieces:
            return
        words = [self.words(p) for p in pieces]
        index = PairIndex(self.merges, [w.encode() for w in chain.from_iterable(words)])
        index.merge_all()
        new, per_word = index.result()
        upto = np.concatenate(([0], np.cumsum(per_word)))
        ends = upto[np.cumsum([len(w) for w in words])]
        counts = np.diff(ends, prepend=0)
        base = len(self.known)
        self.known.update(zip(pieces, range(base, base + len(pieces)), strict=True))
        self.starts = np.concatenate((self.starts, len(self.ids) + ends - counts))
        self.counts = np.concatenate((self.counts, counts))
        self.ids = np.concatenate((self.ids, new.astype(np.int32)))

    def pieces(self, text: str) -> list[str]:
        """What stands between blanks, special tokens apart."""
        if self.mark is None or not self.mark.search(text):
            return self.cut(text)
        found: list[str] = []
        for k, part in enumerate(self.mark.split(text)):
            found += [part] if k % 2 else self.cut(part)
        return found

    def cut(self, text: str) -> list[str]:
        """Composed and lower-cased by single characters, so a final sigma has no form of its own."""
        if not text.isascii() and FOREIGN.search(text) or CONTROL.search(text):
            return [p for p in self.normalizer.normalize_str(text).split(" ") if p]
        return unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower().split()

    def words(self, piece: str) -> list[str]:
        if not piece.isascii() and FOREIGN.search(piece):
            return [word for word, _ in self.cutter.pre_tokenize_str(piece)]
        return WORD.findall(piece)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.forget()
        split = [self.pieces(t) for t in texts]
        known = self.known
        self.learn(list(dict.fromkeys(p for s in split for p in s if p not in known)))
        for pieces in split:
            at = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
            counts = self.counts[at]
            upto = np.cumsum(counts)
            total = int(upto[-1]) if len(at) else 0
            # Start of each piece's ids, less the ids that came before it, plus a running number.
            yield self.ids[np.repeat(self.starts[at] - (upto - counts), counts) + np.arange(total)]

    def decode(self, ids: np.ndarray) -> str:
        """Token texts joined by one blank; the vocabulary names no decoder of its own."""
        return " ".join(map(self.merges.tokens.__getitem__, ids.tolist()))


def tokenize(
    docs: DataFrame, source: bytes, column: str = "text", into: str = "tokens", decode: bool = True
) -> DataFrame:
    """Adds `into`: the token ids of the whole text and, if asked for, the text decoded from them.

    Null and empty texts give no ids and an empty decoded text. Very long texts are encoded whole.
    All other columns stay as they are; a column already called `into` is replaced. No shuffle, and
    a lost task is simply run again.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(source)

    kind = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(shared.value)

        def made(ids: list[np.ndarray]) -> pa.StructArray:
            ends = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))
            texts = pa.array([encoder.decode(i) if decode else None for i in ids], pa.string())
            return pa.StructArray.from_arrays([lists, texts], fields=list(kind))

        for texts in batches:
            # Each slice is handed on as soon as it is done, so no results pile up.
            for part in slices(texts, SLICE):
                yield made(list(encoder.encode(part)))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(into, F.arrow_udf(run, RESULT)(text_of(column)))


def vocabulary(path: str | None = None) -> bytes:
    """The vocabulary file, read on the driver; its size is fixed and it is broadcast."""
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as file:
        return file.read()


def op3(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = tokenize(docs, vocabulary())
    return found.select(
        "doc_id",
        F.size("tokens.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("tokens.ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("tokens.decoded", 256).alias("decoded_sha256"),
    )
