"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

A lexicon of words and word beginnings comes from labelled documents of one part of the sample; the
trees learn from another part, which the lexicon has not seen, and the calibration from a third.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.common import one_text_each, table, text_of
from tickwell.llm.language_model import held_out
from tickwell.shipping import ship

#: Labelled documents that a scorer learns from at most, taken by the hash of their id.
SAMPLE = 16_000
#: Terms of the lexicon at most, the fewest toxic documents a term occurs in, its least log-odds.
TERMS = 400
LEAST = 3
LEAST_ODDS = 1.5
#: Beginnings of words that are terms too, which catches inflected forms.
BEGINNINGS = (4, 5, 6)
TREES = 60
DEPTH = 3
RATE = 0.2
BINS = 32
SMOOTHING = 5.0
FEWEST = 10
#: Words between a term and a second-person word that still count as near.
NEAR = 4

# Second-person words of the corpus's languages, and letters that digits stand for.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur ya tu te toi vous votre vos ti tus usted ustedes vosotros du dich dir dein deine ihr euch euer".split()
)
STANDS_FOR = str.maketrans("013457@$!", "oieastasi")
EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
MIXED = re.compile(r"[^\W\d_][\d@$!*.\-_]+[^\W\d_]")
DRAWN = re.compile(r"([^\W\d_])\1\1")
MARKS = "!?"

FEATURES = (
    "log_words", "hits", "hit_share", "odds_sum", "odds_share", "odds_most", "distinct_hits", "near_second",
    "second_share", "capitals", "shouted", "marks", "mixed", "drawn",
)


def terms_of(word: str) -> list[str]:
    """The plain form of a word and its beginnings, marked as such."""
    plain = word.strip(EDGES).lower()
    if not plain.isalpha():
        plain = "".join(c for c in plain.translate(STANDS_FOR) if c.isalpha())
    if not plain:
        return []
    return [plain, *(plain[:n] + "*" for n in BEGINNINGS if len(plain) > n)]


def measure(text: str, lexicon: dict[str, float], known: dict[str, float]) -> list[float]:
    """The dense features of a text. `known` remembers the weight of words seen before."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    odds = []
    for word in words:
        weight = known.get(word)
        if weight is None:
            if len(known) > 500_000:
                known.clear()
            weight = known[word] = max((lexicon.get(t, 0.0) for t in terms_of(word)), default=0.0)
        odds.append(weight)
    weights = np.array(odds)
    at = np.flatnonzero(weights)
    n = len(words)
    letters = sum(map(len, words))
    second = np.array([k for k, w in enumerate(words) if len(w) < 12 and w.strip(EDGES).lower() in SECOND_PERSON])
    near = 0
    if len(at) and len(second):
        right = np.searchsorted(second, at)
        gap = np.minimum(
            np.abs(at - second[np.minimum(right, len(second) - 1)]), np.abs(at - second[np.maximum(right - 1, 0)])
        )
        near = int((gap <= NEAR).sum())
    return [
        np.log1p(n),
        min(len(at), 50),
        len(at) / n,
        min(weights.sum(), 200.0),
        weights.sum() / n,
        weights.max(),
        min(len({words[k] for k in at}), 50),
        near / n,
        len(second) / n,
        sum(map(str.isupper, text)) / letters,
        sum(len(w) > 2 and w.isupper() for w in words) / n,
        sum(map(text.count, MARKS)) / letters,
        len(MIXED.findall(text)) / n,
        len(DRAWN.findall(text)) / n,
    ]


@dataclass(frozen=True)
class Tree:
    """Nodes in level order: feature (-1 for a leaf), threshold, left child, value."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), np.int64)
        for _ in range(DEPTH):
            feature = self.feature[at]
            inner = feature >= 0
            right = rows[np.arange(len(rows)), np.maximum(feature, 0)] > self.cut[at]
            at = np.where(inner, self.left[at] + right, at)
        return self.value[at]


def grow(rows: np.ndarray, binned: np.ndarray, cuts: list[np.ndarray], slope: np.ndarray, curve: np.ndarray) -> Tree:
    """One tree on first and second derivatives, splitting at histogram borders."""
    nodes = [[-1, 0.0, 0, 0.0]]
    open_ = [(0, np.arange(len(rows)), 0)]
    while open_:
        node, at, depth = open_.pop(0)
        g, h = slope[at].sum(), curve[at].sum()
        nodes[node][3] = -RATE * g / (h + SMOOTHING)
        if depth == DEPTH or len(at) < 2 * FEWEST:
            continue
        best, found = 1e-6, None
        for f, borders in enumerate(cuts):
            if not len(borders):
                continue
            size = len(borders) + 1
            gs = np.cumsum(np.bincount(binned[at, f], slope[at], size))[:-1]
            hs = np.cumsum(np.bincount(binned[at, f], curve[at], size))[:-1]
            ns = np.cumsum(np.bincount(binned[at, f], minlength=size))[:-1]
            gain = gs**2 / (hs + SMOOTHING) + (g - gs) ** 2 / (h - hs + SMOOTHING) - g**2 / (h + SMOOTHING)
            gain = np.where((ns >= FEWEST) & (len(at) - ns >= FEWEST), gain, 0.0)
            k = int(np.argmax(gain))
            if gain[k] > best:
                best, found = float(gain[k]), (f, k)
        if found is None:
            continue
        f, k = found
        side = binned[at, f] <= k
        nodes[node][:3] = [f, float(cuts[f][k]), len(nodes)]
        open_ += [(len(nodes), at[side], depth + 1), (len(nodes) + 1, at[~side], depth + 1)]
        nodes += [[-1, 0.0, 0, 0.0], [-1, 0.0, 0, 0.0]]
    feature, cut, left, value = zip(*nodes, strict=True)
    return Tree(np.array(feature), np.array(cut), np.array(left), np.array(value))


def boost(rows: np.ndarray, label: np.ndarray) -> tuple[float, list[Tree]]:
    """Trees that follow the slope of the logistic loss."""
    share = np.clip(label.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    cuts = []
    for column in rows.T:
        values = np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1), method="lower"))
        cuts.append((values[1:] + values[:-1]) / 2)
    binned = np.stack([np.searchsorted(c, column) for c, column in zip(cuts, rows.T, strict=True)], axis=1)
    raw, trees = np.full(len(rows), start), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        trees.append(grow(rows, binned, cuts, p - label, p * (1 - p)))
        raw += trees[-1](rows)
    return start, trees


def isotonic(raw: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps through the labels by pooling neighbours that fall; the knots to draw between."""
    order = np.argsort(raw, kind="stable")
    pools: list[list[float]] = []
    for x, y in zip(raw[order].tolist(), label[order].tolist(), strict=True):
        pools.append([y, 1.0, x, x])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            y1, n1, _, last = pools.pop()
            y0, n0, first, _ = pools.pop()
            pools.append([(y0 * n0 + y1 * n1) / (n0 + n1), n0 + n1, first, last])
    xs = [x for p in pools for x in (p[2], p[3])]
    ys = [p[0] for p in pools for _ in range(2)]
    return np.array(xs), np.array(ys)


@dataclass
class Scorer:
    lexicon: dict[str, float]
    start: float
    trees: list[Tree]
    knots: tuple[np.ndarray, np.ndarray] | None
    known: dict[str, float]

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.start + sum((t(rows) for t in self.trees), np.zeros(len(rows)))

    def score(self, texts: list[str]) -> np.ndarray:
        rows = np.array([measure(t, self.lexicon, self.known) for t in texts]).reshape(-1, len(FEATURES))
        raw = self.raw(rows)
        if self.knots is None:
            return 1 / (1 + np.exp(-raw))
        # A little of the raw order stays inside each step, so that ranks are not lost.
        step = np.interp(raw, *self.knots)
        return np.clip(0.98 * step + 0.02 / (1 + np.exp(-raw)), 0.0, 1.0)


def odds_of(counts: pd.DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """Log-odds of the terms that tell most, smoothed by half a document."""
    pos, neg = counts["pos"].to_numpy(float), counts["neg"].to_numpy(float)
    odds = np.log((pos + 0.5) / (toxic + 1)) - np.log((neg + 0.5) / (clean + 1))
    telling = odds - 1.5 * np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))
    good = np.flatnonzero((pos >= LEAST) & (odds >= LEAST_ODDS) & (telling > 0))
    names = counts["term"].to_numpy()
    chosen = sorted(good.tolist(), key=lambda k: (-telling[k] * np.sqrt(pos[k]), names[k]))[:TERMS]
    return {names[k]: float(odds[k]) for k in chosen}


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Scorer:
    """A scorer from at most `sample` labelled documents; null labels and ids teach nothing.

    Which documents are taken depends on their ids alone; of rows that share one, one text is taken, so
    the bound holds for rows. Features count at most 50 hits, and 200 of summed odds. Term counts are summed for each batch of
    texts before they move. Without labels of both kinds the score is the share of toxic ones.
    """
    ship(docs.sparkSession)
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("double").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
        .withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(10)))
    )
    known = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    known = one_text_each(known, "doc_id", "toxic", "part")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[float, Counter] = {0.0: Counter(), 1.0: Counter()}
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                words = set((text.as_py() or "").split())
                seen[float(toxic > 0)].update({t for w in words for t in terms_of(w)})
            terms = list(seen[0.0] | seen[1.0])
            columns = [pa.array([seen[k][t] for t in terms], pa.int64()) for k in (1.0, 0.0)]
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *columns], ["term", "pos", "neg"])

    first = known.where("part < 4")
    counted = first.select("text", "toxic").mapInArrow(count, "term string, pos bigint, neg bigint")
    counts = counted.groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where(F.col("pos") >= LEAST)
    sizes = dict(chosen.where("part < 4").groupBy("toxic").count().collect())
    lexicon = odds_of(counts.toPandas(), sizes.get(1.0, 0), sizes.get(0.0, 0))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, float] = {}
        for batch in batches:
            rows = [measure(t.as_py() or "", lexicon, memory) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), *batch.columns[1:]], ["row", "toxic", "part", "doc_id"])

    rest = known.where("part >= 4").select("text", "toxic", "part", "doc_id")
    rows = rest.mapInArrow(features, "row array<double>, toxic double, part bigint, doc_id bigint").toPandas()
    rows = rows.sort_values("doc_id", kind="stable", ignore_index=True)
    if rows.empty or rows["toxic"].nunique() < 2:
        share = float(np.clip(rows["toxic"].mean() if len(rows) else 0.0, 1e-3, 1 - 1e-3))
        return Scorer(lexicon, float(np.log(share / (1 - share))), [], None, {})
    matrix, label, part = np.array(rows["row"].tolist()), rows["toxic"].to_numpy(), rows["part"].to_numpy()
    start, trees = boost(matrix[part < 8], label[part < 8]) if len(set(label[part < 8])) == 2 else (0.0, [])
    scorer = Scorer(lexicon, start, trees, None, {})
    if (part >= 8).any():
        scorer.knots = isotonic(scorer.raw(matrix[part >= 8]), label[part >= 8])
    return scorer


def with_scores(docs: DataFrame, scorer: Scorer, into: str, column: str = "text") -> DataFrame:
    """Adds the calibrated score, 0 to 1, of each whole text; null and empty texts score alike.

    Other columns stay and are not looked at. Repeated rows score alike. No shuffle.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(scorer.score([t.as_py() or "" for t in texts]), pa.float64())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(into, F.arrow_udf(run, "double")(text_of(column)))


def op8(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out(5))
    found = with_scores(docs, learn(docs, labels), "score")
    return found.select(
        "doc_id",
        held_out(5).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
