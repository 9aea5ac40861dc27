"""Quality rules: counts of each text, and a decision list learned from labelled documents.

The list is learned by sequential covering. Each round grows one conjunction of thresholds on two
thirds of the rows that no rule covers yet, cuts it back on the other third, and keeps it if it is
precise there. The rules become one ordered conditional expression.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.llm.common import free_name, one_text_each, table, text_of
from tickwell.shipping import ship

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
FEWEST_WORDS = 20
MOST_REPEATED = 30

#: Labelled rows that a list is learned from at most, taken by the hash of their id.
SAMPLE = 20_000
#: A rule is kept if it is that precise on rows that did not grow it, and covers that many.
PRECISION = 0.95
COVERED = 8
MOST_RULES = 24
MOST_CONDITIONS = 4
CUTS = 48

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct",
)
#: What rules may test: each is a ratio of two counts, so that length alone decides nothing.
RATIOS = {
    "symbols": ("n_symbols", "word_chars"),
    "upper": ("n_upper", "word_chars"),
    "digits": ("n_digits", "word_chars"),
    "marks": ("n_marks", "word_chars"),
    "word_length": ("word_chars", "n_words"),
    "duplicate_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "distinct_words": ("n_distinct", "n_words"),
    "line_length": ("n_words", "n_lines"),
}
SPACE_CHARACTERS = " \t\n\v\f\r"
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
MARKS = b"!?;:|"


def repeated(words: list[bytes]) -> tuple[int, int]:
    """Words inside a window that occurs twice or more, and distinct words.

    Windows are numbered by doubling: equal pairs of words, then of pairs, then of those, so equal
    numbers mean equal windows.
    """
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    if len(index) == len(words) or len(words) < WINDOW + 1:
        return 0, len(index)
    span = 1
    while span < WINDOW:
        joined = ids[:-span] * (len(words) + 1) + ids[span:]
        seen, ids = np.unique(joined, return_inverse=True)
        if len(seen) == len(joined):
            return 0, len(index)
        span *= 2
    often = np.bincount(ids)[ids] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(often)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum()), len(index)


def counts_of(text: str) -> tuple[int, ...]:
    data = text.encode()
    words = data.split()
    lines = Counter(line for line in data.split(b"\n") if line.strip())
    again, distinct = repeated(words)
    return (
        len(words),
        len(text) - sum(map(text.count, SPACE_CHARACTERS)),
        sum(map(text.count, SYMBOLS)),
        lines.total() - len(lines),
        again,
        lines.total(),
        len(data) - len(data.translate(None, UPPER)),
        len(data) - len(data.translate(None, DIGITS)),
        len(data) - len(data.translate(None, MARKS)),
        distinct,
    )


def with_counts(docs: DataFrame, into: str, column: str = "text") -> DataFrame:
    """Adds a struct of counts of the whole text; null and empty texts give zeros."""
    ship(docs.sparkSession)
    kind = pa.struct([(c, pa.int64()) for c in COUNTS])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = np.array([counts_of(t.as_py() or "") for t in texts], np.int64)
            columns = [pa.array(c) for c in rows.reshape(-1, len(COUNTS)).T]
            yield pa.StructArray.from_arrays(columns, fields=list(kind))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    shape = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"
    return docs.withColumn(into, F.arrow_udf(run, shape)(text_of(column)))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return values[self.feature] > self.cut if self.above else values[self.feature] <= self.cut

    def column(self, counts: str) -> Column:
        top, bottom = (F.col(f"`{counts}`.{c}") for c in RATIOS[self.feature])
        ratio = F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))
        return ratio > F.lit(self.cut) if self.above else ratio <= F.lit(self.cut)


Rule = tuple[Condition, ...]


def covers(rule: Rule, values: dict[str, np.ndarray], size: int) -> np.ndarray:
    hit = np.ones(size, bool)
    for condition in rule:
        hit &= condition.holds(values)
    return hit


def grow(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Adds the threshold with the highest gain in information until no good row is covered."""
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < MOST_CONDITIONS and (~bad & inside).any():
        p, n = (bad & inside).sum(), (~bad & inside).sum()
        best, gain = None, 0.0
        for feature, column in values.items():
            kept, labels = column[inside], bad[inside]
            cuts = np.unique(np.quantile(kept, np.linspace(0, 1, CUTS), method="lower"))
            order = np.argsort(kept, kind="stable")
            below = np.searchsorted(kept[order], cuts, side="right")
            # The threshold lies half way to the next value, which leaves both sides some room.
            higher = kept[order][np.minimum(below, len(kept) - 1)]
            cuts = (cuts + higher) / 2
            bad_below = np.concatenate(([0], np.cumsum(labels[order])))[below]
            good_below = below - bad_below
            for above, ps, ns in ((False, bad_below, good_below), (True, p - bad_below, n - good_below)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gains = ps * (np.log2(ps / (ps + ns)) - np.log2(p / (p + n)))
                gains = np.nan_to_num(gains, nan=0.0, neginf=0.0)
                k = int(np.argmax(gains))
                if gains[k] > gain + 1e-9:
                    best, gain = Condition(feature, above, float(cuts[k])), float(gains[k])
        if best is None:
            break
        rule += (best,)
        inside &= best.holds(values)
    return rule


def prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Drops final conditions for as long as the rule does no worse on rows it was not grown on."""

    def worth(r: Rule) -> float:
        hit = covers(r, values, len(bad))
        p, n = (bad & hit).sum(), (~bad & hit).sum()
        return (p - n) / (p + n) if p + n else -1.0

    while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
        rule = rule[:-1]
    return rule


def learn(values: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Ordered rules that reject; rows that none covers are kept. No bad rows give no rules."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    third = np.arange(len(bad)) % 3 == 0
    while len(rules) < MOST_RULES and (bad & left).sum() >= COVERED:
        part = {True: left & third, False: left & ~third}
        pick = {k: {f: v[m] for f, v in values.items()} for k, m in part.items()}
        rule = prune(grow(pick[False], bad[part[False]]), pick[True], bad[part[True]])
        hit = covers(rule, values, len(bad)) & left
        # The test also counts rows that grew the rule, so that a small third does not decide alone.
        checked = hit & third
        precise = (bad & hit).sum() >= PRECISION * hit.sum() and (bad & checked).sum() >= PRECISION * checked.sum()
        if not rule or not precise or hit.sum() < COVERED:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def verdict(rules: list[Rule], counts: str) -> Column:
    """The decision list as one ordered conditional: the first rule that holds rejects."""
    if not rules:
        return F.lit(True)
    chain = F
    for rule in rules:
        holds = rule[0].column(counts)
        for condition in rule[1:]:
            holds = holds & condition.column(counts)
        chain = chain.when(holds, F.lit(False))
    return chain.otherwise(F.lit(True))


def base_failed(counts: str) -> Column:
    words, again = F.col(f"`{counts}`.n_words"), F.col(f"`{counts}`.n_repeat_words")
    return (words < FEWEST_WORDS) | (100 * again > MOST_REPEATED * words)


def learned_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """Rules from at most `sample` labelled documents.

    The labels are chosen by the hash of their id, so the choice does not depend on row order; their
    number is bounded, so they are broadcast, and only their documents are read by Python. Labels
    that are null, and documents that the base rules reject anyway, teach nothing. Of rows that share a
    doc_id one text is taken, so the bound holds for rows.
    """
    chosen = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    known = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    known = one_text_each(known, "doc_id", "quality")
    counted = with_counts(known, "counted").where(~base_failed("counted"))
    rows = counted.select("doc_id", "quality", "counted.*").toPandas()
    rows = rows.sort_values(["doc_id", *COUNTS], kind="stable", ignore_index=True)
    if rows.empty:
        return []
    order = np.random.default_rng(1).permutation(len(rows))
    rows = rows.iloc[order]
    values = {}
    for feature, (top, bottom) in RATIOS.items():
        over = rows[bottom].to_numpy(float)
        values[feature] = np.divide(rows[top].to_numpy(float), over, out=np.zeros(len(rows)), where=over > 0)
    return learn(values, rows["quality"].to_numpy() == 0)


def judge(docs: DataFrame, rules: list[Rule], into: str) -> DataFrame:
    """Adds a struct: the counts, `base_failed`, and `kept`, which is false where the base fails.

    Null and empty texts have no words and fail the base. Repeated rows are judged one by one and
    alike. Other columns are left alone; `into` should be a free name. No shuffle.
    """
    counts = free_name(docs, "counts_")
    counted = with_counts(docs, counts)
    failed = base_failed(counts)
    kept = ~failed & verdict(rules, counts)
    judged = F.struct(F.col(f"`{counts}`.*"), failed.alias("base_failed"), kept.alias("kept"))
    return counted.withColumn(into, judged).drop(counts)


def keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The documents that the rules keep, with the columns they came with."""
    name = free_name(docs, "judged_")
    return judge(docs, rules, name).where(F.col(f"`{name}`.kept")).drop(name)


def op5(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = judge(docs.select("doc_id", "text"), learned_rules(docs, labels), "judged")
    return found.select(
        "doc_id", *[f"judged.{c}" for c in COUNTS[:5]], "judged.base_failed", "judged.kept"
    )


