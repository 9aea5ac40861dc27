"""Log triage: pattern counts, line classes, last errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words looked for in log lines, and the class of a line by its first match.
ACTIVITY_WORDS = ("http_poller", "polling", "request", "response")
LINE_CLASSES = (
    ("pipeline_started", ("Starting pipeline",)),
    ("polling", ("Polling", "request")),
    ("data_received", ("response", "current_price", "symbol")),
    ("kafka", ("kafka", "Sent", "bootstrap")),
    ("error", ("ERROR",)),
    ("warning", ("WARN",)),
)


def any_word(line: Column, words: tuple[str, ...]) -> Column:
    found = F.contains(line, F.lit(words[0]))
    for word in words[1:]:
        found = found | F.contains(line, F.lit(word))
    return found


def pattern_counts(lines: DataFrame) -> DataFrame:
    lowered = F.lower("line")
    return lines.agg(
        F.count("*").alias("lines"),
        F.count_if(F.contains("line", F.lit("ERROR"))).alias("errors"),
        F.count_if(F.contains("line", F.lit("WARN"))).alias("warnings"),
        *[F.count_if(F.contains(lowered, F.lit(w))).alias(w) for w in ACTIVITY_WORDS],
    )


def line_class(line: Column) -> Column:
    (name, words), *rest = LINE_CLASSES
    chosen = F.when(any_word(line, words), name)
    for name, words in rest:
        chosen = chosen.when(any_word(line, words), name)
    return chosen.otherwise("other")


def class_counts(lines: DataFrame) -> DataFrame:
    return lines.groupBy(line_class(F.col("line")).alias("line_class")).agg(
        F.count("*").alias("lines")
    )


def last_matching(
    lines: DataFrame, word: str, k: int, order: tuple[str, ...], first: int = 1, last: int = 100
) -> DataFrame:
    """The last `k` lines with the word, cut to a column range."""
    found = lines.where(F.contains("line", F.lit(word)))
    return (
        found.orderBy(*[F.desc(c) for c in order])
        .limit(k)
        .select(*order, F.substring("line", first, last - first + 1).alias("line"))
    )
