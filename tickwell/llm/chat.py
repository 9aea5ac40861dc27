"""Preference formatting: one prompt and two masked completions for each pair of conversations.

The prompt is the longest run of turns with which both conversations begin. It is rendered once; what
follows on either side is that side's completion, and a mask says which of its characters are trained
on: what the assistant says, with the line break that ends it. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwell.llm.common import table

CHOSEN, REJECTED, PROMPT = "chosen", "rejected", "prompt"
ASSISTANT = "assistant"


def header(role: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


def aligned(sides: DataFrame) -> DataFrame:
    """One row for each pair and place: the turn of either side, and whether they are the same.

    A place is a turn number, with a running number where a side repeats one; such turns are ordered
    by role and text. Turns without a number come last.
    """
    clean = sides.where("pair_id is not null").select(
        "pair_id",
        "side",
        F.col("turn").isNull().alias("unplaced"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(0)).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    same_turn = Window.partitionBy("pair_id", "side", "unplaced", "turn").orderBy("role", "text")
    numbered = clean.withColumn("place", F.struct("unplaced", "turn", F.row_number().over(same_turn).alias("tie")))
    of = {s: F.max(F.when(F.col("side") == s, F.struct("role", "text"))).alias(s) for s in (CHOSEN, REJECTED)}
    both = numbered.groupBy("pair_id", "place").agg(of[CHOSEN], of[REJECTED])
    return both.withColumn("same", F.col(CHOSEN).eqNullSafe(F.col(REJECTED)))


def segments(sides: DataFrame) -> DataFrame:
    """(pair_id, part, place, rendered, begin, end, trained): every rendered turn with its characters.

    `sides`: pair_id, side ('chosen' or 'rejected'), turn, role, text. Pairs whose sides are equal state
    no preference and are left out, as are rows without a pair. Null roles and texts are empty ones.
    """
    places = aligned(sides)
    parting = places.where(~F.col("same")).groupBy("pair_id").agg(F.min("place").alias("parting"))
    known = places.join(parting, "pair_id")
    parts = F.when(
        F.col("place") < F.col("parting"), F.array(F.struct(F.lit(PROMPT).alias("part"), F.col(CHOSEN).alias("said")))
    ).otherwise(
        F.filter(
            F.array(*[F.struct(F.lit(s).alias("part"), F.col(s).alias("said")) for s in (CHOSEN, REJECTED)]),
            lambda p: p["said"].isNotNull(),
        )
    )
    said = known.select("pair_id", "place", F.inline(parts))
    rendered = said.select(
        "pair_id",
        "part",
        "place",
        F.concat(header(F.col("said.role")), "said.text", F.lit("\n")).alias("rendered"),
        F.length(header(F.col("said.role"))).alias("head"),
        ((F.col("part") != PROMPT) & (F.col("said.role") == ASSISTANT)).alias("trained"),
    )
    run = Window.partitionBy("pair_id", "part").orderBy("place")
    placed = rendered.withColumn("end", F.sum(F.length("rendered").cast("long")).over(run))
    begin = F.col("end") - F.length("rendered") + F.col("head")
    return placed.select("pair_id", "part", "place", "rendered", begin.alias("begin"), "end", "trained")


def records(sides: DataFrame) -> DataFrame:
    """One row for each pair: prompt, completions, and their masks as begin:end, comma-joined.

    A record is a row, as a document is; it holds the turns of one pair and nothing else.
    """
    def in_order(value: Column) -> Column:
        return F.array_sort(F.collect_list(value))

    def texts(part: str) -> Column:
        some = in_order(F.when(F.col("part") == part, F.struct("place", "rendered")))
        return F.array_join(F.transform(some, lambda t: t["rendered"]), "").alias(part)

    def mask(part: str) -> Column:
        span = F.concat_ws(":", "begin", "end")
        some = in_order(F.when((F.col("part") == part) & F.col("trained"), F.struct("place", span.alias("span"))))
        return F.array_join(F.transform(some, lambda t: t["span"]), ",").alias(f"{part}_mask")

    return segments(sides).groupBy("pair_id").agg(
        F.count_if(F.col("part") == PROMPT).alias("n_prompt"),
        texts(PROMPT), texts(CHOSEN), texts(REJECTED), mask(CHOSEN), mask(REJECTED),
    )


def alternatives(conversations: DataFrame) -> DataFrame:
    """Both sides of a pair for each conversation: as it is, and with another's last answer.

    The rejected side takes the last answer of the conversation whose id differs in the lowest bit; if
    there is none, it goes without. An answer without a turn is before all others here.
    """
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("pair_id"), "turn", "role", "text"
    )
    answers = turns.where(F.col("role") == ASSISTANT)
    last = answers.groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    other = last.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("last.text").alias("other"), F.lit(True).alias("some"))
    chosen = turns.withColumn("side", F.lit(CHOSEN))
    joined = turns.join(last, "pair_id", "left").join(other, "pair_id", "left")
    ends = (F.col("role") == ASSISTANT) & F.struct("turn", "text").eqNullSafe(F.col("last"))
    changed = joined.where(~F.coalesce(ends, F.lit(False)) | F.col("some").isNotNull()).select(
        "pair_id", "turn", "role", F.when(F.coalesce(ends, F.lit(False)), F.col("other")).otherwise(F.col("text")).alias("text"), F.lit(REJECTED).alias("side")
    )
    return chosen.unionByName(changed)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(alternatives(table(spark, sf_dir, "conversations")))


OP4_SQL = """
WITH turns AS (SELECT conv_id AS pair_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
last AS (SELECT pair_id, max({'turn': turn, 'text': text}) AS last FROM turns WHERE role = 'assistant' GROUP BY pair_id),
sides AS (
  SELECT pair_id, turn, role, text, 'chosen' AS side FROM turns
  UNION ALL
  SELECT t.pair_id, t.turn, t.role, CASE WHEN e THEN o.last.text ELSE t.text END, 'rejected'
  FROM (SELECT t.*, coalesce(t.role = 'assistant' AND {'turn': t.turn, 'text': t.text} = l.last, false) AS e
        FROM turns t LEFT JOIN last l ON l.pair_id = t.pair_id) t
  LEFT JOIN last o ON o.pair_id = xor(t.pair_id, 1)
  WHERE NOT e OR o.pair_id IS NOT NULL
), numbered AS (
  SELECT pair_id, side, coalesce(turn, 2147483647) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY pair_id, side, coalesce(turn, 2147483647) ORDER BY coalesce(role, ''), coalesce(text, '')) AS tie
  FROM sides
), places AS (
  SELECT pair_id, turn, tie,
    max(CASE WHEN side = 'chosen' THEN role END) AS c_role, max(CASE WHEN side = 'chosen' THEN text END) AS c_text,
    max(CASE WHEN side = 'rejected' THEN role END) AS r_role, max(CASE WHEN side = 'rejected' THEN text END) AS r_text
  FROM numbered GROUP BY ALL
), parting AS (
  SELECT pair_id, min(turn * 100000 + tie) AS parting FROM places
  WHERE c_role IS DISTINCT FROM r_role OR c_text IS DISTINCT FROM r_text GROUP BY pair_id
), parts AS (
  SELECT pair_id, turn, tie, 'prompt' AS part, c_role AS role, c_text AS text
  FROM places JOIN parting USING (pair_id) WHERE turn * 100000 + tie < parting
  UNION ALL
  SELECT pair_id, turn, tie, 'chosen', c_role, c_text
  FROM places JOIN parting USING (pair_id) WHERE turn * 100000 + tie >= parting AND c_role IS NOT NULL
  UNION ALL
  SELECT pair_id, turn, tie, 'rejected', r_role, r_text
  FROM places JOIN parting USING (pair_id) WHERE turn * 100000 + tie >= parting AND r_role IS NOT NULL
), placed AS (
  SELECT *, '<|' || role || '|>' || chr(10) || text || chr(10) AS rendered,
    sum(length(role) + length(text) + 6) OVER (PARTITION BY pair_id, part ORDER BY turn, tie) AS end_
  FROM parts
)
SELECT pair_id, count(*) FILTER (part = 'prompt') AS n_prompt,
  coalesce(string_agg(rendered, '' ORDER BY turn, tie) FILTER (part = 'prompt'), '') AS prompt,
  coalesce(string_agg(rendered, '' ORDER BY turn, tie) FILTER (part = 'chosen'), '') AS chosen,
  coalesce(string_agg(rendered, '' ORDER BY turn, tie) FILTER (part = 'rejected'), '') AS rejected,
  coalesce(string_agg((end_ - length(text) - 1)::BIGINT || ':' || end_::BIGINT, ',' ORDER BY turn, tie)
    FILTER (part = 'chosen' AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg((end_ - length(text) - 1)::BIGINT || ':' || end_::BIGINT, ',' ORDER BY turn, tie)
    FILTER (part = 'rejected' AND role = 'assistant'), '') AS rejected_mask
FROM placed GROUP BY pair_id
"""
