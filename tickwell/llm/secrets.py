"""Secret scans over an incremental blob ledger.

Every text version is a blob, addressed by its content. The ledger remembers which blob was scanned
with which version of which rule; only unseen pairs are scanned, each blob once however many
documents hold it, and the findings are joined back to all of them. Built-in functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tickwell.llm.common import scratch, settle, table, text_of


@dataclass(frozen=True)
class Rule:
    """A pattern, the group whose length counts, and the characters it must have."""

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1


# Fixed values of the base rules; the last rule is an addition.
RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    # These two runs cannot be entered half way, so the least length can stand in the pattern.
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
    Rule("private", r"-----BEGIN(?: [A-Z0-9]+)* PRIVATE KEY-----", 0, 1),
)
BASE_RULES = 3

SCANNED = T.StructType(
    [
        T.StructField("blob", T.BinaryType()),
        T.StructField("kind", T.StringType()),
        T.StructField("version", T.IntegerType()),
    ]
)
FINDINGS = T.StructType(
    [
        *SCANNED.fields,
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)


class Ledger:
    """Two tables in a folder that all executors reach: pairs scanned, and what was found.

    Findings are written before the pairs that they belong to. A run that dies in between is repeated
    by the next one, and findings written twice are read once.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        # Empty appends, so that both tables can be read from the start.
        for name, schema in (("scanned", SCANNED), ("findings", FINDINGS)):
            spark.createDataFrame([], schema).write.mode("append").parquet(f"{self.path}/{name}")

    def scanned(self) -> DataFrame:
        return self.spark.read.schema(SCANNED).parquet(f"{self.path}/scanned")

    def findings(self) -> DataFrame:
        return self.spark.read.schema(FINDINGS).parquet(f"{self.path}/findings").distinct()

    def add(self, findings: DataFrame, scanned: DataFrame) -> None:
        findings.write.mode("append").parquet(f"{self.path}/findings")
        scanned.write.mode("append").parquet(f"{self.path}/scanned")


def address(column: str = "text") -> Column:
    return F.unhex(F.sha2(text_of(column), 256))


def rule_frame(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    return spark.createDataFrame([(r.kind, r.version) for r in rules], "kind string, version int")


def entry(rule: Rule):
    """What is kept of a match and its number."""

    def made(match: Column, at: Column) -> Column:
        return F.struct(
            F.lit(rule.kind).alias("kind"),
            F.lit(rule.version).alias("version"),
            at.alias("number"),
            F.length(F.get(f"{rule.kind}_parts", at)).cast("long").alias("before"),
            match.alias("match"),
        )

    return made


def of_rank(rank: int):
    return lambda span: span["rank"] == rank


def raw_hits(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, kind, version, number, before, size, good): the matches of each blob's `kinds`.

    `before` is what lies between a match and the one before it. Matches are found in one pass, and
    the text is split only where there are any.
    """
    found = blobs.select(
        "blob",
        "text",
        *[
            F.when(F.array_contains("kinds", r.kind), F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))).alias(r.kind)
            for r in rules
        ],
    )
    some = found.where(F.greatest(F.lit(0), *[F.size(F.coalesce(r.kind, F.array())) for r in rules]) > 0)
    parts = [F.when(F.size(r.kind) > 0, F.split("text", r.pattern, -1)).alias(f"{r.kind}_parts") for r in rules]
    split = some.select("blob", *[r.kind for r in rules], *parts)
    lists = [F.coalesce(F.transform(r.kind, entry(r)), F.array()) for r in rules]
    return split.select("blob", F.inline(F.concat(*lists)))


def spans(hits: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, kind, version, start, end) in code points, the end exclusive; short matches drop out."""
    size = F.length("match").cast("long")
    run = Window.partitionBy("blob", "kind", "version").orderBy("number")
    placed = hits.distinct().withColumn("upto", F.sum(F.col("before") + size).over(run))
    counted = F.lit(None).cast("int")
    least = F.lit(None).cast("int")
    for r in rules:
        inner = F.length(F.regexp_extract("match", r.pattern, r.group)) if r.group else size.cast("int")
        counted = F.when(F.col("kind") == r.kind, inner).otherwise(counted)
        least = F.when(F.col("kind") == r.kind, F.lit(r.least)).otherwise(least)
    return placed.where(counted >= least).select(
        "blob", "kind", "version", (F.col("upto") - size).alias("start"), F.col("upto").alias("end")
    )


def scan(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, blob, found) for every row of `docs`; found: array of (start, rank, end, kind).

    `found` is ordered by start, then by the order of the rules; it is empty for null and empty texts
    and where nothing is found. Rows with a null doc_id are scanned like others. Repeated rows and
    copies share a blob, which is scanned once. The texts move once, by document, so a blob that a
    third of all documents hold does not gather in one task.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", text_of().alias("text"))
    addressed = settle(rows.select("doc_id", address().alias("blob")), "addressed")
    blobs = addressed.groupBy("blob").agg(F.min("doc_id").alias("holder"))
    wanted = F.broadcast(rule_frame(spark, rules))
    seen = ledger.scanned().join(wanted, ["kind", "version"])
    seen = seen.groupBy("blob").agg(F.collect_set("kind").alias("seen"))
    every = F.array(*[F.lit(r.kind) for r in rules])
    unseen = (
        blobs.join(seen, "blob", "left")
        .withColumn("kinds", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))))
        .where(F.size("kinds") > 0)
        .select(F.col("blob").alias("blob_"), "holder", "kinds")
    )
    held = rows.withColumn("blob", address())
    same = F.col("doc_id").eqNullSafe(F.col("holder")) & (F.col("blob") == F.col("blob_"))
    texts = held.join(unseen.hint("shuffle_hash"), same).select("blob", "text", "kinds")
    fresh = spans(raw_hits(texts, rules), rules).distinct()
    pairs = unseen.select(F.col("blob_").alias("blob"), F.explode("kinds").alias("kind"))
    ledger.add(fresh, pairs.join(wanted, "kind").select("blob", "kind", "version"))

    rank = F.coalesce(*[F.when(F.col("kind") == r.kind, F.lit(k)) for k, r in enumerate(rules)])
    current = ledger.findings().join(wanted, ["kind", "version"])
    per_blob = current.groupBy("blob").agg(
        F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))).alias("found_")
    )
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    return addressed.join(per_blob, "blob", "left").select(
        "doc_id", "blob", F.coalesce("found_", none).alias("found")
    )


def listed(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    texts = F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(texts, ",")


def without_secrets(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents in whose text nothing is found, with the columns they came with.

    Rows without a doc_id are told apart by their content alone, as are rows that share a doc_id.
    """
    hit = scan(docs, ledger, rules).where(F.size("found") > 0)
    bad = hit.select(F.col("doc_id").alias("bad_id"), F.col("blob").alias("bad_blob")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("bad_id")) & (address() == F.col("bad_blob"))
    return docs.join(bad, same, "left_anti")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = Ledger(spark, scratch(spark, "blob-ledger"))
    rows = scan(table(spark, sf_dir, "documents"), ledger)
    base = F.filter("found", lambda s: s["rank"] < BASE_RULES)
    counts = [
        F.size(F.filter("found", of_rank(k))).cast("long").alias(f"n_{r.kind}")
        for k, r in enumerate(RULES[:BASE_RULES])
    ]
    return rows.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans")
    )
