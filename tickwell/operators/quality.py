"""Message-quality reports over a topic frame (`key, value, partition, offset, ...`)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.config import (
    CONTRACT_9,
    NUMBER_FIELDS,
    OPTIONAL_FIELDS,
    REQUIRED_FIELDS,
    VENDOR_NAMES,
    QUOTE_FIELDS_10,
)
from tickwell.functions import messages as M
from tickwell.operators.metering import metered
from tickwell.sources.durable import cut

ORDER = ("partition", "offset")
# Fields a valid message needs; common fields at least and others at most for one
# schema; shares of valid messages, in percent, of the two better tiers.
LEAST_VALID_FIELDS = 3
LEAST_COMMON, MOST_OTHERS = 3, 2
EXCELLENT, GOOD = 90, 70


def parse_quotes(
    topic: DataFrame, schema: str = QUOTE_FIELDS_10, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Key and value as text, the value decoded with a fixed schema and flattened."""
    parsed = topic.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("timestamp").alias("kafka_timestamp"),
        *keep,
        F.from_json(F.col("value").cast("string"), schema).alias("data"),
    ).select("kafka_key", "kafka_timestamp", *keep, "data.*")
    return metered(parsed, "parse_quotes", priced=F.col("current_price").isNotNull())


def parse_rate(parsed: DataFrame) -> DataFrame:
    usable = F.col("current_price").isNotNull() & F.col("symbol").isNotNull()
    return parsed.agg(
        F.count("*").alias("messages"),
        F.count_if(usable).alias("parsed"),
        F.round(F.try_divide(F.count_if(usable) * 100.0, F.count("*")), 4).alias("parse_rate"),
    )


def parsed_sample(parsed: DataFrame, n: int = 3) -> DataFrame:
    """The first usable quotes in topic order; `parsed` must carry partition and offset."""
    usable = F.col("current_price").isNotNull() & F.col("symbol").isNotNull()
    return (
        parsed.where(usable).orderBy(*ORDER).limit(n).select("symbol", "current_price", "timestamp")
    )


def check_messages(topic: DataFrame, symbols: tuple[str, ...]) -> DataFrame:
    """One verdict per message; a malformed one has a single issue and no field count."""
    text = topic.withColumn("value", F.col("value").cast("string"))
    doc = F.col("doc")
    opened = text.withColumn("doc", M.document(F.col("value"))).withColumns(
        {
            "kinds": M.kinds(doc),
            "symbol": M.field_text(doc, "symbol"),
            "price": M.field_number(doc, "current_price"),
            "stamp": M.field_text(doc, "timestamp"),
        }
    )
    parsed = doc.isNotNull()
    judged = opened.select(
        F.col("key").cast("string").alias("key"),
        "partition",
        "offset",
        "timestamp",
        parsed.alias("parsed"),
        F.when(parsed, F.length("value")).alias("size_chars"),
        F.when(parsed, M.valid_field_count("kinds")).alias("valid_fields"),
        F.when(parsed, F.lit(len(CONTRACT_9))).alias("total_expected"),
        F.when(parsed, M.message_issues("kinds", symbols))
        .otherwise(F.array(F.lit(M.MALFORMED)))
        .alias("issues"),
    )
    fine = (F.size("issues") == 0) & (F.col("valid_fields") >= LEAST_VALID_FIELDS)
    verdicts = judged.withColumn("is_valid", F.coalesce(fine, F.lit(False)))
    return metered(verdicts, "check_messages", valid=F.col("is_valid"))


def first_messages(topic: DataFrame, n: int) -> DataFrame:
    """The first messages in topic order, read until `n` are seen and the last one parses."""
    keyed = topic.select(
        *ORDER, M.document(F.col("value").cast("string")).isNotNull().alias("parsed")
    )
    reached = keyed.orderBy(*ORDER).limit(n).agg(
        F.count("*").alias("seen"), F.max(F.struct(*ORDER)).alias("at")
    ).first()
    if reached["seen"] < n:
        return topic
    position = F.struct(*ORDER)
    floor = F.struct(*[F.lit(v).cast(topic.schema[c].dataType) for c, v in zip(ORDER, reached["at"])])
    stop = keyed.where("parsed").where(position >= floor).agg(F.min(position).alias("at")).first()
    if stop["at"] is None:
        return topic
    last = F.struct(*[F.lit(v).cast(topic.schema[c].dataType) for c, v in zip(ORDER, stop["at"])])
    return topic.where(position <= last)


def summarise(checks: DataFrame) -> DataFrame:
    valid, total = F.count_if("is_valid"), F.count("*")
    return checks.agg(
        total.alias("total_messages"),
        valid.alias("valid_messages"),
        (total - valid).alias("invalid_messages"),
        F.coalesce(F.round(F.try_divide(valid * 100.0, total), 4), F.lit(0.0)).alias(
            "validity_rate"
        ),
        F.coalesce(
            F.round(F.try_divide(F.sum(F.coalesce("size_chars", F.lit(0))), total), 4), F.lit(0.0)
        ).alias("average_size"),
    )


def top_issues(checks: DataFrame, k: int = 3) -> DataFrame:
    return (
        checks.select(F.explode("issues").alias("issue"))
        .groupBy("issue")
        .agg(F.count("*").alias("occurrences"))
        .orderBy(F.desc("occurrences"), "issue")
        .limit(k)
    )


def sample_view(checks: DataFrame, n: int = 3, issues: int = 2) -> DataFrame:
    """The first verdicts with at most two issues each, as the report prints them."""
    return (
        checks.orderBy(*ORDER)
        .limit(n)
        .withColumn("issues", F.slice("issues", 1, issues))
    )


def field_commonality(topic: DataFrame) -> DataFrame:
    """How many parsed messages hold each field, and whether all of them do."""
    keys = F.array_distinct(F.json_object_keys(F.col("value").cast("string")))
    # Position 0 is a marker per parsed message, counted in the same aggregation as the
    # fields; malformed text has no position at all.
    marked = topic.select(
        F.posexplode_outer(F.array_prepend(keys, F.lit(None).cast("string"))).alias("at", "field")
    )
    counts = marked.groupBy("field", (F.col("at") == 0).alias("marker")).agg(
        F.count("*").alias("messages")
    )
    # One row per field name, stored so that the total does not read the topic again.
    counts = cut(counts)
    total = counts.where("marker").select("messages")
    return counts.where(~F.col("marker")).select(
        "field", "messages", (F.col("messages") == total.scalar()).alias("is_common")
    )


def schema_consistency(topic: DataFrame) -> DataFrame:
    """Fewer than three common fields, or more than two others, is an issue."""
    fields = field_commonality(topic).agg(
        F.count_if("is_common").alias("common_fields"),
        F.count_if(~F.col("is_common")).alias("other_fields"),
        F.sort_array(F.collect_list(F.when(F.col("is_common"), F.col("field")))).alias("common"),
    )
    return fields.withColumn(
        "issues",
        F.when(F.col("common_fields") + F.col("other_fields") == 0, F.array().cast("array<string>"))
        .otherwise(
            F.array_compact(
                F.array(
                    F.when(F.col("common_fields") < LEAST_COMMON, F.lit("too few common fields")),
                    F.when(F.col("other_fields") > MOST_OTHERS, F.lit("inconsistent schema")),
                )
            )
        ),
    )


def non_numeric_fields(topic: DataFrame) -> DataFrame:
    """Fields of all messages that should be numbers and are not."""
    doc = M.document(F.col("value").cast("string"))
    names = M.literals(NUMBER_FIELDS)
    # A plain inline lets the optimiser infer a filter on `seen` and push it, with the whole
    # parse, below every projection; the outer form infers none, and the list is never empty.
    named = (
        topic.withColumn("doc", doc)
        .select(*ORDER, F.arrays_zip(names.alias("field"), M.kinds(F.col("doc"), NUMBER_FIELDS).alias("kind")).alias("seen"))
        .select(*ORDER, F.inline_outer("seen"))
    )
    return named.where(F.col("kind").isNotNull() & (F.col("kind") != "number"))


def compatibility(topic: DataFrame, checks: DataFrame) -> DataFrame:
    """Verdict on the whole topic and its tier: excellent, good or problematic."""
    wrong = non_numeric_fields(topic).agg(F.count("*"))
    schema = schema_consistency(topic).select(F.struct("*"))
    facts = summarise(checks).select(
        "*", schema.scalar().alias("schema"), wrong.scalar().alias("type_issues")
    ).select("*", "schema.*")
    agrees = (
        (F.col("total_messages") > 0) & (F.size("issues") == 0) & (F.col("type_issues") == 0)
    )
    rate = F.col("validity_rate")
    return facts.select(
        "total_messages",
        "validity_rate",
        "common_fields",
        "other_fields",
        "type_issues",
        agrees.alias("compatible"),
        F.when((rate >= EXCELLENT) & agrees, "excellent")
        .when(rate >= GOOD, "good")
        .otherwise("problematic")
        .alias("tier"),
    )


def field_presence(topic: DataFrame) -> DataFrame:
    """Present and missing counts of the required and optional fields."""
    names = REQUIRED_FIELDS + OPTIONAL_FIELDS
    doc = topic.select(M.document(F.col("value").cast("string")).alias("doc"))
    flags = doc.select(M.present_flags(F.col("doc"), names).alias("flags"))
    counted = flags.agg(
        F.count("*").alias("_all"),
        *[F.count_if(F.col("flags")[i]).alias(n) for i, n in enumerate(names)],
    )
    entries = [
        F.struct(
            F.lit(n).alias("field"),
            F.lit(n in REQUIRED_FIELDS).alias("required"),
            F.col(n).alias("present"),
            (F.col("_all") - F.col(n)).alias("missing"),
        )
        for n in names
    ]
    return counted.select(F.inline(F.array(*entries)))


def critical_checks(topic: DataFrame, symbols: tuple[str, ...]) -> DataFrame:
    """Per-message checks of the three critical fields, on types and on raw text."""
    d = F.col("doc")
    read = (
        topic.select(*ORDER, M.document(F.col("value").cast("string")).alias("doc"))
        .select(
            *ORDER,
            M.kinds(d, ("symbol", "current_price")).alias("kinds"),
            M.field_number(d, "current_price").alias("number"),
            *[M.field_text(d, n).alias(n) for n in REQUIRED_FIELDS],
        )
    )

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    price, stamp = F.col("current_price"), F.col("timestamp")
    return read.select(
        *ORDER,
        flag(F.col("kinds")[0] == "string").alias("symbol_is_string"),
        flag((F.col("kinds")[1] == "number") & (F.col("number") > 0)).alias(
            "price_is_positive_number"
        ),
        flag(stamp.rlike(M.ISO_PREFIX)).alias("timestamp_is_iso"),
        flag(F.col("symbol").isin(*symbols)).alias("symbol_known"),
        flag(price.rlike(M.PRICE_TEXT) & (price.try_cast("double") > 0)).alias("price_text_ok"),
        flag(F.length(stamp) > 0).alias("timestamp_given"),
    )


def valid_structure(topic: DataFrame) -> DataFrame:
    """Whether every message is JSON and has a symbol and a price."""
    flags = M.present_flags(F.col("doc"), ("symbol", "current_price"))
    judged = topic.select(
        F.try_parse_json(F.col("value").cast("string")).isNotNull().alias("json"),
        M.document(F.col("value").cast("string")).alias("doc"),
    ).select("json", flags.alias("flags"))
    return judged.agg(
        F.coalesce(F.bool_and("json"), F.lit(True)).alias("valid_json"),
        F.coalesce(F.bool_and(F.col("flags")[0] & F.col("flags")[1]), F.lit(True)).alias(
            "valid_structure"
        ),
    )


def message_fields(topic: DataFrame) -> DataFrame:
    """Every field of every parsed message with its value as text and its JSON type."""
    doc = topic.select(*ORDER, M.document(F.col("value").cast("string")).alias("doc"))
    spark = topic.sparkSession
    entries = doc.lateralJoin(spark.tvf.variant_explode(F.col("doc").outer()))
    text = F.try_variant_get(F.col("value"), "$", "string")
    return entries.select(
        *ORDER, F.col("key").alias("field"), text.alias("text"), M.kind(F.col("value")).alias("kind")
    )


def field_types(topic: DataFrame) -> DataFrame:
    """Every field that occurs, the JSON types it has, and how often."""
    return message_fields(topic).groupBy("field", "kind").agg(F.count("*").alias("messages"))


def vendor_reply(raw: DataFrame, body: str = "body") -> DataFrame:
    """Size, field count and field types of raw vendor replies, and whether `c` is a number."""
    letters = tuple(VENDOR_NAMES)
    read = raw.select(M.document(F.col(body)).alias("doc"), body).select(
        F.col("doc").isNotNull().alias("json"),
        F.length(body).alias("size"),
        F.size(F.json_object_keys(body)).alias("fields"),
        M.kinds(F.col("doc"), letters).alias("kinds"),
    )
    numbers = [F.count_if(F.col("kinds")[i] == "number") for i in range(len(letters))]
    return read.agg(
        F.count("*").alias("replies"),
        F.count_if("json").alias("json_replies"),
        F.sum("fields").alias("fields"),
        F.max("size").alias("largest"),
        numbers[letters.index("c")].alias("with_numeric_c"),
        *[count.alias(f"number_{n}") for n, count in zip(letters, numbers)],
    )


def topic_size(topic: DataFrame) -> DataFrame:
    """Messages ever written, from the end offset of each partition."""
    ends = topic.groupBy("partition").agg((F.max("offset") + 1).alias("end_offset"))
    return ends.agg(
        F.count("*").alias("partitions"), F.coalesce(F.sum("end_offset"), F.lit(0)).alias("messages")
    )


def first_message(topic: DataFrame) -> DataFrame:
    """The first message in topic order, for a close look."""
    return topic.orderBy(*ORDER).limit(1).select(
        *ORDER,
        F.col("value").cast("string").alias("value"),
        F.length(F.col("value").cast("string")).alias("size_chars"),
    )


def text_extract(topic: DataFrame) -> DataFrame:
    """Symbol, price and time picked out of the text of every message."""
    text = F.col("value").cast("string")
    return topic.select(
        *ORDER,
        M.scan_text(text, "symbol", True).alias("symbol"),
        M.scan_text(text, "current_price", False).alias("current_price"),
        M.scan_text(text, "timestamp", True).alias("timestamp"),
    )
