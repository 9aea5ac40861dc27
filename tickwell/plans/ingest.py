"""Raw vendor quotes to normalised quotes and rejects; runs on batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.config import Universe
from tickwell.functions.quotes import (
    intraday_fields,
    rejection_reasons,
    resolution,
    symbol_steps,
    vendor_body,
    vendor_fields,
)
from tickwell.operators.metering import metered

# Constants written into every quote.
DATA_SOURCE, DATA_TYPE = "finnhub", "real_time_quote"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def normalise(raw: DataFrame, universe: Universe, time: str = "received_at") -> DataFrame:
    """All raw quotes with resolved symbol, numbers, tags and reasons; nothing is dropped.

    `raw` needs `metadata struct<name,url>`, `body` (JSON text) and a receive time.
    """
    # Every step reads the columns of the one before, so text is searched and parsed once.
    steps = symbol_steps(universe)
    resolved = (
        raw.withColumns({**steps, "_vendor": vendor_body()})
        .withColumns({**resolution(), **vendor_fields("_vendor")})
        .drop("_vendor", *steps)
    )
    judged = resolved.withColumn("error_type", rejection_reasons())
    valid = F.size("error_type") == 0
    accepted_tags = F.array(F.lit("has_symbol"), F.lit("processed"), F.lit("valid_quote"))
    complete = judged.withColumns(
        {
            **intraday_fields(),
            "is_valid": valid,
            "timestamp": F.date_format(time, ISO_SECONDS),
            "data_source": F.lit(DATA_SOURCE),
            "data_type": F.lit(DATA_TYPE),
            "doc_id": F.concat_ws(
                "_", "symbol", F.unix_timestamp(F.col(time).cast("timestamp")).cast("string")
            ),
            "tags": F.when(valid, accepted_tags).otherwise(F.array(F.lit("debug_failed"))),
        }
    )
    return metered(complete, "ingest", valid=F.col("is_valid"))


def accepted(normalised: DataFrame) -> DataFrame:
    return normalised.where("is_valid").drop("metadata", "body", "error_type", "is_valid")


def rejected(normalised: DataFrame) -> DataFrame:
    derived = ("intraday_range", "intraday_volatility", "doc_id", "data_source", "data_type")
    return normalised.where("not is_valid").drop("is_valid", *derived)
