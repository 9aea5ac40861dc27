"""Expressions that turn one raw vendor quote into a normalised quote."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickwell.config import VENDOR_BODY, VENDOR_NAMES, Universe


def request_name(symbol: str) -> str:
    return f"{symbol.lower()}_quote"


def first_mention(text: Column, symbols: tuple[str, ...], template: str = "{}") -> Column:
    """The first symbol, in universe order, whose pattern occurs in the text."""
    return F.coalesce(
        *[F.when(F.contains(text, F.lit(template.format(s))), F.lit(s)) for s in symbols]
    )


def symbol_steps(
    universe: Universe, metadata: str = "metadata", body: str = "body"
) -> dict[str, Column]:
    """The symbol as seen by each step: request name, URL, then any text of the event."""
    name, url = F.col(f"{metadata}.name"), F.col(f"{metadata}.url")
    return {
        "_by_name": F.coalesce(
            *[F.when(name == request_name(s), F.lit(s)) for s in universe.symbols]
        ),
        "_by_url": first_mention(url, universe.symbols, "symbol={}"),
        "_by_text": first_mention(F.concat_ws(" ", name, url, F.col(body)), universe.symbols),
    }


def resolution(metadata: str = "metadata") -> dict[str, Column]:
    """Symbol, the step that found it, and the message of the last step that failed."""
    name, url = F.col(f"{metadata}.name"), F.col(f"{metadata}.url")
    described = F.col(metadata).isNotNull()
    by_name, by_url, by_text = F.col("_by_name"), F.col("_by_url"), F.col("_by_text")
    symbol = F.coalesce(by_name, by_url, by_text)
    url_error = F.coalesce(
        F.concat(F.lit("url_no_symbol_found: "), url), F.lit("no_url_in_metadata")
    )
    name_error = F.coalesce(
        F.concat(F.lit("unknown_request_name: "), name), F.lit("no_metadata_or_name")
    )
    return {
        "symbol": symbol,
        "debug_source": F.when(by_name.isNotNull(), "metadata_name")
        .when(by_url.isNotNull(), "url_extraction")
        .when(by_text.isNotNull(), "pattern_matching"),
        "debug_error": F.when(symbol.isNull(), "no_symbol_pattern_found")
        .when(described & by_name.isNull() & by_url.isNull(), url_error)
        .when(described & by_name.isNull(), name_error),
    }


def vendor_body(body: str = "body") -> Column:
    """The vendor fields as text: a quoted number converts later, other text gives NULL."""
    return F.from_json(body, VENDOR_BODY.replace("double", "string"))


def vendor_fields(parsed: str) -> dict[str, Column]:
    """Vendor letters renamed and converted to numbers."""
    return {
        full: F.col(f"{parsed}.{short}").try_cast("double")
        for short, full in VENDOR_NAMES.items()
    }


def intraday_fields() -> dict[str, Column]:
    """Range and volatility of the quoted day, only when high, low and open are positive."""
    high, low, start = F.col("high"), F.col("low"), F.col("open")
    usable = (high > 0) & (low > 0) & (start > 0)
    spread = high - low
    return {
        "intraday_range": F.when(usable, F.round(spread, 2)),
        "intraday_volatility": F.when(
            usable, F.round(F.try_divide(spread, start) * 100, 4)
        ),
    }


def rejection_reasons(symbol: str = "symbol", price: str = "current_price") -> Column:
    no_price = F.col(price).isNull() | (F.col(price) == 0)
    return F.array_compact(
        F.array(
            F.when(F.col(symbol).isNull(), F.lit("no_symbol")),
            F.when(no_price, F.lit("no_price_data")),
        )
    )
