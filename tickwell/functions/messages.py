"""Checks on one JSON message, as column expressions over its text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickwell.config import CONTRACT_9, NUMBER_FIELDS

# Accepted text forms.
ISO_PREFIX = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"
PRICE_TEXT = r"^[0-9]+\.?[0-9]*$"
OBJECT_START = r"^\s*\{"
MALFORMED = "malformed JSON"


def document(value: Column) -> Column:
    """Parsed message; NULL for malformed text and for JSON that is not an object."""
    return F.when(value.rlike(OBJECT_START), F.try_parse_json(value))


def field(doc: Column, name: str) -> Column:
    return F.try_variant_get(doc, f"$.{name}", "variant")


def field_text(doc: Column, name: str) -> Column:
    return F.try_variant_get(doc, f"$.{name}", "string")


def field_number(doc: Column, name: str) -> Column:
    return F.try_variant_get(doc, f"$.{name}", "double")


def kind_of_schema(name: Column) -> Column:
    return (
        F.when(name == "STRING", "string")
        .when(name == "BOOLEAN", "boolean")
        .when(name == "VOID", "null")
        .when(name.startswith("OBJECT"), "object")
        .when(name.startswith("ARRAY"), "array")
        .when(name.isNotNull(), "number")
    )


def kinds(doc: Column, names: tuple[str, ...] = CONTRACT_9) -> Column:
    """JSON types of the named fields, in order; NULL for an absent one.

    The lambda binds each schema text once. Written without it, the comparison chain would
    repeat the lookup for every branch and for every later use.
    """
    schemas = F.array(*[F.schema_of_variant(field(doc, n)) for n in names])
    return F.transform(schemas, kind_of_schema)


def kind(value: Column) -> Column:
    """JSON type of one variant; NULL if absent."""
    return F.transform(F.array(F.schema_of_variant(value)), kind_of_schema)[0]


def expected_kind(name: str) -> str:
    return "number" if name in NUMBER_FIELDS else "string"


def kind_at(found: str, name: str) -> Column:
    return F.col(found)[CONTRACT_9.index(name)]


WANTED = [expected_kind(n) for n in CONTRACT_9]


def literals(values: tuple[str, ...] | list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def valid_field_count(found: str) -> Column:
    hits = F.zip_with(found, literals(WANTED), lambda seen, wanted: seen == wanted)
    return F.size(F.filter(hits, lambda hit: hit))


def contract_problem(seen: Column, at: Column) -> Column:
    name, wanted = literals(CONTRACT_9)[at], literals(WANTED)[at]
    return F.when(seen.isNull(), F.concat(F.lit("missing field: "), name)).when(
        seen != wanted,
        F.concat(
            F.lit("field "), name, F.lit(": type "), seen, F.lit(", expected "), wanted
        ),
    )


def message_issues(found: str, symbols: tuple[str, ...]) -> Column:
    """Every issue of a parsed message, field order first, then value checks.

    Reads the columns `kinds`, `symbol`, `price`, `stamp` prepared by the caller.
    """
    symbol = F.coalesce("symbol", F.lit("null"))
    stamp = F.coalesce("stamp", F.lit("null"))
    values = F.array(
        F.when(
            kind_at(found, "symbol").isNotNull() & ~symbol.isin(*symbols),
            F.concat(F.lit("symbol not recognised: "), symbol),
        ),
        F.when(
            (kind_at(found, "current_price") == "number") & (F.col("price") <= 0),
            F.concat(F.lit("price not positive: "), F.col("price").cast("string")),
        ),
        F.when(
            kind_at(found, "timestamp").isNotNull() & ~stamp.rlike(ISO_PREFIX),
            F.concat(F.lit("timestamp not ISO: "), stamp),
        ),
    )
    return F.array_compact(F.concat(F.transform(found, contract_problem), values))


def present_flags(doc: Column, names: tuple[str, ...]) -> Column:
    """For each field whether it is there and neither null nor false."""

    def switched_on(value: Column) -> Column:
        schema = F.schema_of_variant(value)
        usable = F.when(schema == "VOID", False).when(
            schema == "BOOLEAN", F.try_variant_get(value, "$", "boolean")
        )
        return F.coalesce(usable.otherwise(value.isNotNull()), F.lit(False))

    return F.transform(F.array(*[field(doc, n) for n in names]), switched_on)


def scan_text(value: Column, name: str, quoted: bool) -> Column:
    """Field picked out of the raw text without parsing, "N/A" when it is not there."""
    pattern = f'"{name}":"([^"]*)"' if quoted else f'"{name}":([0-9.]*)'
    found = F.regexp_extract(value, pattern, 1)
    return F.when(found == "", "N/A").otherwise(found)
