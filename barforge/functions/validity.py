"""Validity predicates: the pipeline's split rule (P3/P4) and the strict contract (P5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barforge.schema import REQUIRED_FIELDS, SIDES

TEXT_FIELDS = ["symbol", "side", "ts"]  # JSON strings; the others are numbers

# Fixed value: RFC 3339 date-time text (date, 'T' or space, time, optional
# fraction, then 'Z' or a numeric offset).
RFC3339 = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"


def missing_fields() -> Column:
    """Number of required fields that a parsed trade lacks; 0 is a valid trade, never NULL."""
    return sum((F.col(f).isNull().cast("int") for f in REQUIRED_FIELDS), F.lit(0))


def json_without_nan(raw: Column) -> Column:
    """The text with bare NaN and Infinity values, which the parser takes but JSON does not know, as null."""
    named = F.contains(raw, F.lit("NaN")) | F.contains(raw, F.lit("INF")) | F.contains(raw, F.lit("Infinity"))
    return F.when(named, F.regexp_replace(raw, r"(:\s*)[+-]?(?:NaN|INF|Infinity)(?=\s*[,}])", "$1null")).otherwise(raw)


def json_values(text: Column) -> Column:
    """The object's values by key; NULL for what is no object, is not strict JSON or repeats a key."""
    return F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>")


def json_keys(text: Column, values: Column) -> Column:
    """The object's keys; the lenient parser is asked only where there are no values."""
    return F.coalesce(F.map_keys(values), F.json_object_keys(text))


def not_texts(values: Column) -> Column:
    """Per text field: it holds JSON of another type than string (FALSE where the type is not known)."""
    def wrong(field: str) -> Column:
        kind = F.schema_of_variant(F.try_element_at(values, F.lit(field)))
        return F.coalesce(~kind.isin("STRING", "VOID"), F.lit(False))

    return F.struct(*[wrong(f).alias(f) for f in TEXT_FIELDS])


def _not_positive(c: Column) -> Column:
    return c.isNotNull() & (F.isnan(c) | (c <= 0))


def contract_violations(raw_col: str = "raw_json", ts_text_col: str = "ts_text", keys_col: str | None = None,
                        not_text_col: str | None = None) -> Column:
    """P5: ARRAY<STRING> of contract rules a parsed trade breaks (empty = conforms).

    Expects the parsed columns (symbol, price, size, side, trade_id) plus the raw
    JSON text and the ts text as received. Rules: valid JSON object; each required
    key present ('required:<f>') with the right JSON type ('type:<f>'); price and
    size > 0 (NaN breaks it); side in the enum; trade_id >= 0; ts an RFC 3339
    date-time; no keys outside the contract ('extra:<key>').

    ``keys_col`` and ``not_text_col`` name columns already holding :func:`json_keys` and
    :func:`not_texts`; the expressions are referenced many times, so precomputing
    them (see :func:`with_violations`) avoids re-parsing the text per reference.
    """
    text = json_without_nan(F.col(raw_col))
    keys = F.col(keys_col) if keys_col else json_keys(text, json_values(text))
    not_text = F.col(not_text_col) if not_text_col else not_texts(json_values(text))
    per_field = []
    for f in REQUIRED_FIELDS:
        value = F.col(ts_text_col) if f == "ts" else F.col(f)
        wrong = value.isNull() | not_text[f] if f in TEXT_FIELDS else value.isNull()
        per_field.append(
            F.when(
                keys.isNotNull() & wrong,
                F.when(F.array_contains(keys, f), F.lit(f"type:{f}")).otherwise(
                    F.lit(f"required:{f}")
                ),
            )
        )
    rules = [
        F.when(keys.isNull(), F.lit("json:not_an_object")),
        *per_field,
        F.when(_not_positive(F.col("price")), F.lit("range:price")),
        F.when(_not_positive(F.col("size")), F.lit("range:size")),
        F.when(
            F.col("side").isNotNull() & ~not_text["side"] & ~F.col("side").isin(*SIDES), F.lit("enum:side")
        ),
        F.when(F.col("trade_id") < 0, F.lit("range:trade_id")),
        F.when(
            F.col(ts_text_col).isNotNull() & ~not_text["ts"]
            & (~F.col(ts_text_col).rlike(RFC3339) | F.col("ts").isNull()),
            F.lit("format:ts"),
        ),
    ]
    extras = F.transform(
        F.array_sort(F.array_except(keys, F.array(*[F.lit(k) for k in REQUIRED_FIELDS]))),
        lambda k: F.concat(F.lit("extra:"), k),
    )
    return F.concat(F.array_compact(F.array(*rules)), F.coalesce(extras, F.array().cast("array<string>")))


def with_violations(parsed, raw_col: str = "raw_json", ts_text_col: str = "ts_text"):
    """Add ``violations`` to a parsed frame; beside the trade's own parse the text is parsed once, to its values by key."""
    return (
        parsed.withColumn("_text", json_without_nan(F.col(raw_col)))
        .withColumn("_values", json_values(F.col("_text")))
        .withColumns({"_keys": json_keys(F.col("_text"), F.col("_values")), "_not_text": not_texts(F.col("_values"))})
        .withColumn("violations", contract_violations(raw_col, ts_text_col, keys_col="_keys", not_text_col="_not_text"))
        .drop("_text", "_values", "_keys", "_not_text")
    )
