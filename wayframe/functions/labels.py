"""Classifying and strictly validating label results."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wayframe.functions.taxonomy import COUNT_FIELDS

# --- Fixed values: the label document's format and the result statuses --------------
TIMES_OF_DAY = ("day", "dusk_dawn", "night")
WEATHERS = ("clear", "overcast", "rain", "fog")
CONFIDENCES = ("low", "medium", "high")
DOCUMENT_KEYS = (
    "time_of_day", "weather", "object_counts", "hazards", "notable_conditions",
    "label_confidence",
)
RETRYABLE = ("errored_server", "expired", "canceled")
TERMINAL = (
    "ok", "refusal", "truncated", "invalid_json", "schema_invalid", "errored_bad_request",
)
# Estimated tokens per labelled frame and the batch discount.
INPUT_TOKENS = 2300
OUTPUT_TOKENS = 350
BATCH_DISCOUNT = 0.5
# --- End of fixed values ------------------------------------------------------------

_ENUMS = {"time_of_day": TIMES_OF_DAY, "weather": WEATHERS, "label_confidence": CONFIDENCES}
_LISTS = ("hazards", "notable_conditions")
_NUMBER_TEXT = r"^\s*[+-]?\d+(\.0*)?\s*$"


def _document_type(count: str) -> str:
    counts = ", ".join(f"{f}: {count}" for f in COUNT_FIELDS)
    return (
        f"struct<time_of_day: string, weather: string, object_counts: struct<{counts}>, "
        "hazards: array<string>, notable_conditions: array<string>, label_confidence: string>"
    )


def _shape(count: str, item: str) -> str:
    """The type text of a document with the right keys, as Spark spells it."""
    counts = ", ".join(f"{f}: {count}" for f in sorted(COUNT_FIELDS))
    parts = {name: "STRING" for name in _ENUMS}
    parts |= {name: f"ARRAY<{item}>" for name in _LISTS}
    parts["object_counts"] = f"OBJECT<{counts}>"
    return "OBJECT<" + ", ".join(f"{k}: {parts[k]}" for k in sorted(DOCUMENT_KEYS)) + ">"


# Whole numbers may also come as numeric text, as 2.0 or as booleans.
_ALLOWED_SHAPE = "^" + _shape(
    r"(BIGINT|DOUBLE|STRING|BOOLEAN|DECIMAL\(\d+,\d+\))", "(STRING|VOID)"
) + "$"
_PLAIN_SHAPE = "^" + _shape("BIGINT", "(STRING|VOID)") + "$"


def _count(text: Column, shape: Column, field: str) -> Column:
    """A count as BIGINT from its text; NULL when it is not a whole number."""
    number = F.when(
        text.rlike(_NUMBER_TEXT), F.regexp_replace(F.trim(text), r"\.0*$", "").try_cast("bigint")
    )
    is_boolean = F.contains(shape, F.lit(f"{field}: BOOLEAN"))
    truth = F.when(is_boolean, (text == "true").cast("bigint"))
    return F.when(text.isin("true", "false"), truth).otherwise(number)


def _label(values: Column, counts: dict[str, Column]) -> Column:
    """Label struct, NULL unless enumerations, counts and list items are valid."""
    tests = [values[name].isin(*allowed) for name, allowed in _ENUMS.items()]
    tests += [F.coalesce(c >= 0, F.lit(False)) for c in counts.values()]
    tests += [F.forall(values[name], lambda item: item.isNotNull()) for name in _LISTS]
    label = F.struct(
        values["time_of_day"].alias("time_of_day"),
        values["weather"].alias("weather"),
        F.struct(*[c.alias(f) for f, c in counts.items()]).alias("object_counts"),
        *[values[name].alias(name) for name in _LISTS],
        values["label_confidence"].alias("label_confidence"),
    )
    return F.when(reduce(Column.__and__, tests), label)


def parse_documents(df: DataFrame, document: str, label: str) -> DataFrame:
    """Add a VARIANT label document as a struct, NULL when it breaks the schema.

    Required and closed keys at both levels, enumerated strings, non-negative whole counts
    and lists of strings. The document's own type text settles keys and types in one
    comparison, so that, unlike with ``from_json``, nothing is silently dropped or nulled.
    Plainly typed documents are read by one cast; the others by way of text. The steps are
    columns of their own so that each is computed once per row.
    """
    steps = df.withColumn("_shape", F.schema_of_variant(document)).withColumns(
        {
            "_plain": F.when(
                F.col("_shape").rlike(_PLAIN_SHAPE),
                F.try_variant_get(document, "$", _document_type("bigint")),
            ),
            "_texts": F.when(
                F.col("_shape").rlike(_ALLOWED_SHAPE) & ~F.col("_shape").rlike(_PLAIN_SHAPE),
                F.try_variant_get(document, "$", _document_type("string")),
            ),
        }
    )
    plain, texts = F.col("_plain"), F.col("_texts")
    counts = {
        f: F.when(texts.isNotNull(), _count(texts["object_counts"][f], F.col("_shape"), f))
        for f in COUNT_FIELDS
    }
    read = _label(plain, {f: plain["object_counts"][f] for f in COUNT_FIELDS})
    steps = steps.withColumns({f"_n_{f}": c for f, c in counts.items()})
    coerced = _label(texts, {f: F.col(f"_n_{f}") for f in COUNT_FIELDS})
    return steps.withColumn(
        label, F.when(plain.isNotNull(), read).when(texts.isNotNull(), coerced)
    ).drop("_shape", "_plain", "_texts", *[f"_n_{f}" for f in COUNT_FIELDS])


def parse_status(json_ok: Column, schema_ok: Column) -> Column:
    """One of nine statuses of a raw result, by a fixed precedence."""
    kind, stop, text = F.col("result_type"), F.col("stop_reason"), F.col("text")
    return (
        F.when(
            kind == "errored",
            F.when(F.col("error_type") == "invalid_request", "errored_bad_request")
            .otherwise("errored_server"),
        )
        .when(kind.isin("expired", "canceled"), kind)
        .when(stop == "refusal", "refusal")
        .when(stop == "max_tokens", "truncated")
        .when(text.isNull() | (text == ""), "invalid_json")
        .when(schema_ok, "ok")
        .when(json_ok, "schema_invalid")
        .otherwise("invalid_json")
    )


def _read_text() -> Column:
    """The text of a result whose status depends on it; NULL for those settled before."""
    settled = F.col("result_type").isin("errored", "expired", "canceled")
    stopped = F.col("stop_reason").isin("refusal", "max_tokens")
    return F.when(settled, None).when(stopped, None).otherwise(F.col("text"))


def with_status(raw: DataFrame) -> DataFrame:
    """Add ``parse_status`` and the parsed ``label`` (NULL unless the status is ok).

    Only texts on which the status depends are parsed.
    """
    parsed = parse_documents(
        raw.withColumn("_document", F.try_parse_json(_read_text())), "_document", "_label"
    )
    status = parse_status(F.col("_document").isNotNull(), F.col("_label").isNotNull())
    return (
        parsed.withColumn("parse_status", status)
        .withColumn("label", F.when(F.col("parse_status") == "ok", F.col("_label")))
        .drop("_document", "_label")
    )


def frame_price(model: Column, prices: Mapping[str, tuple[float, float]]) -> Column:
    """Batch price of one frame; ``prices`` are (input, output) per million tokens.

    NULL for a model without a price.
    """
    per_frame = {
        name: (INPUT_TOKENS * price_in + OUTPUT_TOKENS * price_out) / 1_000_000 * BATCH_DISCOUNT
        for name, (price_in, price_out) in prices.items()
    }
    chain = F
    for name, price in per_frame.items():
        chain = chain.when(model == name, F.lit(price))
    return chain
