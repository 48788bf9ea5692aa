"""Fields of raw JSON records, ids, dates and tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vectorloom.config import NEW_ID_PATTERN, OLD_ID_PATTERN
from vectorloom.functions.text import word_list

# Variant fields keep the JSON type, which the id check and the list fields need.
RAW_SCHEMA = (
    "id VARIANT, title STRING, abstract STRING, authors VARIANT, categories VARIANT, "
    "doi STRING, `journal-ref` STRING, published STRING"
)
_STRICT = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}


def parse_record(line: Column, fields: str = RAW_SCHEMA) -> Column:
    """One JSON object per line to a struct; null when the line is anything else.

    The line is read as the only element of a list, so text after the object is
    an error too. A field given twice takes its last value.
    """
    wrapped = F.concat(F.lit("["), line, F.lit("]"))
    items = F.from_json(wrapped, f"ARRAY<STRUCT<{_as_struct(fields)}>>", _STRICT)
    # The one-element list binds the parsed line, so it is parsed only once.
    single = F.transform(F.array(items), lambda x: F.when(F.size(x) == 1, F.get(x, F.lit(0))))
    return F.get(single, F.lit(0))


def _as_struct(ddl: str) -> str:
    return ", ".join(
        f"{name}: {kind}" for name, kind in (part.strip().rsplit(" ", 1) for part in ddl.split(","))
    )


def json_field(line: Column, name: str, kind: str = "string") -> Column:
    """One field of a JSON text by name, null when missing or of another type."""
    return F.try_variant_get(F.try_parse_json(line), f"$.{name}", kind)


def json_kind(value: Column) -> Column:
    """JSON type name of a variant: STRING, BIGINT, BOOLEAN, ARRAY<..>, OBJECT<..>, VOID."""
    return F.schema_of_variant(value)


def scalar_id(value: Column) -> Column:
    """Id text of a string or number; null for empty, zero, false, lists and objects."""
    text = F.try_variant_get(value, "$", "string")
    kind = json_kind(value)
    number = F.rlike(kind, F.lit("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"))
    zero = F.try_variant_get(value, "$", "double") == F.lit(0.0)
    return (
        F.when(kind == "STRING", F.nullif(text, F.lit("")))
        .when(number & ~F.coalesce(zero, F.lit(False)), text)
        .when((kind == "BOOLEAN") & (text == "true"), text)
    )


def tags(value: Column) -> Column:
    """Categories as a list: a text is split at whitespace, missing gives an empty list."""
    as_list = F.try_variant_get(value, "$", "array<string>")
    as_text = F.when(json_kind(value) == "STRING", F.try_variant_get(value, "$", "string"))
    return F.coalesce(as_list, word_list(as_text), F.array().cast("array<string>"))


def names_text(value: Column) -> Column:
    """Authors as one text; a list is joined with a comma."""
    listed = F.try_variant_get(value, "$", "array<string>")
    return F.coalesce(F.array_join(listed, ", "), F.try_variant_get(value, "$", "string"))


def names_list(value: Column) -> Column:
    """Authors as a list; a plain text is one element."""
    text = F.when(json_kind(value) == "STRING", F.try_variant_get(value, "$", "string"))
    return F.coalesce(
        F.try_variant_get(value, "$", "array<string>"), F.when(text.isNotNull(), F.array(text))
    )


def iso_timestamp(text: Column) -> Column:
    """ISO time with ``Z`` or an offset; null when it cannot be read."""
    return F.try_to_timestamp(text)


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def valid_id(paper_id: Column) -> Column:
    """New style 0704.0001 or old style hep-th/9901001."""
    return F.rlike(paper_id, F.lit(NEW_ID_PATTERN)) | F.rlike(paper_id, F.lit(OLD_ID_PATTERN))


def any_tag(categories: Column, wanted: list[str]) -> Column:
    """At least one of the wanted tags is present."""
    return F.arrays_overlap(categories, F.array(*[F.lit(w) for w in wanted]))


def has_tag(categories: Column, tag: str) -> Column:
    return F.array_contains(categories, tag)


def mentions(phrase: str, *texts: Column) -> Column:
    """Case-insensitive search of a phrase in any of the texts."""
    whole = F.lower(F.concat_ws("\n", *texts))
    return F.contains(whole, F.lit(phrase.lower()))


def on_or_after(day: Column, low: str) -> Column:
    return day >= F.to_date(F.lit(low))


def submitted_between(ts: Column, low: str | None = None, high: str | None = None) -> Column:
    """Day range (``yyyyMMdd``), both ends included; an open end takes a sentinel date.

    Both bounds are dates, which take the type of the column; the column itself
    stays bare and the range reaches the Parquet scan.
    """
    if not low and not high:
        return F.lit(True)
    first = F.to_date(F.lit(low or "19000101"), "yyyyMMdd")
    last = F.to_date(F.lit(high or "99991231"), "yyyyMMdd")
    return (ts >= first) & (ts < F.date_add(last, 1))
