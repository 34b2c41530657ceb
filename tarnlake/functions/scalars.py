"""Scalar expressions. Every function takes and returns a Column; none of them leaves the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the duration, time-class and error conventions.
OPEN_STATES = ["InProgress", "NotStarted"]
FAST_BELOW_SECONDS = 1.0
NORMAL_BELOW_SECONDS = 5.0
NO_VALUE = "N/A"
UNKNOWN = "Unknown"
NO_MESSAGE = "No message"


def parse_date(text: Column, fmt: str = "yyyy-MM-dd", strict: bool = False) -> Column:
    """Text to date; unreadable text gives null unless ``strict``."""
    return F.to_date(text, fmt) if strict else F.try_to_date(text, fmt)


def tagged_modulo(tag: str, number: Column, n: int) -> Column:
    return F.concat(F.lit(tag), (number % n).cast("string"))


def preview_text(text: Column, n: int = 200) -> Column:
    return F.left(text, F.lit(n))


def iso_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text)


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds as double, from two timestamps."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000)


def _whole(number: Column) -> Column:
    """Without the fraction: half a second before zero is zero seconds."""
    return number.cast("bigint")


def minutes_seconds(seconds: Column) -> Column:
    """Minutes rounded down, and the seconds past them: five seconds before zero are ``-1m 55s``."""
    whole = _whole(seconds)
    past = F.pmod(whole, F.lit(60))
    return F.concat(_whole((whole - past) / 60).cast("string"), F.lit("m "), past.cast("string"), F.lit("s"))


def run_duration(submitted: Column, ended: Column, state: Column, as_of: Column) -> Column:
    """Text such as ``3m 20s``; runs still open count up to ``as_of``; else ``N/A``."""
    finish = F.when(ended.isNotNull(), ended).when(state.isin(OPEN_STATES), as_of)
    return F.coalesce(minutes_seconds(seconds_between(submitted, finish)), F.lit(NO_VALUE))


def duration_label(seconds: Column) -> Column:
    whole = _whole(seconds)
    hours, minutes = _whole(whole / 3600), _whole((whole % 3600) / 60)
    text = (
        F.when(whole < 60, F.concat(whole.cast("string"), F.lit("s")))
        .when(whole < 3600, minutes_seconds(whole))
        .otherwise(F.concat(hours.cast("string"), F.lit("h "), minutes.cast("string"), F.lit("m")))
    )
    return F.when(whole.isNull(), F.lit(NO_VALUE)).otherwise(text)


def time_class(seconds: Column) -> Column:
    return (
        F.when(seconds < FAST_BELOW_SECONDS, "fast")
        .when(seconds < NORMAL_BELOW_SECONDS, "normal")
        .when(seconds.isNotNull(), "slow")
    )


def first_non_empty(*fields: Column) -> Column:
    """First field that is neither null nor empty text."""
    return F.coalesce(*[F.nullif(field, F.lit("")) for field in fields])


def json_object(text: Column) -> Column:
    """A text that is a JSON object as a variant, parsed once; any other text is null and isn't parsed. Callers that
    read several fields keep it in a column."""
    return F.when(F.ltrim(text).startswith("{"), F.try_parse_json(text))


def object_field(parsed: Column, key: str) -> Column:
    return F.try_variant_get(parsed, f"$.{key}", "string")


def error_field(parsed: Column, key: str, default: str) -> Column:
    """Field of an error object (see ``json_object``); the default when the key is absent; null when not an object."""
    return F.when(parsed.isNotNull(), F.coalesce(object_field(parsed, key), F.lit(default)))


def error_items(text: Column, parsed: Column) -> Column:
    """Errors given as plain text, one JSON object or a JSON array: always an array of variants. ``parsed`` is
    ``json_errors`` of the text."""
    trimmed = F.ltrim(text)
    return (
        F.when(F.coalesce(trimmed, F.lit("")) == "", F.lit(None).cast("array<variant>"))
        .when(parsed.isNull(), F.array(text.cast("variant")))
        .when(trimmed.startswith("["), F.try_variant_get(parsed, "$", "array<variant>"))
        .otherwise(F.array(parsed))
    )


def json_errors(text: Column) -> Column:
    """A text that is a JSON object or array as a variant, else null."""
    start = F.left(F.ltrim(text), F.lit(1))
    return F.when(start.isin("{", "["), F.try_parse_json(text))


def error_struct(item: Column) -> Column:
    """One error item, a variant, as (code, message, source); anything but an object becomes the message."""
    parsed = F.struct(
        F.coalesce(first_non_empty(object_field(item, "errorCode"), object_field(item, "code")), F.lit(UNKNOWN)).alias("code"),
        F.coalesce(first_non_empty(object_field(item, "message"), object_field(item, "errorMessage")),
                   F.lit(NO_MESSAGE)).alias("message"),
        F.coalesce(object_field(item, "source"), F.lit("")).alias("source"),
    )
    whole = F.try_variant_get(item, "$", "string")
    plain = F.struct(F.lit(None).cast("string").alias("code"), whole.alias("message"), F.lit("").alias("source"))
    return F.when(F.schema_of_variant(item).startswith("OBJECT"), parsed).when(whole.isNotNull(), plain)


def literal_count(text: Column, needle: str) -> Column:
    """Number of non-overlapping occurrences of a literal."""
    removed = F.length(text) - F.length(F.replace(text, F.lit(needle), F.lit("")))
    return (removed / len(needle)).cast("bigint")


def truncate_marked(text: Column, n: int, marker: str = "...") -> Column:
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n)), F.lit(marker))).otherwise(text)


def truncate_counted(text: Column, n: int) -> Column:
    """Cut text and state how many characters were left out."""
    note = F.concat(
        F.lit("\n... [truncated, "), (F.length(text) - n).cast("string"), F.lit(" chars omitted]"))
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n)), note)).otherwise(text)


def first_match(text: Column, patterns: Sequence[str]) -> Column:
    """Group 1 of the first pattern that matches."""
    return F.coalesce(*[F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in patterns])


def display_number(number: Column) -> Column:
    """Thousands separators; two decimals unless the value is whole; empty text for null."""
    text = F.when(number == F.floor(number), F.format_number(number, 0)).otherwise(F.format_number(number, 2))
    return F.coalesce(text, F.lit(""))
