"""Event times in JSON records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fields that may hold a record's event time, the first that parses wins.
EVENT_TIME_FIELDS = ("InfoTimestamp", "timestamp", "Timestamp", "@timestamp", "time", "Time", "event_time", "created_at")

_CLOCK = r"\d{2}:\d{2}:\d{2}([.,]\d{1,9})?"
_NARROW = rf"^\d{{4}}-\d{{2}}-\d{{2}}(T{_CLOCK}(Z|[+-]\d{{2}}:\d{{2}})?| {_CLOCK})$"
_WIDE = rf"{_NARROW}|^\d{{4}}-\d{{2}}-\d{{2}}$"
_NUMBER = r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$"
_LATEST_SECOND = 253402300799  # the last one of year 9999


def _utc(text: Column) -> Column:
    """An instant as wall-clock time in UTC: offsets are honoured, none means UTC (the session zone must be UTC)."""
    return F.try_to_timestamp(F.replace(text, F.lit(","), F.lit("."))).cast("timestamp_ntz")


def looks_like_timestamp(text: Column) -> Column:
    """Whether inference takes a string for a timestamp: ISO date and time with a T or a space; zone only after a T."""
    return F.coalesce(text.rlike(_NARROW) & _utc(text).isNotNull(), F.lit(False))


def narrow(text: Column) -> Column:
    """The timestamp of a string that looks like one, to the millisecond; else null."""
    return F.date_trunc("MILLISECOND", F.when(text.rlike(_NARROW), _utc(text))).cast("timestamp_ntz")


def from_epoch(number: Column) -> Column:
    """A number over 1e12 counts milliseconds, others seconds; null outside of the years 1 to 9999."""
    seconds = F.when(number > 1e12, F.floor(number) / 1000).otherwise(F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)))
    return F.when(seconds.between(-62135596800, _LATEST_SECOND), F.timestamp_micros(F.round(seconds * 1000000).cast("long"))).cast("timestamp_ntz")


def wide(text: Column, is_number: Column | None = None) -> Column:
    """The timestamp of a JSON value's text: the narrow layouts, a plain date, or an epoch number (if ``is_number``)."""
    parsed = F.when(text.rlike(_WIDE), _utc(text))
    if is_number is None:
        return parsed
    return F.when(is_number, from_epoch(F.when(text.rlike(_NUMBER), text).try_cast("double"))).otherwise(parsed)


def _time_values(record: Column, fields: tuple[str, ...]) -> list[Column]:
    return [F.try_variant_get(record, f"$['{name}']", "variant") for name in fields]


def first_time_value(record: Column, fields: tuple[str, ...] = EVENT_TIME_FIELDS) -> Column:
    """Of a VARIANT record's time fields the first that it has, whether it parses or not."""
    return F.coalesce(*_time_values(record, fields))


def value_time(value: Column, kind: Column) -> Column:
    """The time of a VARIANT value of a time field, with its schema ``kind``; null for what is no string and no number, and what doesn't parse."""
    number = kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL")
    return F.when(number | (kind == "STRING"), wide(value.try_cast("string"), number))


def event_time(record: Column, fields: tuple[str, ...] = EVENT_TIME_FIELDS) -> Column:
    """The event time of a VARIANT record: of its time fields the first that parses; null if none does.

    The fields' values are gathered first and each is parsed by the same code.
    """
    values = F.filter(F.array(*_time_values(record, fields)), lambda v: v.isNotNull())
    return F.get(F.filter(F.transform(values, lambda v: value_time(v, F.schema_of_variant(v))), lambda t: t.isNotNull()), F.lit(0))


def rfc3339(time: Column) -> Column:
    """A wall-clock time in UTC as text, to the second."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")
