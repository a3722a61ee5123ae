"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import SHARDS


def shard_of(key: Column, shards: int = SHARDS) -> Column:
    """Logical shard: the non-negative remainder, 0..shards-1."""
    return F.pmod(key.cast("long"), F.lit(shards).cast("long"))


def micros_between(start: Column, end: Column) -> Column:
    """Microseconds from start to end (session zone must be UTC for NTZ inputs)."""
    return F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))


def seconds_interval(seconds: Column) -> Column:
    return F.make_dt_interval(secs=seconds)


def round_even(value: Column, digits: int) -> Column:
    """Banker's rounding, as Python's and .NET's round do."""
    return F.bround(value, digits)


def iso_text(at: Column) -> Column:
    """ISO-8601 text with microseconds."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def first_item(text: Column, separator: str = ",") -> Column:
    return F.split_part(text, F.lit(separator), F.lit(1))


def uuid_text(*parts: Column) -> Column:
    """A repeatable uuid-shaped id derived from the given values."""
    digest = F.sha2(F.concat_ws(":", *[p.cast("string") for p in parts]), 256)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, at, size) for at, size in cuts])


def json_object(**fields: Column) -> Column:
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))


def size_text(size: Column) -> Column:
    """Readable size: bytes below 10 kB, then kB, MB, GB or TB, rounded half up, up to 10240 of each."""
    text = F.when(size < 10 * 1024, F.concat(size.cast("string"), F.lit(" bytes")))
    units = ["kB", "MB", "GB", "TB"]
    for step, unit in enumerate(units, start=1):
        # Halves of the unit below are cut off before rounding, so the remainder never carries twice.
        halves = F.shiftright(size, 10 * step - 1)
        rounded = F.concat(F.shiftright(halves + 1, 1).cast("string"), F.lit(f" {unit}"))
        text = text.otherwise(rounded) if unit == units[-1] else text.when(halves < 20 * 1024 - 1, rounded)
    return text


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast("long"))
