"""Repeatable random draws: every value depends on (seed, stream name, row id) only.

Nothing depends on partitioning, task order or retries, so a lost task recreates its rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import seconds_interval

BASE36 = "abcdefghijklmnopqrstuvwxyz0123456789"
TWO_63 = float(2**63)


def stream_key(stream: str, seed: int) -> int:
    return zlib.crc32(f"{seed}:{stream}".encode())


def draw(row_id: Column, stream: str, seed: int = 42) -> Column:
    """A non-negative 63-bit number for this row in the named stream."""
    key = F.lit(stream_key(stream, seed)).cast("long")
    return F.shiftrightunsigned(F.xxhash64(key, row_id.cast("long")), 1)


def unit(drawn: Column) -> Column:
    """Map a draw to [0, 1)."""
    return drawn.cast("double") / F.lit(TWO_63)


def chance(drawn: Column, probability: float) -> Column:
    return unit(drawn) < F.lit(probability)


def between(drawn: Column, low: int, high: int | Column) -> Column:
    """An integer in low..high, both ends included."""
    top = high if isinstance(high, Column) else F.lit(high)
    return (drawn % (top.cast("long") - F.lit(low - 1).cast("long"))) + F.lit(low).cast("long")


def pick(drawn: Column, options: Sequence[str]) -> Column:
    position = (drawn % F.lit(len(options)).cast("long") + 1).cast("int")
    return F.element_at(F.array(*[F.lit(o) for o in options]), position)


def alphanumeric(drawn: Column, length: int) -> Column:
    """Base-36 characters, ten bits for each; every six characters a further draw follows from the first."""
    further = [drawn] + [F.shiftrightunsigned(F.xxhash64(drawn, F.lit(n)), 1) for n in range(1, -(-length // 6))]
    places = [F.shiftright(further[at // 6], 10 * (at % 6)) % F.lit(36).cast("long") for at in range(length)]
    return F.concat(*[F.substring(F.lit(BASE36), (p + 1).cast("int"), F.lit(1)) for p in places])


def sample_words(row_id: Column, stream: str, words: Sequence[str], size: Column, seed: int) -> Column:
    """`size` different words in random order, joined by blanks."""
    keyed = [
        F.struct(draw(row_id, f"{stream}/{at}", seed).alias("turn"), F.lit(word).alias("word"))
        for at, word in enumerate(words)
    ]
    shuffled = F.sort_array(F.array(*keyed)).getField("word")
    return F.array_join(F.slice(shuffled, F.lit(1), size.cast("int")), " ")


def moment_before(as_of: Column, drawn: Column, days: int) -> Column:
    """A whole-second moment in the `days` before `as_of`."""
    return as_of - seconds_interval(between(drawn, 0, days * 86400))
