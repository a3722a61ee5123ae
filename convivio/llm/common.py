"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words are separated by the six ASCII blanks only; other Unicode blanks belong to words.
WORD = r"[^\x20\x09-\x0D]+"
# A list of ids is broadcast only after it was counted: so many ids take about 64 MB.
BROADCAST_IDS = 2_000_000


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def sized(ids: DataFrame) -> DataFrame:
    """Mark a stored list of ids for broadcast if its counted size allows; else leave it to a shuffle join."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def only_ids(df: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows whose key is in a stored one-column list."""
    return df.join(sized(ids), key, "left_semi")


def without_ids(df: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows whose key is null or not in a stored one-column list."""
    return df.join(sized(ids), key, "left_anti")


def sheltered(df: DataFrame, used: Sequence[str], own: Iterable[str]) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """The columns an operator reads, apart from all others, and how to put its result together again.

    The narrow table has `used` and, if there are others, one struct `_rest` of them, so that an operator's helper columns can
    have any names. The second value takes a result that kept `_rest`, and its columns to add: it selects all input columns but
    those named like the operator's own, in their order, and then the added ones.
    """
    kept = [c for c in df.columns if c.lower() not in {o.lower() for o in own}]
    others = [c for c in kept if c not in used]
    rest = [F.struct(*[F.col(f"`{c}`") for c in others]).alias("_rest")] if others else []
    narrow = df.select(*[F.col(f"`{c}`") for c in used if c in df.columns], *rest)

    def back(out: DataFrame, *added: Column | str) -> DataFrame:
        columns = [F.col("_rest").getField(c).alias(c) if c in others else F.col(f"`{c}`") for c in kept]
        return out.select(*columns, *added)

    return narrow, back


def fresh(df: DataFrame, *wanted: str) -> str | list[str]:
    """Helper column names that the table does not have, as near to the wanted ones as can be."""
    taken, names = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names if len(names) > 1 else names[0]
