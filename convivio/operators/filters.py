"""Row selection and derived columns."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import shard_of
from ..schema import SHARDS


def point_lookup(df: DataFrame, key: str, value: Any, layout: tuple[str, int] | None = None) -> DataFrame:
    """Rows whose key equals a value.

    `layout` names the key and the number of shards with which the table was written in hash layout. Only for that
    key is the shard predicate added, which prunes folders.
    """
    hit = F.col(key) == value
    if layout and layout[0] == key:
        hit = hit & (F.col("shard") == shard_of(F.lit(value), layout[1]))
    return df.filter(hit)


def key_range(df: DataFrame, key: str, low: Any, high: Any) -> DataFrame:
    """Both ends included."""
    return df.filter(F.col(key).between(low, high))


def in_list(df: DataFrame, key: str, values: Sequence[Any]) -> DataFrame:
    return df.filter(F.col(key).isin(list(values)))


def like_any(df: DataFrame, column: str, patterns: Sequence[str]) -> DataFrame:
    """SQL LIKE against any pattern; `_` keeps its one-character meaning."""
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | F.col(column).like(pattern)
    return df.filter(hit)


def benchmark_pattern(prefix: str, mode: str) -> str:
    return f"{prefix}_{mode}_%"


def not_self(df: DataFrame, left: str = "follower_id", right: str = "following_id") -> DataFrame:
    return df.filter(F.col(left) != F.col(right))


def since(df: DataFrame, as_of: Column, days: int, at: str = "created_at") -> DataFrame:
    """Rows of the last `days` days before a fixed moment."""
    return df.filter(F.col(at) >= as_of - F.make_dt_interval(days=F.lit(days)))


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))


def pending(outbox: DataFrame) -> DataFrame:
    return outbox.filter(~F.col("processed"))


def lowest_key_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows holding the lowest key, through an uncorrelated scalar subquery."""
    lowest = df.select(F.min(key)).scalar()
    return df.filter(F.col(key) == lowest)


def band(value: Column, limits: Sequence[tuple[Any, str]], otherwise: str) -> Column:
    """CASE by descending thresholds: the first limit below the value names the band."""
    chosen = None
    for limit, name in limits:
        test = value > F.lit(limit)
        chosen = F.when(test, name) if chosen is None else chosen.when(test, name)
    return chosen.otherwise(otherwise)


def with_shard(df: DataFrame, key: str = "user_id", shards: int = SHARDS) -> DataFrame:
    return df.withColumn("shard_id", shard_of(F.col(key), shards))


def status_text(payload: Column, paths: Sequence[str], default: str = "ok") -> Column:
    """Lower-case status from the first JSON path that is present."""
    found = [F.get_json_object(payload, p) for p in paths]
    return F.lower(F.coalesce(*found, F.lit(default)))
