"""Keep-latest and top-n per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of each key.

    Catalyst turns the rank filter into a per-task group limit before the exchange, so a hot key
    sends at most n rows from each map task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def keep_latest(df: DataFrame, keys: Sequence[str], at: str = "created_at",
                tie_break: Sequence[Column] = ()) -> DataFrame:
    """Newest row per key."""
    return top_per_key(df, keys, [F.desc(at), *tie_break], 1)


def latest_moment(df: DataFrame, keys: Sequence[str], at: str = "created_at") -> DataFrame:
    """The keep-latest result when the key and the moment are all that is needed: no sort."""
    return df.groupBy(*keys).agg(F.max(at).alias(at))
