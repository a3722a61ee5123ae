"""Feeds, listings and bounded samples. Every limit orders by a full key first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.draws import draw
from .windows import top_per_key


def user_feed(posts: DataFrame, user_id: int, size: int = 20) -> DataFrame:
    """Newest posts of one user."""
    return posts.filter(F.col("user_id") == user_id).orderBy(F.desc("created_at"), "post_id").limit(size)


def all_feeds(posts: DataFrame, size: int = 20) -> DataFrame:
    return top_per_key(posts, ["user_id"], [F.desc("created_at"), F.asc("post_id")], size)


def latest(df: DataFrame, key: str, size: int = 10, at: str = "created_at") -> DataFrame:
    return df.orderBy(F.desc(at), key).limit(size)


def oldest_pending(outbox: DataFrame, size: int = 100) -> DataFrame:
    """The next FIFO batch of unprocessed events."""
    return outbox.filter(~F.col("processed")).orderBy("event_id").limit(size)


def first_keys(df: DataFrame, key: str, size: int) -> DataFrame:
    return df.orderBy(key).limit(size)


def random_row(df: DataFrame, key: str, seed: int = 42, size: int = 1) -> DataFrame:
    """Repeatable sample: the rows with the lowest draws."""
    return df.orderBy(draw(F.col(key), "sample", seed), key).limit(size)


def listing(df: DataFrame, *order) -> DataFrame:
    return df.orderBy(*order)
