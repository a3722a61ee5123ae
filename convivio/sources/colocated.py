"""Tables in buckets of a key, so that joins and sums on the key need no shuffle.

A bucket is read by one task, so a key that holds a large share of the rows must not be in one. Keys with more than
`hot_rows` rows, and rows without a key, are therefore kept apart in plain files, which any number of tasks read;
there are at most rows / hot_rows such keys. Whatever sums by key takes the buckets as they are, adds the hot part up in
the map tasks, and meets the few sums by a broadcast.

Buckets are a table of the session's catalog over files in a folder of the caller, which all executors share. `open_colocated`
names the same files in another session.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import zero_if_null
from ..session import durable

HOT_ROWS = 5_000_000
# Sums of hot keys are broadcast up to so many keys, which take about 64 MB; their number is counted.
BROADCAST_KEYS = 1_000_000


class Colocated(NamedTuple):
    """`table` is bucketed by `key`; `hot` has the rows of frequent keys and of none."""

    table: DataFrame
    hot: DataFrame
    key: str
    hot_keys: int


def _sized(df: DataFrame, keys: int) -> DataFrame:
    return F.broadcast(df) if keys <= BROADCAST_KEYS else df


def write_colocated(df: DataFrame, path: str, key: str, buckets: int, hot_rows: int = HOT_ROWS) -> Colocated:
    """Store a table in `buckets` files of its key, sorted by it."""
    held = df.filter(F.col(key).isNotNull())
    frequent = durable(held.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows).select(key))
    keys = frequent.count()
    few = _sized(frequent, keys)
    rest = held.join(few, key, "left_anti").select(*df.columns)
    # One task for each bucket, so each bucket is one file.
    (rest.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", f"{path}/buckets")
        .mode("errorifexists").saveAsTable(_name()))
    hot = held.join(few, key, "left_semi").select(*df.columns).unionByName(df.filter(F.col(key).isNull()))
    hot.write.mode("errorifexists").parquet(f"{path}/hot")
    return open_colocated(df.sparkSession, path, df.schema, key, buckets, keys)


def _name() -> str:
    return f"convivio_{uuid.uuid4().hex}"


def open_colocated(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int,
                   hot_keys: int | None = None) -> Colocated:
    """A stored layout as tables of this session; hot keys are counted if their number is not given."""
    name, columns = _name(), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (path '{path}/buckets') "
              f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS")
    hot = spark.read.schema(schema).parquet(f"{path}/hot")
    if hot_keys is None:
        hot_keys = hot.select(F.count_distinct(key)).first()[0]
    return Colocated(spark.table(name), hot, key, hot_keys)


def _with_counts(left: DataFrame, left_key: str, counted: Colocated, column: str | None, name: str) -> DataFrame:
    """`left`, bucketed by its key, with the number of rows, or of non-null `column`s, for each key of another layout."""
    rows = F.count(F.lit(1) if column is None else F.col(column))
    ordinary, hot = [part.groupBy(F.col(counted.key).alias("_key")).agg(rows.alias("_n"))
                     for part in (counted.table, counted.hot)]
    hot = _sized(hot.select(F.col("_key").alias("_hot_key"), F.col("_n").alias("_hot_n")), counted.hot_keys)
    joined = left.join(ordinary, F.col(left_key) == F.col("_key"), "left").join(
        hot, F.col(left_key) == F.col("_hot_key"), "left")
    # A key is in one of the two parts.
    return joined.withColumn(name, zero_if_null(F.coalesce("_n", "_hot_n"))).drop("_key", "_n", "_hot_key", "_hot_n")


def posts_per_user(users: Colocated, posts: Colocated) -> DataFrame:
    """Every user with the number of their posts: both layouts by user_id, no shuffle."""
    return _with_counts(users.table, "user_id", posts, "post_id", "post_count").select("user_id", "username", "post_count")


def social_stats(users: Colocated, posts: Colocated, likes: Colocated, followers: Colocated) -> DataFrame:
    """Posts, likes received and followers of every user, for declared keys that hold.

    Layouts: users by user_id, posts and likes by post_id, followers by following_id. Likes and followers are added up in
    their buckets; only one sum for each user and task is shuffled.
    """
    authored = _with_counts(posts.table, "post_id", likes, "like_id", "_likes")
    totals = authored.groupBy(F.col("user_id").alias("_author")).agg(
        F.count("post_id").alias("num_posts"), F.sum("_likes").alias("num_likes"))
    followed = _with_counts(users.table, "user_id", followers, "follower_id", "num_followers")
    joined = followed.join(totals, F.col("user_id") == F.col("_author"), "left")
    return joined.select("user_id", "username", zero_if_null(F.col("num_posts")).alias("num_posts"),
                         zero_if_null(F.col("num_likes")).alias("num_likes"), "num_followers")


def counter_drift(table: Colocated, stored: str, actual: Colocated) -> DataFrame:
    """Rows whose stored counter differs from the real number of rows of their key: no shuffle."""
    counted = _with_counts(table.table, table.key, actual, None, "actual")
    return counted.select(table.key, F.col(stored).alias("stored"), "actual",
                          (F.col(stored) - F.col("actual")).alias("drift")).filter(
        F.coalesce(F.col("stored") != F.col("actual"), F.lit(True)))
