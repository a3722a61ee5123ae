"""Engagement statistics kept up to date by batches of new and deleted posts, likes and follower edges.

The statistics of a user are sums over posts joined with likes, and over edges. With signed changes (+1 for a new row, -1 for
one that goes) the change of the join P x L is dP x L + (P + dP) x dL, so a batch needs the stored likes of its own posts and
the stored posts of its own likes, and nothing else. A like that comes before its post is stored and counts once the
post is there; a deleted post takes its likes' count with it, and likes of it stay stored.

Tables lie in hash layout: posts and likes by post_id, edges by following_id, statistics by user_id. A batch reads and
writes only the folders of its keys (`sources.merges`). Its change is stored first, from the tables as they were;
each table is then merged once under the batch's id. A batch that is cut off and run again therefore ends as it should, and a
finished one does nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import zero_if_null
from ..session import durable, path_exists
from . import merges

_LONG = T.LongType()
POSTS = T.StructType([T.StructField(n, _LONG) for n in ("post_id", "user_id")])
LIKES = T.StructType([T.StructField(n, _LONG) for n in ("post_id", "user_id")])
EDGES = T.StructType([T.StructField(n, _LONG) for n in ("following_id", "follower_id")])
COUNTS = ["num_posts", "num_likes", "num_followers"]
STATS = T.StructType([T.StructField(n, _LONG) for n in ("user_id", *COUNTS)])
# For each table: its schema, and its key, of which the first column gives the folder.
TABLES = {"posts": (POSTS, ["post_id"]), "likes": (LIKES, ["post_id", "user_id"]),
          "edges": (EDGES, ["following_id", "follower_id"])}


class Batch(NamedTuple):
    """Rows to add and keys to delete; deletions come first, and rows that are there already are not added again."""

    added: dict[str, DataFrame]
    deleted: dict[str, DataFrame]


def signed_changes(stored: DataFrame, added: DataFrame, deleted: DataFrame, key: Sequence[str]) -> DataFrame:
    """What a batch changes in a stored table: its rows with `sign` -1 for those that go and 1 for new ones."""
    keys = deleted.select(*key)
    gone = stored.join(keys, list(key), "left_semi").select(*stored.columns)
    left = stored.join(keys, list(key), "left_anti").select(*key)
    new = added.select(*stored.columns).dropna(subset=list(key)).dropDuplicates(list(key)).join(left, list(key), "left_anti")
    one = F.lit(1).cast("long")
    return gone.withColumn("sign", -one).unionByName(new.select(*stored.columns).withColumn("sign", one))


def stats_change(posts: DataFrame, likes: DataFrame, d_posts: DataFrame, d_likes: DataFrame, d_edges: DataFrame) -> DataFrame:
    """(user_id, changes of the counts) from the stored posts and likes and the signed changes of all tables.

    `posts` and `likes` need the rows of the changed posts, and the posts of the changed likes, only.
    """
    zero = F.lit(0).cast("long")

    def rows(df: DataFrame, user: str, **counts) -> DataFrame:
        return df.select(F.col(user).alias("user_id"), *[counts.get(n, zero).alias(n) for n in COUNTS])

    # dP x L: likes are added up for each post before they meet it.
    changed = likes.join(d_posts.select("post_id").distinct(), "post_id", "left_semi")
    held = changed.groupBy("post_id").agg(F.count(F.lit(1)).alias("held"))
    by_post = rows(d_posts.join(held, "post_id", "left"), "user_id", num_posts=F.col("sign"),
                   num_likes=F.col("sign") * zero_if_null(F.col("held")))
    # (P + dP) x dL
    moved = d_likes.groupBy("post_id").agg(F.sum("sign").alias("moved"))
    every = posts.select("post_id", "user_id", F.lit(1).cast("long").alias("sign")).unionByName(
        d_posts.select("post_id", "user_id", "sign"))
    by_like = rows(moved.join(every, "post_id"), "user_id", num_likes=F.col("sign") * F.col("moved"))
    by_edge = rows(d_edges, "following_id", num_followers=F.col("sign"))
    summed = by_post.unionByName(by_like).unionByName(by_edge).filter("user_id IS NOT NULL").groupBy("user_id")
    return summed.agg(*[F.sum(n).alias(n) for n in COUNTS])


def _add_counts(current: DataFrame, change: DataFrame) -> DataFrame:
    """Counts with their changes; users that had none before get a row."""
    both = current.select(STATS.names).unionByName(change.select(STATS.names))
    return both.groupBy("user_id").agg(*[F.sum(n).alias(n) for n in COUNTS])


def apply_batch(spark: SparkSession, base: str, batch: Batch, batch_id: int | str, shards: int) -> None:
    """Bring the tables and statistics under `base` up to date by one batch."""
    stage = f"{base}/changes/batch-{batch_id}"
    changes = {}
    if not path_exists(spark, f"{stage}/done/_SUCCESS"):
        touched = {}
        for name, (schema, key) in TABLES.items():
            none = merges.no_rows(spark, schema)
            # Stored before they are read twice, so that whatever makes a batch's rows runs once.
            added, deleted = [durable(rows[name].select(*names)) if name in rows else none.select(*names)
                              for rows, names in ((batch.added, schema.names), (batch.deleted, key))]
            touched[name] = merges.touched_shards(added.select(key[0]).unionByName(deleted.select(key[0])), key[0], shards)
            stored = merges.read_shards(spark, f"{base}/{name}", schema, touched[name])
            signed_changes(stored, added, deleted, key).write.mode("overwrite").parquet(f"{stage}/{name}")
            changes[name] = spark.read.parquet(f"{stage}/{name}")
        both = sorted({*touched["posts"], *touched["likes"]})
        posts, likes = [merges.read_shards(spark, f"{base}/{n}", TABLES[n][0], both) for n in ("posts", "likes")]
        change = stats_change(posts, likes, changes["posts"], changes["likes"], changes["edges"])
        change.write.mode("overwrite").parquet(f"{stage}/stats")
        spark.range(0).write.mode("overwrite").parquet(f"{stage}/done")
    summed = spark.read.schema(STATS).parquet(f"{stage}/stats")
    merges.merge(f"{base}/stats", summed, "user_id", STATS, _add_counts, shards, batch_id, stored=True)
    for name, (schema, key) in TABLES.items():
        def renew(current: DataFrame, change: DataFrame, key=key) -> DataFrame:
            gone = change.filter("sign < 0").select(*key)
            left = current.join(gone, key, "left_anti").select(*current.columns)
            return left.unionByName(change.filter("sign > 0").select(*current.columns))

        change = spark.read.schema(T.StructType([*schema.fields, T.StructField("sign", _LONG)])).parquet(f"{stage}/{name}")
        merges.merge(f"{base}/{name}", change, key[0], schema, renew, shards, batch_id, stored=True)


def maintained_stats(spark: SparkSession, base: str, users: DataFrame) -> DataFrame:
    """Posts, likes received and followers of every user, as `joins.social_stats` gives them."""
    stats = merges.read_shards(spark, f"{base}/stats", STATS)
    joined = users.select("user_id", "username").join(stats, "user_id", "left")
    return joined.select("user_id", "username", *[zero_if_null(F.col(n)).alias(n) for n in COUNTS])
