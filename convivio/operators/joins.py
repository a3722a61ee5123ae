"""Joins between users, posts, likes and follower edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import shard_of, zero_if_null
from ..schema import SHARDS


def posts_per_user(users: DataFrame, posts: DataFrame) -> DataFrame:
    """Every user with the number of their posts, zero included.

    Posts are counted before the join, so a prolific author is one row per map task when it
    reaches the shuffle, and the join meets one row per user on both sides.
    """
    counted = posts.groupBy("user_id").agg(F.count("post_id").alias("post_count"))
    joined = users.join(counted, "user_id", "left")
    return joined.select("user_id", "username", zero_if_null(F.col("post_count")).alias("post_count"))


def user_profile_with_posts(users: DataFrame, posts: DataFrame) -> DataFrame:
    """All user columns plus the post count."""
    counted = posts.groupBy("user_id").agg(F.count("post_id").alias("post_count"))
    kept = [c for c in users.columns if c != "post_count"]
    return (users.select(*kept).join(counted, "user_id", "left")
            .withColumn("post_count", zero_if_null(F.col("post_count"))))


def social_stats(users: DataFrame, posts: DataFrame, likes: DataFrame, followers: DataFrame,
                 keys_unique: bool = True, few: bool = False) -> DataFrame:
    """Per user: distinct posts, distinct likes on those posts, distinct followers.

    The three-way join of the original query multiplies posts by likes by followers. Here likes
    shrink to one row per post first, and post and follower contributions are summed together, so
    every shuffled side is already aggregated by its map tasks and posts are read once. This
    needs the declared keys to hold (post_id, like_id, follower pair); with
    `keys_unique=False` each count is distinct over whatever duplicates there are. Set `few` when the
    users are a small part of all: posts and followers of others are then left out first, and likes are not
    summed for all posts but meet the few posts as they are.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    if few:
        chosen = users.select("user_id")
        posts = posts.join(chosen, "user_id", "left_semi")
        followers = followers.join(chosen.withColumnRenamed("user_id", "following_id"), "following_id", "left_semi")
    if not keys_unique:
        return _social_stats_distinct(users, posts, likes, followers)

    def held(key):
        return F.when(F.col(key).isNotNull(), one).otherwise(zero)

    if few:
        received = likes.select("post_id", "like_id").join(posts.select("post_id", "user_id"), "post_id").select(
            "user_id", zero.alias("posts"), held("like_id").alias("likes"), zero.alias("followers"))
        authored = posts.select("user_id", held("post_id").alias("posts"), zero.alias("likes"),
                                zero.alias("followers")).unionByName(received)
    else:
        likes_by_post = likes.groupBy("post_id").agg(F.count("like_id").alias("likes"))
        authored = posts.join(likes_by_post, "post_id", "left").select(
            "user_id", held("post_id").alias("posts"), zero_if_null(F.col("likes")).alias("likes"), zero.alias("followers"))
    followed = followers.select(F.col("following_id").alias("user_id"), zero.alias("posts"), zero.alias("likes"),
                                held("follower_id").alias("followers"))
    totals = authored.unionByName(followed).groupBy("user_id").agg(
        F.sum("posts").alias("num_posts"), F.sum("likes").alias("num_likes"),
        F.sum("followers").alias("num_followers"))
    return _stats_columns(users.join(totals, "user_id", "left"))


def _social_stats_distinct(users: DataFrame, posts: DataFrame, likes: DataFrame,
                           followers: DataFrame) -> DataFrame:
    by_author = posts.groupBy("user_id").agg(F.countDistinct("post_id").alias("num_posts"))
    liked = (likes.select("like_id", "post_id").distinct()
             .join(posts.select("post_id", "user_id").distinct(), "post_id")
             .groupBy("user_id").agg(F.countDistinct("like_id").alias("num_likes")))
    followed = followers.groupBy(F.col("following_id").alias("user_id")).agg(
        F.countDistinct("follower_id").alias("num_followers"))
    joined = users
    for branch in (by_author, liked, followed):
        joined = joined.join(branch, "user_id", "left")
    return _stats_columns(joined)


def _stats_columns(joined: DataFrame) -> DataFrame:
    names = ["num_posts", "num_likes", "num_followers"]
    return joined.select("user_id", "username", *[zero_if_null(F.col(n)).alias(n) for n in names])


def first_cross_shard_pair(users: DataFrame, among: int = 50, shards: int = SHARDS) -> DataFrame:
    """First (follower, following) on different shards among the lowest ids.

    The first pair joins the lowest id overall with the lowest id of any other shard, so the
    lowest id of each shard is enough: at most `shards` rows, and no pairs are formed.
    """
    lowest = users.orderBy("user_id").limit(among)
    per_shard = lowest.groupBy(shard_of(F.col("user_id"), shards).alias("shard_id")).agg(
        F.min(F.struct("user_id", "username")).alias("u"))
    ranked = per_shard.agg(F.array_sort(F.collect_list(F.struct("u", "shard_id"))).alias("firsts"))
    a, b = F.get("firsts", F.lit(0)), F.get("firsts", F.lit(1))
    return ranked.filter(F.size("firsts") > 1).select(
        a["u"]["user_id"].alias("follower_id"), a["u"]["username"].alias("follower_name"),
        a["shard_id"].alias("follower_shard"), b["u"]["user_id"].alias("following_id"),
        b["u"]["username"].alias("following_name"), b["shard_id"].alias("following_shard"))


def shard_matrix(edges: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Edges per (source shard, target shard), and each cell's share of all edges."""
    cells = edges.groupBy(
        shard_of(F.col("follower_id"), shards).alias("source_shard"),
        shard_of(F.col("following_id"), shards).alias("target_shard"),
    ).agg(F.count(F.lit(1)).alias("edges"))
    # At most shards * shards cells are gathered to divide them by their sum.
    gathered = cells.agg(F.collect_list(F.struct("*")).alias("cells"), F.sum("edges").alias("total"))
    return gathered.select("total", F.inline("cells")).select(
        "source_shard", "target_shard", "edges",
        (F.col("source_shard") != F.col("target_shard")).alias("cross_shard"),
        (F.col("edges") / F.col("total")).alias("share"))


def cross_shard_share(edges: DataFrame, shards: int = SHARDS) -> DataFrame:
    crossing = shard_of(F.col("follower_id"), shards) != shard_of(F.col("following_id"), shards)
    return edges.agg(
        F.count(F.lit(1)).alias("edges"),
        F.coalesce(F.sum(crossing.cast("long")), F.lit(0).cast("long")).alias("cross_edges"),
    ).withColumn("cross_share", F.when(F.col("edges") > 0, F.col("cross_edges") / F.col("edges"))
                 .otherwise(F.lit(0.0)))


def pair_count(edges: DataFrame, follower_id: int, following_id: int) -> DataFrame:
    """How often one edge is stored (0 or 1 when the key holds)."""
    hit = (F.col("follower_id") == follower_id) & (F.col("following_id") == following_id)
    return edges.filter(hit).agg(F.count(F.lit(1)).alias("relationship_count"))


def pair_counts(requests: DataFrame, edges: DataFrame) -> DataFrame:
    """The same for every distinct requested pair."""
    pair = ["follower_id", "following_id"]
    stored = edges.groupBy(*pair).agg(F.count(F.lit(1)).alias("relationship_count"))
    return (requests.select(*pair).distinct().join(stored, pair, "left")
            .withColumn("relationship_count", zero_if_null(F.col("relationship_count"))))
