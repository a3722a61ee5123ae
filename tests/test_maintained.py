"""Maintained statistics against the same statistics from scratch."""

import glob
import os
import random

from pyspark.sql import functions as F

from convivio.operators import joins
from convivio.sources import maintained, merges

POST, LIKE, EDGE = "post_id long, user_id long", "post_id long, user_id long", "following_id long, follower_id long"
SHARDS = 4


def frames(spark, posts, likes, edges):
    return {"posts": spark.createDataFrame(sorted(posts.items()), POST), "likes": spark.createDataFrame(sorted(likes), LIKE),
            "edges": spark.createDataFrame(sorted(edges), EDGE)}


def from_scratch(users, now):
    likes = now["likes"].select(F.xxhash64("post_id", "user_id").alias("like_id"), "post_id")
    return joins.social_stats(users, now["posts"], likes, now["edges"])


def test_random_batches(spark, tmp_path, rows):
    """Posts, likes and edges come and go; a third of the likes are of one post, and many come before their post."""
    base, draw = str(tmp_path), random.Random(3)
    users = spark.range(20).select(F.col("id").alias("user_id"), F.concat(F.lit("u"), "id").alias("username"))
    posts, likes, edges = {}, set(), set()
    for number in range(3):
        gone_posts = draw.sample(sorted(posts), len(posts) // 4)
        gone_likes = draw.sample(sorted(likes), len(likes) // 5)
        gone_edges = draw.sample(sorted(edges), len(edges) // 5)
        new_posts = {draw.randrange(60): draw.randrange(22) for _ in range(15)}
        new_likes = {(3 if draw.random() < 0.33 else draw.randrange(60), draw.randrange(20)) for _ in range(30)}
        new_edges = {(draw.randrange(20), draw.randrange(20)) for _ in range(15)}
        batch = maintained.Batch(frames(spark, new_posts, new_likes, new_edges), {
            "posts": spark.createDataFrame([(p,) for p in gone_posts + [999]], "post_id long"),
            "likes": spark.createDataFrame(gone_likes + [(999, 1)], LIKE),
            "edges": spark.createDataFrame(gone_edges + [(999, 1)], EDGE)})
        maintained.apply_batch(spark, base, batch, number, SHARDS)
        for p in gone_posts:
            posts.pop(p)
        posts = new_posts | posts
        likes, edges = (likes - set(gone_likes)) | new_likes, (edges - set(gone_edges)) | new_edges
        now = frames(spark, posts, likes, edges)
        assert rows(maintained.maintained_stats(spark, base, users)) == rows(from_scratch(users, now))
        for name, (schema, _) in maintained.TABLES.items():
            assert rows(merges.read_shards(spark, f"{base}/{name}", schema)) == rows(now[name].select(*schema.names))


def test_a_batch_touches_its_own_folders_and_counts_once(spark, tmp_path, rows):
    base = str(tmp_path)
    users = spark.range(40).select(F.col("id").alias("user_id"), F.lit("u").alias("username"))
    start = frames(spark, {p: p % 40 for p in range(400)}, {(p, 1) for p in range(400)}, {(u, 1) for u in range(40)})
    maintained.apply_batch(spark, base, maintained.Batch(start, {}), "start", SHARDS)
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{base}/*/shard=*/*.parquet")}
    more = maintained.Batch({"likes": spark.createDataFrame([(8, 5), (8, 6), (8, 5), (8, 1)], LIKE)},
                            {"posts": spark.createDataFrame([(16,)], "post_id long")})
    for _ in range(2):
        maintained.apply_batch(spark, base, more, "more", SHARDS)
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{base}/*/shard=*/*.parquet")}
    changed = {f.split(base)[1].rsplit("/", 1)[0] for f in set(before.items()) ^ set(after.items()) for f in f[:1]}
    assert changed == {"/stats/shard=0", "/likes/shard=0", "/posts/shard=0"}
    got = {r.user_id: (r.num_posts, r.num_likes, r.num_followers) for r in maintained.maintained_stats(spark, base, users).collect()}
    assert got[8] == (10, 12, 1) and got[16] == (9, 9, 1) and got[3] == (10, 10, 1)


def test_a_cut_off_batch_goes_on_from_its_stored_change(spark, tmp_path, rows):
    """The statistics and posts are merged, the likes are not: the change is not worked out again from half new tables."""
    base = str(tmp_path)
    users = spark.range(3).select(F.col("id").alias("user_id"), F.lit("u").alias("username"))
    maintained.apply_batch(spark, base, maintained.Batch(frames(spark, {1: 1, 2: 2}, {(1, 0)}, {(1, 2)}), {}), 0, SHARDS)
    batch = maintained.Batch(frames(spark, {3: 1}, {(1, 2), (3, 0)}, {(2, 1)}), {})
    maintained.apply_batch(spark, base, batch, 1, SHARDS)
    want = rows(maintained.maintained_stats(spark, base, users))
    os.remove(f"{base}/likes/_merges/batch-1.done")
    maintained.apply_batch(spark, base, batch, 1, SHARDS)
    assert rows(maintained.maintained_stats(spark, base, users)) == want
    assert rows(merges.read_shards(spark, f"{base}/likes", maintained.LIKES)) == [(1, 0), (1, 2), (3, 0)]


def test_a_shard_that_becomes_empty(spark, tmp_path):
    base = str(tmp_path)
    maintained.apply_batch(spark, base, maintained.Batch(frames(spark, {1: 1, 2: 2}, set(), set()), {}), 0, SHARDS)
    gone = spark.createDataFrame([(1,), (2,)], "post_id long")
    maintained.apply_batch(spark, base, maintained.Batch({}, {"posts": gone}), 1, SHARDS)
    assert merges.read_shards(spark, f"{base}/posts", maintained.POSTS).count() == 0


def test_a_batch_is_worked_out_once(spark, tmp_path):
    """The rows of a batch are made once, whatever reads them; a table not yet written leaves no join in the plan."""
    seen = spark.sparkContext.accumulator(0)

    def counted(part):
        for row in part:
            seen.add(1)
            yield row

    posts = spark.createDataFrame(spark.sparkContext.parallelize([(n, n % 3) for n in range(50)], 2).mapPartitions(counted), POST)
    maintained.apply_batch(spark, str(tmp_path), maintained.Batch({"posts": posts}, {}), 0, SHARDS)
    assert seen.value == 50
    assert merges.read_shards(spark, f"{tmp_path}/posts", maintained.POSTS).count() == 50
    none = merges.read_shards(spark, f"{tmp_path}/absent", maintained.POSTS)
    changes = maintained.signed_changes(none, posts, none.select("post_id"), ["post_id"])
    assert none.schema == maintained.POSTS and "Join" not in changes._jdf.queryExecution().optimizedPlan().toString()
