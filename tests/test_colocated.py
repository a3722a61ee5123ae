"""Bucketed layouts: same rows as the plain joins, and no exchange on the large sides."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from convivio.operators import joins, quality
from convivio.sources import colocated


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    for key in keys:
        spark.conf.set(key, "-1")
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


@pytest.fixture
def tables(spark):
    """User 7 wrote a third of the posts, post 3 got a third of the likes, user 5 has half of the followers; some keys are null."""
    n = F.col("id")
    users = spark.range(200).select(n.alias("user_id"), F.concat(F.lit("u"), n).alias("username"))
    author = F.when(n % 3 == 0, 7).when(n % 50 == 1, None).otherwise(n % 211)
    posts = spark.range(6000).select(n.alias("post_id"), author.cast("long").alias("user_id"), (n % 5).alias("like_count"))
    target = F.when(n % 3 == 0, 3).when(n % 100 == 1, None).otherwise(n % 6500)
    likes = spark.range(20000).select(n.alias("like_id"), target.cast("long").alias("post_id"))
    followed = F.when(n % 2 == 0, 5).otherwise(n % 190)
    followers = spark.range(4000).select(n.alias("follower_id"), followed.cast("long").alias("following_id"))
    return users, posts, likes, followers


def stored(tmp_path, df, key, name, hot_rows=1000):
    return colocated.write_colocated(df, str(tmp_path / name), key, 8, hot_rows)


def exchanged_buckets(df):
    """Columns of the shuffles that stand above a bucketed scan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n")
    depth = [re.search(r"\w", line).start() if re.search(r"\w", line) else 0 for line in plan]
    found = []
    for at, line in enumerate(plan):
        if name := re.search(r"Exchange hashpartitioning\(([a-z_]+)#", line):
            below = next((n for n in range(at + 1, len(plan)) if depth[n] <= depth[at]), len(plan))
            found += [name[1]] * any("Bucketed: true" in under for under in plan[at:below])
    return found


def test_posts_per_user(no_broadcast, tmp_path, tables, rows):
    users, posts, _, _ = tables
    u, p = stored(tmp_path, users, "user_id", "u"), stored(tmp_path, posts, "user_id", "p")
    got = colocated.posts_per_user(u, p)
    assert rows(got) == rows(joins.posts_per_user(users, posts))
    # Only the hot part, which is added up in the map tasks, is exchanged.
    assert exchanged_buckets(got) == [] and p.hot_keys == 1
    assert {r.user_id for r in p.hot.select("user_id").distinct().collect()} == {7, None}
    assert len(glob.glob(f"{tmp_path}/p/buckets/*.parquet")) == 8


def test_social_stats(no_broadcast, tmp_path, tables, rows):
    users, posts, likes, followers = tables
    got = colocated.social_stats(
        stored(tmp_path, users, "user_id", "u"), stored(tmp_path, posts, "post_id", "p"),
        stored(tmp_path, likes, "post_id", "l"), stored(tmp_path, followers, "following_id", "f"))
    assert rows(got) == rows(joins.social_stats(users, posts, likes, followers))
    # Only the sums for each author, once by the shuffle's own number of partitions and once by the buckets'.
    assert sorted(exchanged_buckets(got)) == ["_author", "user_id"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") >= 4


def test_counter_drift(no_broadcast, tmp_path, tables, rows):
    _, posts, likes, _ = tables
    got = colocated.counter_drift(stored(tmp_path, posts, "post_id", "p"), "like_count", stored(tmp_path, likes, "post_id", "l"))
    assert rows(got) == rows(quality.counter_drift(posts, "post_id", "like_count", likes, "post_id"))
    assert exchanged_buckets(got) == []


def test_another_session_opens_the_files(spark, tmp_path, tables, rows):
    _, posts, _, _ = tables
    stored(tmp_path, posts, "user_id", "p")
    again = colocated.open_colocated(spark.newSession(), str(tmp_path / "p"), posts.schema, "user_id", 8)
    assert again.hot_keys == 1
    assert rows(again.table.unionByName(again.hot)) == rows(posts)


def test_empty_layouts(spark, tmp_path, tables, rows):
    users, posts, _, _ = tables
    u, p = stored(tmp_path, users, "user_id", "u"), stored(tmp_path, posts.limit(0), "user_id", "p")
    assert {r.post_count for r in colocated.posts_per_user(u, p).collect()} == {0}
