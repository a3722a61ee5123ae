"""Plan shapes that matter at scale: hot keys are split, scans are pruned, nothing is paired."""

import glob

import pytest
from pyspark.sql import functions as F

from convivio.operators import joins, maintenance, quality
from convivio.sources import tables

SMALL_TASKS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_tasks(spark):
    """Sizes that make a test table look big."""
    before = {k: spark.conf.get(k, None) for k in SMALL_TASKS}
    for key, value in SMALL_TASKS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def hot_children(spark, rows=120000):
    """A third of the rows refer to user 7."""
    user = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997).cast("long")
    return spark.range(0, rows, 1, 8).select(F.col("id").alias("post_id"), user.alias("user_id"))


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def run(df):
    df.write.format("noop").mode("overwrite").save()
    got = df.count()
    df.collect()
    return got


def test_orphan_rows_of_a_hot_parent(small_tasks):
    children = hot_children(small_tasks)
    parents = small_tasks.range(500).filter("id != 7").select(F.col("id").alias("user_id"))
    found = quality.orphans(children, "user_id", parents, "user_id")
    want = children.filter((F.col("user_id") == 7) | (F.col("user_id") >= 500)).count()
    assert run(found) == want
    assert "skew=true" in final_plan(found)


def test_cascade_from_a_hot_user(small_tasks):
    children = hot_children(small_tasks)
    gone = small_tasks.range(3).select((F.col("id") * 7).alias("user_id"))
    left = quality.cascade_delete(gone, {"posts": (children, ["user_id"])})["posts"]
    assert run(left) == children.filter(~F.col("user_id").isin(0, 7, 14)).count()
    assert "skew=true" in final_plan(left)


def test_hot_followed_account(small_tasks):
    spark = small_tasks
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997).cast("long")
    asked = spark.range(0, 600000, 1, 8).select(
        F.col("id").alias("request_id"), F.col("id").alias("follower_id"), hot.alias("following_id"),
        F.lit("2026-01-01").cast("timestamp_ntz").alias("at"))
    users = spark.range(600000).select(F.col("id").alias("user_id"))
    stored = spark.createDataFrame([(3, 7)], "follower_id long, following_id long")
    judged = maintenance.classify_follows(asked, users, stored)
    assert run(judged.filter("status = 'COMMITTED'")) == 599999
    judged.collect()
    assert "skew=true" in final_plan(judged)


def test_distinct_likes_of_a_hot_post(small_tasks):
    spark = small_tasks
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997).cast("long")
    likes = spark.range(0, 600000, 1, 8).select(F.xxhash64("id").alias("like_id"), hot.alias("post_id"))
    posts = spark.range(1000).select(F.col("id").alias("post_id"), (F.col("id") % 50).alias("user_id"))
    users = spark.range(50).select(F.col("id").alias("user_id"), F.col("id").cast("string").alias("username"))
    none = spark.createDataFrame([], "follower_id long, following_id long")
    stats = joins.social_stats(users, posts, likes, none, keys_unique=False)
    assert sum(r.num_likes for r in stats.collect()) == 600000
    assert "skew=true" in final_plan(stats)


def test_one_big_shard_has_many_writers(small_tasks, tmp_path):
    rows = small_tasks.range(0, 60000, 1, 8).select((F.col("id") * 3).alias("user_id"), F.sha2(
        F.col("id").cast("string"), 256).alias("text"))
    path = tables.write_hash_layout(rows, f"{tmp_path}/h", "user_id")
    assert len(glob.glob(f"{path}/shard=0/*.parquet")) > 4
    assert tables.scan(small_tasks, path).count() == 60000


def test_engagement_reads_two_columns_and_shuffles_partial_counts(spark, data):
    from convivio.sources.stand_ins import SocialTables

    t = SocialTables(spark, data)
    likes = tables.scan(spark, f"{data}/lineitem.parquet").select(
        F.col("l_linenumber").cast("long").alias("like_id"), F.col("l_orderkey").alias("post_id"), "l_comment"
        if "l_comment" in t.raw("lineitem").columns else "l_shipdate")
    plan = final_plan(joins.social_stats(t.users, t.posts, likes, t.followers))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan
    assert "partial_count(like_id" in plan and "Expand" not in plan
    assert plan.count("orders.parquet") == 1


def test_key_range_reaches_the_other_scans(spark, data):
    from convivio.operators import filters
    from convivio.sources.stand_ins import SocialTables

    t = SocialTables(spark, data)
    chosen = filters.key_range(t.users, "user_id", 1, 100)
    plan = final_plan(joins.posts_per_user(chosen, t.posts))
    assert "GreaterThanOrEqual(c_custkey,1)" in plan and "GreaterThanOrEqual(o_custkey,1)" in plan
