"""Layouts for lookups and feeds: what a query reads; random pairs: all different, spread like draws."""

import glob
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from convivio.operators import filters, generate, ordering
from convivio.sources import tables


def rows_read(df):
    """Rows that the scan returned after it skipped row groups and files."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().head()
    leaf = node.executedPlan() if hasattr(node, "executedPlan") and "AdaptiveSparkPlan" in node.nodeName() else node
    while leaf.children().size():
        leaf = leaf.children().head()
    return leaf.metrics().apply("numOutputRows").value()


@pytest.mark.parametrize("kept", [True, False])
def test_a_name_is_found_in_few_row_groups(spark, tmp_path, kept):
    users = spark.range(40000).select(F.col("id").alias("user_id"), F.sha2(F.col("id").cast("string"), 256).alias("username"))
    path = str(tmp_path / "users")
    shuffled = users.repartition(8, F.xxhash64("user_id"))
    if kept:
        tables.write_lookup_table(shuffled, path, "username", 2000, 64 * 1024)
    else:
        shuffled.write.parquet(path)
    name = users.filter("user_id = 777").first().username
    found = filters.point_lookup(tables.scan(spark, path), "username", name)
    read = rows_read(found)
    assert [r.user_id for r in found.collect()] == [777]
    assert read < 4000 if kept else read > 20000


def test_a_feed_opens_few_files_and_a_hot_user_has_several(spark, tmp_path, rows):
    at = F.timestamp_seconds(F.col("id") % 5000).cast("timestamp_ntz")
    user = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900).cast("long")
    posts = spark.range(30000).select(F.col("id").alias("post_id"), user.alias("user_id"), at.alias("created_at"))
    path = tables.write_feed_layout(posts, str(tmp_path / "feed"), 24)
    assert len(glob.glob(f"{path}/rows/part=*/*.parquet")) >= 20
    for who, few in ((7, False), (311, True), (898, True), (5000, True)):
        feed = tables.read_feed_layout(spark, path, who)
        opened = {r[0] for r in feed.select(F.input_file_name()).collect()}
        assert len(opened) <= 2 if few else 6 <= len(opened) <= 12
        plan = feed._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "part" in plan.split("PartitionFilters: [")[1].split("]")[0] or who == 5000
        assert rows(ordering.user_feed(feed, who)) == rows(ordering.user_feed(posts, who))
    hot = tables.scan(spark, f"{path}/rows").filter("user_id = 7").groupBy("part").agg(F.min("created_at").alias("a"), F.max("created_at").alias("b"))
    spans = [(r.a, r.b) for r in hot.orderBy("part").collect()]
    assert all(later[1] <= earlier[0] for earlier, later in zip(spans, spans[1:]))


def test_random_edges_are_different_and_uneven_like_draws(spark):
    users, count = 300, 6000
    edges = generate.random_followers(spark.range(1, count + 1), users, F.lit("2024-01-01").cast("timestamp_ntz")).collect()
    pairs = {(r.follower_id, r.following_id) for r in edges}
    assert len(pairs) == count and all(a != b and 1 <= a <= users and 1 <= b <= users for a, b in pairs)
    draw = random.Random(1)
    want = Counter(draw.randrange(users) for _ in range(count))

    def variance(counts):
        values = [counts.get(k, 0) for k in counts] + [0] * (users - len(counts))
        return sum((v - count / users) ** 2 for v in values) / users

    for side in (0, 1):
        got = variance(Counter(p[side] for p in pairs))
        # Independent draws have a variance of about the mean, 20; an even spread has none.
        assert 0.6 * variance(want) < got < 1.6 * variance(want)


@pytest.mark.parametrize("posts,users", [(5, 3), (1, 7), (7, 1), (16, 16)])
def test_all_pairs_are_a_permutation(spark, posts, users):
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    likes = generate.random_likes(spark.range(1, posts * users + 1), posts, F.lit(users), at).collect()
    assert {(r.post_id, r.user_id) for r in likes} == {(p, u) for p in range(1, posts + 1) for u in range(1, users + 1)}
    with pytest.raises(Exception, match="more pairs"):
        generate.random_likes(spark.range(1, posts * users + 2), posts, users, at).collect()

