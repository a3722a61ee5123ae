import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from convivio.functions import draws
from convivio.operators import generate as g

AS_OF = dt.datetime(2026, 4, 13)


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def tables(spark, n, parts):
    ids = spark.range(1, n + 1, 1, parts)

    def named(name):
        return ids.select(F.col("id").alias(name))

    return {
        "users": g.users(named("user_id"), as_of()), "posts": g.posts(named("post_id"), 50, as_of()),
        "comments": g.comments(named("comment_id"), 100, 50, as_of()),
        "followers": g.followers(ids, 30, as_of()), "likes": g.likes(ids, 40, 20, as_of()),
        "some followers": g.followers(ids, 30, as_of(), count=100), "some likes": g.likes(ids, 40, 20, as_of(), count=77),
    }


def test_same_rows_for_any_partitioning(spark, rows):
    one, many = tables(spark, 400, 2), tables(spark, 400, 16)
    for name in one:
        assert rows(one[name]) == rows(many[name]), name


def test_users(spark):
    got = tables(spark, 4000, 4)["users"].collect()
    assert sorted(u.user_id for u in got) == list(range(1, 4001))
    assert len({u.username for u in got}) == 4000
    assert all(u.username.startswith(f"user_{u.user_id}_") and len(u.username.split("_")[2]) == 6 for u in got)
    assert {u.email.split("@")[1] for u in got} == set(g.EMAIL_DOMAINS)
    assert {u.full_name.split(" ")[0] for u in got} == set(g.FIRST_NAMES)
    assert not any("{" in u.bio for u in got)
    cities = {b.replace("Software engineer at ", "") for b in {u.bio for u in got} if b.startswith("Software")}
    assert cities == {place.split(",")[0] for place in g.LOCATIONS}
    assert 0.03 < sum(u.is_verified for u in got) / 4000 < 0.07
    assert 0.26 < sum(u.is_private for u in got) / 4000 < 0.34
    for name, top in (("follower_count", 100000), ("following_count", 50000), ("post_count", 10000)):
        values = [u[name] for u in got]
        assert 0 <= min(values) < top * 0.01 and top * 0.99 < max(values) <= top
    assert all(AS_OF - dt.timedelta(days=365) <= u.created_at <= AS_OF for u in got)


def test_posts(spark):
    got = tables(spark, 3000, 4)["posts"].collect()
    assert sorted(p.post_id for p in got) == list(range(1, 3001))
    assert {p.user_id for p in got} == set(range(1, 51))
    assert {p.location for p in got} == set(g.LOCATIONS)
    tags = [[w for w in p.content.split() if w in g.HASHTAGS] for p in got]
    assert {len(t) for t in tags} == {2, 3, 4}
    assert all(len(set(t)) == len(t) for t in tags)
    assert min(Counter(w for t in tags for w in t).values()) > 700
    assert not any("{" in p.content for p in got)
    assert all(f"#{p.post_id} " in p.content for p in got if p.content.startswith("Check"))
    assert all(AS_OF - dt.timedelta(days=90) <= p.created_at <= AS_OF for p in got)


def test_followers_and_likes(spark):
    made = tables(spark, 2000, 4)
    for name, key in (("followers", ("follower_id", "following_id")), ("likes", ("post_id", "user_id"))):
        got = made[name].collect()
        assert len({(r[key[0]], r[key[1]]) for r in got}) == len(got)
    assert all(r.follower_id != r.following_id for r in made["followers"].collect())
    ids = sorted(r.like_id for r in made["likes"].collect())
    assert ids == list(range(1, len(ids) + 1))
    cut = made["some followers"].collect()
    assert len(cut) == 100 and len({r.follower_id for r in cut}) > 20
    assert sorted(r.like_id for r in made["some likes"].collect()) == list(range(1, 78))


@pytest.mark.parametrize("parents", [0, 1, 7])
def test_sampled_parents_exist(spark, parents):
    table = spark.createDataFrame([(100 + 13 * i,) for i in range(parents)], "pid long")
    got = g.sample_parent(spark.range(500), "id", table, "pid", "parent_id").collect()
    assert len(got) == (500 if parents else 0)
    assert {r.parent_id for r in got} == {100 + 13 * i for i in range(parents)}


def test_weighted_locations(spark):
    def odds(first, second):
        df = spark.range(20000).select(g.weighted_location(F.col("id"), first, second).alias("place"))
        counts = {r.place: r["count"] / 20000 for r in df.groupBy("place").count().collect()}
        return [counts[place] for place in g.LOCATIONS[:3]]

    assert odds(0.5, 0.5) == pytest.approx([0.5, 0.25, 0.25], abs=0.02)
    assert odds(0.4, 0.7) == pytest.approx([0.4, 0.42, 0.18], abs=0.02)


def test_plain_loader_rows(spark):
    ids = spark.range(1, 1001)
    users = g.plain_users(ids, key="id", token_length=8).collect()
    assert all(u.username.startswith(f"user_{u.user_id}_") and len(u.username.split("_")[2]) == 8 for u in users)
    assert all(u.full_name == f"User {u.user_id}" and u.follower_count < 1000 and u.post_count < 100 for u in users)
    posts = g.plain_posts(ids, 10, as_of(), key="id", days=90, tags="#social #network").collect()
    assert all(p.content == f"Post content #{p.post_id} with some hashtags #social #network" for p in posts)
    assert {p.user_id for p in posts} == set(range(1, 11))
    comments = g.plain_comments(ids, 5, 5, as_of(), key="id").collect()
    assert {c.content for c in comments} == {"Great post! #awesome #love"}
    assert all(AS_OF - dt.timedelta(days=120) <= c.created_at <= AS_OF for c in comments)


def test_streams_and_seeds_differ(spark):
    df = spark.range(1000).select(*[
        (draws.draw(F.col("id"), s, seed) % 2).alias(n) for n, s, seed in
        [("a", "x", 1), ("b", "y", 1), ("c", "x", 2)]])
    same = df.agg(F.avg((F.col("a") == F.col("b")).cast("int")), F.avg((F.col("a") == F.col("c")).cast("int"))).first()
    assert all(0.44 < v < 0.56 for v in same)


def test_alphanumeric_of_any_length(spark):
    drawn = draws.draw(F.col("id"), "token", 1)
    rows = spark.range(500).select(draws.alphanumeric(drawn, 6).alias("six"), draws.alphanumeric(drawn, 15).alias("long")).collect()
    assert all(r.long.startswith(r.six) and len(r.long) == 15 and set(r.long) <= set(draws.BASE36) for r in rows)
    assert len({r.long[6:12] for r in rows}) > 490 and all(r.long[:6] != r.long[6:12] for r in rows)


def test_exact_pairs_up_to_the_whole_space(spark):
    ids = spark.range(1, 9 * 8 + 1)
    edges = g.exact_followers(ids, 9, as_of())
    pairs = {(r.follower_id, r.following_id) for r in edges.collect()}
    assert pairs == {(a, b) for a in range(1, 10) for b in range(1, 10) if a != b}
    likes = g.exact_likes(spark.range(1, 36), 4, 9, as_of()).collect()
    assert len({(r.post_id, r.user_id) for r in likes}) == len({r.like_id for r in likes}) == 35
    assert {r.post_id for r in likes} == set(range(1, 5)) and {r.user_id for r in likes} == set(range(1, 10))
    assert "Exchange" not in edges._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="more pairs asked for"):
        g.exact_followers(spark.range(1, 74), 9, as_of()).collect()
