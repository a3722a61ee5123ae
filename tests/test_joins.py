import pytest
from pyspark.sql import functions as F

from convivio.operators import filters, joins, quality


def users(spark, ids):
    return spark.createDataFrame([(i, f"u{i}") for i in ids], "user_id long, username string")


def posts(spark, pairs):
    return spark.createDataFrame(pairs, "post_id long, user_id long")


def likes(spark, pairs):
    return spark.createDataFrame([(n, p, u) for n, (p, u) in enumerate(pairs)],
                                 "like_id long, post_id long, user_id long")


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "follower_id long, following_id long")


def literal_stats(us, ps, ls, fs):
    """The three-way join, written as nested loops over sets."""
    out = []
    for u in us:
        mine = {p for p, owner in ps if owner == u}
        liked = {n for n, (p, _) in enumerate(ls) if p in mine}
        out.append((u, f"u{u}", len(mine), len(liked), len({a for a, b in fs if b == u})))
    return sorted(out, key=repr)


SMALL = ([0, 1, 2, 3], [(10, 0), (11, 0), (12, 1)], [(10, 1), (10, 2), (12, 0)], [(1, 0), (2, 0), (0, 3)])


@pytest.mark.parametrize("unique", [True, False])
def test_social_stats_with_gaps(spark, rows, unique):
    us, ps, ls, fs = SMALL
    got = joins.social_stats(users(spark, us), posts(spark, ps), likes(spark, ls), edges(spark, fs), unique)
    assert rows(got) == literal_stats(us, ps, ls, fs)


def test_social_stats_distinct_handles_duplicates(spark, rows):
    us, ps, ls, fs = SMALL
    got = joins.social_stats(
        users(spark, us), posts(spark, ps * 2), likes(spark, ls).union(likes(spark, ls)), edges(spark, fs * 3),
        keys_unique=False)
    assert rows(got) == literal_stats(us, ps, ls, fs)


def test_social_stats_on_empty_tables(spark, rows):
    got = joins.social_stats(users(spark, [5]), posts(spark, []), likes(spark, []), edges(spark, []))
    assert rows(got) == [(5, "u5", 0, 0, 0)]


@pytest.mark.parametrize("unique", [True, False])
def test_social_stats_with_a_hot_post(spark, rows, unique):
    """One post holds a third of all likes, one user a third of all followers."""
    us = list(range(60))
    ps = [(100 + i, i % 20) for i in range(120)]
    ls = [(100, u) for u in range(200)] + [(100 + i % 120, i) for i in range(400)]
    ls = list(dict.fromkeys(ls))
    fs = list(dict.fromkeys([(i, 7) for i in range(100)] + [(i % 60, (i * 13) % 60) for i in range(200)]))
    got = joins.social_stats(users(spark, us), posts(spark, ps), likes(spark, ls), edges(spark, fs), unique)
    assert rows(got) == literal_stats(us, ps, ls, fs)


def cross_pair_loop(ids):
    low = sorted(ids)[:50]
    return next(((a, b) for a in low for b in low if a != b and a % 3 != b % 3), None)


@pytest.mark.parametrize("ids", [[1, 2, 3], [3, 6, 9, 10], [3, 6, 9], [], [4],
                                 [3 * i for i in range(60)] + [1000], list(range(7, 99, 3)) + [200]])
def test_first_cross_shard_pair(spark, ids):
    got = joins.first_cross_shard_pair(users(spark, ids)).collect()
    want = cross_pair_loop(ids)
    assert [(r.follower_id, r.following_id) for r in got] == ([want] if want else [])


def test_shard_matrix_and_share(spark):
    fs = edges(spark, [(0, 1), (0, 3), (1, 2), (4, 5)])
    cells = {(r.source_shard, r.target_shard): (r.edges, r.share) for r in joins.shard_matrix(fs).collect()}
    assert cells == {(0, 1): (1, 0.25), (0, 0): (1, 0.25), (1, 2): (2, 0.5)}
    assert joins.cross_shard_share(fs).first()["cross_share"] == 0.75
    assert joins.cross_shard_share(edges(spark, [])).first()["cross_share"] == 0.0
    assert joins.shard_matrix(edges(spark, [])).collect() == []


def test_negative_ids_stay_in_range(spark):
    got = filters.with_shard(users(spark, [-5, -3, -1])).select("shard_id").collect()
    assert [r.shard_id for r in got] == [1, 0, 2]


def test_pair_counts(spark, rows):
    stored = edges(spark, [(1, 2), (2, 3)])
    asked = edges(spark, [(1, 2), (1, 2), (9, 9)])
    assert rows(joins.pair_counts(asked, stored)) == [(1, 2, 1), (9, 9, 0)]


def test_foreign_keys_and_cascade(spark, rows):
    ps = posts(spark, [(1, 0), (2, 8), (3, 8), (4, None), (5, 9)])
    assert rows(quality.foreign_key_report([("p", ps, "user_id", users(spark, [0]), "user_id")])) == [("p", 2, 3)]
    assert sorted(r.post_id for r in quality.orphans(ps, "user_id", users(spark, [0]), "user_id").collect()) == [2, 3, 5]
    left = quality.cascade_delete(users(spark, [8, 2]), {
        "posts": (ps, ["user_id"]),
        "followers": (edges(spark, [(1, 2), (8, 1), (1, 3)]), ["follower_id", "following_id"])})
    assert sorted(r.post_id for r in left["posts"].collect()) == [1, 4, 5]
    assert rows(left["followers"]) == [(1, 3)]


def test_constraint_audit_finds_injected_faults(spark):
    df = spark.createDataFrame(
        [(1, "a", "PREPARED", 1), (1, None, "WRONG", 0), (2, "abcdef", None, -1), (None, "a", "ABORTED", 5)],
        "id long, name string, status string, n long")
    rules = quality.Constraints(not_null=["id", "name"], unique=[["id"], ["name", "n"]], positive=["n"],
                                allowed={"status": ["PREPARED", "COMMITTED", "ABORTED"]}, max_length={"name": 3})
    got = {r.rule: r.violations for r in quality.audit("t", df, rules).collect()}
    assert got == {"not_null(id)": 1, "not_null(name)": 1, "unique(id)": 1, "unique(name,n)": 0,
                   "positive(n)": 2, "allowed(status)": 1, "max_length(name)": 1}
    empty = {r.rule: r.violations for r in quality.audit("t", df.limit(0), rules).collect()}
    assert set(empty.values()) == {0}


def test_counter_drift(spark, rows):
    table = spark.createDataFrame([(1, 2), (2, 0), (3, 5), (4, None)], "post_id long, like_count long")
    got = quality.counter_drift(table, "post_id", "like_count", likes(spark, [(1, 1), (1, 2), (3, 1)]), "post_id")
    assert rows(got) == [(3, 5, 1, 4), (4, None, 0, None)]


def test_like_keeps_the_underscore_wildcard(spark):
    df = spark.createDataFrame([("run_on_1",), ("runXonX2",), ("run_off_1",)], "username string")
    got = filters.like_any(df, "username", [filters.benchmark_pattern("run", "on")]).collect()
    assert sorted(r.username for r in got) == ["runXonX2", "run_on_1"]


def test_band_and_status(spark):
    df = spark.createDataFrame([(5, '{"result":"OK"}'), (3, '{"s":{"result":"Committed"}}'), (1, "{}"), (None, None)],
                               "n long, doc string")
    got = df.select(filters.band(F.col("n"), [(4, "high"), (2, "mid")], "low"),
                    filters.status_text(F.col("doc"), ["$.result", "$.s.result"])).collect()
    assert [tuple(r) for r in got] == [("high", "ok"), ("mid", "committed"), ("low", "ok"), ("low", "ok")]


def test_lowest_key_rows(spark, rows):
    assert rows(filters.lowest_key_rows(users(spark, [4, 2, 9]), "user_id")) == [(2, "u2")]
    assert rows(filters.lowest_key_rows(users(spark, []), "user_id")) == []
