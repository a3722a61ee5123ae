import random

import pytest
from pyspark.sql import functions as F

from convivio.operators import ordering, ranks, windows


def by_rule(values, errors):
    """The rank rule on a plain list."""
    n = len(values)
    if not n:
        return (0, errors, errors) + (None,) * 7
    v = sorted(values)
    mean = sum(v) / n
    return (n, n + errors, errors, v[0], v[-1], mean, v[n // 2], v[min(n - 1, int(n * 0.95))],
            v[min(n - 1, int(n * 0.99))], (sum((x - mean) ** 2 for x in v) / n) ** 0.5)


def check(spark, groups):
    """`groups` maps a name to (values, number of errors)."""
    data = [(g, float(x), True) for g, (vs, _) in groups.items() for x in vs]
    data += [(g, 1.0, False) for g, (_, errors) in groups.items() for _ in range(errors)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "`group` string, latency_ms double, ok boolean")
    got = {r[0]: tuple(r)[1:] for r in ranks.sample_stats(df).collect()}
    assert set(got) == set(groups)
    for g, (vs, errors) in groups.items():
        want = by_rule([float(x) for x in vs], errors)
        assert all(a == b or a == pytest.approx(b, rel=1e-12) for a, b in zip(got[g], want)), g


def test_sizes_and_ties(spark):
    rng = random.Random(3)
    groups = {f"n{n}": ([rng.random() * 100 for _ in range(n)], n % 3) for n in (1, 2, 3, 19, 20, 99, 100, 137)}
    groups["none"] = ([], 4)
    groups["same"] = ([7.5] * 41, 0)
    groups["ties"] = ([float(i % 4) for i in range(200)], 1)
    groups["0..99"] = (range(100), 0)
    check(spark, groups)


def test_twenty_samples_have_equal_tails(spark):
    df = spark.createDataFrame([("a", float(i), True) for i in range(20)], "`group` string, latency_ms double, ok boolean")
    row = ranks.sample_stats(df).first()
    assert row.p95 == row.p99 == row.max == 19.0
    assert row.median == 10.0


def test_one_group_with_most_rows_spans_many_partitions(spark):
    rng = random.Random(5)
    check(spark, {"hot": ([rng.gauss(0, 1) for _ in range(5000)], 10), "b": (range(50), 0),
                  "hot value": ([3.0] * 2500 + [float(i) for i in range(2500)], 0)})


def test_empty_samples(spark):
    df = spark.createDataFrame([], "`group` string, latency_ms double, ok boolean")
    assert ranks.sample_stats(df).collect() == []


def test_samples_without_a_group_are_kept(spark):
    df = spark.createDataFrame([("a", 1.0, True), ("a", 3.0, True), (None, 5.0, True)],
                               "`group` string, latency_ms double, ok boolean")
    got = {r[0]: (r["count"], r["mean"], r["p99"]) for r in ranks.sample_stats(df).collect()}
    assert got == {"a": (2, 2.0, 3.0), None: (1, 5.0, 5.0)}


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_row_numbers_are_dense_under_any_partitioning(spark, parts):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k")).repartition(parts)
    got = [tuple(r) for r in ranks.number_rows(df, ["k"], "n").orderBy("n").collect()]
    keys = sorted(i * 7919 % 1009 for i in range(1000))
    assert got == list(zip(keys, range(1, 1001)))


def test_keep_latest_breaks_ties(spark, rows):
    df = spark.createDataFrame([(1, 2, 10, 1), (1, 2, 10, 5), (1, 2, 9, 9), (3, 3, 1, 1)],
                               "a long, b long, created_at long, id long")
    got = windows.keep_latest(df, ["a", "b"], tie_break=[F.desc("id")])
    assert rows(got) == [(1, 2, 10, 5), (3, 3, 1, 1)]
    assert rows(windows.latest_moment(df, ["a", "b"])) == [(1, 2, 10), (3, 3, 1)]


def test_feeds(spark):
    data = [(p, p % 3 if p < 60 else 0, p // 2) for p in range(100)]
    df = spark.createDataFrame(data, "post_id long, user_id long, created_at long")
    got = {}
    for r in ordering.all_feeds(df, 20).collect():
        got.setdefault(r.user_id, set()).add(r.post_id)
    for u in range(3):
        mine = sorted(((-t, p) for p, owner, t in data if owner == u))[:20]
        assert got[u] == {p for _, p in mine}
        assert [r.post_id for r in ordering.user_feed(df, u).collect()] == [p for _, p in mine]


def test_group_limit_runs_before_the_shuffle(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("k"))
    plan = windows.top_per_key(df, ["k"], [F.desc("id")], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
