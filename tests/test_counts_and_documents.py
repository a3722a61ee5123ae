"""Counted writes, expected documents, bitmaps of distinct values, and foreign keys of shared tables."""

import pytest
from pyspark.sql import functions as F

from convivio.operators import aggregates, experiments, joins, quality
from convivio.sources import tables


def test_appends_report_their_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    hot = spark.range(5000).repartition(7).groupBy((F.col("id") % 13).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    assert tables.append_rows(spark.range(1000).withColumn("part", F.col("id") % 3), path, ["part"]) == 1000
    assert tables.append_rows(hot.select(F.col("k").alias("id"), F.lit(9).cast("long").alias("part")), path, ["part"]) == 13
    assert tables.append_rows(spark.range(0).withColumn("part", F.col("id")), path, ["part"]) == 0
    assert tables.scan(spark, path).count() == 1013


def test_documents_that_are_missing_broken_or_marked(spark, tmp_path):
    texts = {"a.json": '{"result": "COMMITTED"}', "b.json": '{"result": "COMM', "c.json": '﻿{"mode": "dry-run"}', "d.json": ""}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    (tmp_path / "e.json").write_bytes(b'{"x": "\xff\xfe"}')
    files = {"exp4": "a.json", "exp1": "b.json", "exp5": "c.json", "exp2": "d.json", "exp6": "e.json", "exp3": "none.json"}
    found = tables.read_expected(spark, str(tmp_path), files)
    got = {r.name: (r.available, r.broken) for r in found.collect()}
    assert got == {"exp4": (True, False), "exp1": (False, True), "exp5": (True, False), "exp2": (False, False),
                   "exp6": (False, True), "exp3": (False, False)}
    states = {r.experiment: (r.available, r.status) for r in experiments.summarise(found).collect()}
    assert states["exp4"] == (True, "committed") and states["exp5"] == (True, "dry-run")
    assert {states[n] for n in ("exp1", "exp2", "exp3", "exp6")} == {(False, "pending")}
    nowhere = tables.read_expected(spark, str(tmp_path / "nowhere"), files)
    assert {(r.payload, r.available, r.broken) for r in nowhere.collect()} == {(None, False, False)}


def test_bitmaps_of_batches_unite_to_distinct_counts(spark, rows):
    n = F.col("id")
    df = spark.range(3000).select((n % 4).alias("g"), F.when(n % 5 > 0, n * n % 70001 - 900).alias("a"), (n % 3).alias("b"))
    df2 = df.withColumn("id", F.monotonically_increasing_id())
    halves = [aggregates.distinct_bitmaps(df2.filter(F.col("id") % 2 == h), "g", "a", "b") for h in (0, 1, 1)]
    united = aggregates.unite_bitmaps(halves[0].union(halves[1]).union(halves[2]), "g")
    assert rows(aggregates.bitmap_counts(united, "g", a="a", b="b")) == rows(aggregates.distinct_counts(df, "g", a="a", b="b"))


def test_foreign_keys_read_each_table_once(spark, rows):
    users = spark.createDataFrame([(1,), (2,)], "user_id long")
    names = spark.createDataFrame([("x",)], "name string")
    edges = spark.createDataFrame([(1, 9, "x"), (8, 9, "y"), (2, None, None), (9, 1, "z")], "a long, b long, name string")
    posts = spark.createDataFrame([(7, 1), (8, 7), (9, 7)], "post_id long, user_id long")
    links = [("e.a", edges, "a", users, "user_id"), ("p.user", posts, "user_id", users, "user_id"),
             ("e.b", edges, "b", users, "user_id"), ("e.name", edges, "name", names, "name"),
             ("none", posts.limit(0), "user_id", users, "user_id")]
    report = quality.foreign_key_report(links)
    assert rows(report) == sorted([("e.a", 2, 2), ("p.user", 1, 2), ("e.b", 1, 2), ("e.name", 2, 2), ("none", 0, 0)], key=repr)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftAnti") == 2


@pytest.mark.parametrize("few", [False, True])
def test_few_users_count_like_all(spark, rows, few):
    posts = spark.createDataFrame([(1, 5), (2, 5), (3, 6), (None, 5)], "post_id long, user_id long")
    likes = spark.createDataFrame([(1, 1, 9), (2, 1, 8), (3, 3, 9), (None, 2, 9), (4, 77, 9)], "like_id long, post_id long, user_id long")
    edges = spark.createDataFrame([(9, 5), (None, 5), (9, 6)], "follower_id long, following_id long")
    users = spark.createDataFrame([(5, "a"), (7, "c")], "user_id long, username string")
    assert rows(joins.social_stats(users, posts, likes, edges, few=few)) == [(5, "a", 2, 2, 1), (7, "c", 0, 0, 0)]
