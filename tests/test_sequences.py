"""Ids that go on over batches."""

import pytest
from pyspark.sql import functions as F

from convivio.operators import maintenance as m
from convivio.sources import sequences
from convivio.streaming import outbox
from test_maintenance import at


def batch(spark, low, high):
    return spark.range(low, high).select(F.col("id").alias("k"), F.concat(F.lit("t"), "id").alias("v")).repartition(5)


def test_batches_follow_each_other_and_repeats_keep_their_ids(spark, tmp_path, rows):
    path = str(tmp_path / "ids")
    one = sequences.number_batch(batch(spark, 50, 90), ["k"], "n", path, "one", start=10)
    two = sequences.number_batch(batch(spark, 0, 30), ["k"], "n", path, "two", start=10)
    none = sequences.number_batch(batch(spark, 5, 5), ["k"], "n", path, "none", start=10)
    again = sequences.number_batch(batch(spark, 50, 90), ["k"], "n", path, "one", start=10)
    three = sequences.number_batch(batch(spark, 7, 8), ["k"], "n", path, 3, start=10)
    assert rows(one) == [(k, f"t{k}", k - 40) for k in range(50, 90)] == rows(again)
    assert rows(two.select("k", "n")) == sorted(((k, 50 + k) for k in range(30)), key=repr)
    assert none.count() == 0 and three.first().n == 80
    assert sequences.last_id(spark, path) == 80 and sequences.ledger(spark, path).count() == 4
    with pytest.raises(ValueError, match="had 40 rows"):
        sequences.number_batch(batch(spark, 50, 91), ["k"], "n", path, "one")


def test_numbers_go_on_after_a_stored_table(spark, rows):
    stored = spark.createDataFrame([(7, "a"), (3, "b")], "n long, v string")
    new = spark.createDataFrame([("y",), ("x",)], "v string")
    assert rows(sequences.number_after(stored, new, ["v"], "n").select("n", "v")) == [(8, "x"), (9, "y")]
    assert rows(sequences.number_after(stored.limit(0), new, ["v"], "n").select("n")) == [(1,), (2,)]


@pytest.mark.parametrize("keep", [False, True])
def test_likes_keep_their_ids_and_new_ones_go_on(spark, rows, keep):
    posts = spark.createDataFrame([(1, 10), (2, 0)], "post_id long, like_count long")
    users = spark.createDataFrame([(7,), (8,)], "user_id long")
    likes = spark.createDataFrame([(41, 1, 7, at(0))], "like_id long, post_id long, user_id long, created_at timestamp_ntz")
    asked = spark.createDataFrame([(9, 1, 8, at(2)), (3, 2, 8, at(4)), (5, 2, 7, at(1)), (6, 2, 7, at(5)), (7, 1, 7, at(1))],
                                  "request_id long, post_id long, user_id long, at timestamp_ntz")
    out = m.like_batch(asked, posts, likes, users, keep)
    want = [(41, 1, 7, at(0)), (42, 2, 8, at(4)), (43, 2, 7, at(1)), (44, 1, 8, at(2))]
    assert rows(out.likes) == want and rows(out.added) == want[1:] and rows(out.posts) == [(1, 11), (2, 2)]
    again = m.like_batch(asked, out.posts, out.likes, users, keep)
    assert rows(again.likes) == want and again.added.count() == 0 and rows(again.posts) == rows(out.posts)


def test_a_post_with_several_events(spark, tmp_path, rows):
    path = str(tmp_path / "events")
    made = spark.createDataFrame([(5, 1, "first", at(0)), (6, 2, "other", at(1))],
                                 "post_id long, user_id long, content string, created_at timestamp_ntz")
    edits = made.filter("post_id = 5").withColumn("content", F.lit("second"))
    created = m.create_posts(sequences.number_batch(made, ["created_at", "post_id"], "event_id", path, 0), "event_id")
    edited = m.outbox_events(sequences.number_batch(edits, ["post_id"], "event_id", path, 1), "POST_EDITED", "event_id")
    events = created.outbox.unionByName(edited)
    assert rows(events.select("event_id", "aggregate_id")) == [(1, 5), (2, 6), (3, 5)]
    assert rows(outbox.project_batch(events).select("post_id", "content", "first_event_id", "last_event_id")) == [
        (5, "second", 1, 3), (6, "other", 2, 2)]
    assert rows(created.posts) == rows(made)
