import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from convivio.operators import maintenance as m

T0 = dt.datetime(2026, 1, 1)


def at(n):
    return T0 + dt.timedelta(seconds=n)


def requests(spark, pairs):
    data = [(n, a, b, at(n)) for n, (a, b) in enumerate(pairs)]
    return spark.createDataFrame(data, "request_id long, follower_id long, following_id long, at timestamp_ntz")


def edge_table(spark, pairs):
    return spark.createDataFrame([(a, b, T0) for a, b in pairs],
                                 "follower_id long, following_id long, created_at timestamp_ntz")


def user_table(spark, ids):
    return spark.createDataFrame([(i, f"u{i}", 0, 0) for i in ids],
                                 "user_id long, username string, follower_count long, following_count long")


def follow_one_by_one(pairs, known, stored):
    """The transaction, request by request."""
    edges, status = set(stored), []
    followers, following = dict.fromkeys(known, 0), dict.fromkeys(known, 0)
    for a, b in pairs:
        if a in known and b in known and (a, b) not in edges:
            edges.add((a, b))
            followers[b] += 1
            following[a] += 1
            status.append("COMMITTED")
        else:
            status.append("ABORTED")
    return edges, status, {u: (followers[u], following[u]) for u in known}


@pytest.mark.parametrize("keep", [False, True])
def test_follow_batch_equals_single_transactions(spark, keep):
    rng = random.Random(2)
    pairs = [(rng.randrange(12), 3 if rng.random() < 0.4 else rng.randrange(12)) for _ in range(300)]
    pairs += [(1, 1), (1, 1), (99, 1), (1, 99)]
    known, stored = list(range(10)), [(0, 3), (4, 4), (5, 6)]
    out = m.follow_batch(requests(spark, pairs), user_table(spark, known), edge_table(spark, stored), keep=keep)
    edges, status, counters = follow_one_by_one(pairs, known, stored)
    got = [(r.follower_id, r.following_id) for r in out.edges.collect()]
    assert sorted(got) == sorted(edges)
    assert {r.user_id: (r.follower_count, r.following_count) for r in out.users.collect()} == counters
    log = sorted(((r.created_at, r.status) for r in out.log.collect()))
    assert [s for _, s in log] == status
    assert out.log.select("tx_id").distinct().count() == len(pairs)


def test_rejected_batch_changes_nothing(spark):
    """A new pair with an unknown user, a stored pair: no effect but log rows."""
    users, edges = user_table(spark, [1, 2]), edge_table(spark, [(1, 2)])
    batch = requests(spark, [(2, 77), (1, 2), (88, 1)])
    out = m.follow_batch(batch, users, edges)
    assert sorted(map(tuple, out.edges.collect())) == sorted(map(tuple, edges.collect()))
    assert sorted(map(tuple, out.users.collect())) == sorted(map(tuple, users.collect()))
    assert {r.status for r in out.log.collect()} == {"ABORTED"}
    row = m.rejected_batch_check(batch, users, edges).first()
    assert (row.requests, row.committed, row.count_before, row.count_after, row.rolled_back) == (3, 0, 1, 1, True)


def test_simulated_error_rolls_back_and_lets_a_later_request_win(spark):
    users, edges = user_table(spark, [1, 2]), edge_table(spark, [])
    batch = requests(spark, [(2, 1), (2, 1), (1, 2)]).withColumn("simulate_error", F.col("request_id") != 1)
    out = m.follow_batch(batch, users, edges)
    assert [(r.follower_id, r.following_id, r.created_at) for r in out.added.collect()] == [(2, 1, at(1))]
    assert sorted(tuple(r)[2:] for r in out.users.collect()) == [(0, 1), (1, 0)]
    assert sorted(r.status for r in out.log.collect()) == ["ABORTED", "ABORTED", "COMMITTED"]


def test_hot_account_in_requests(spark):
    """One followed account holds a third of the requests."""
    pairs = [(n % 400, 5 if n % 3 == 0 else n % 371) for n in range(3000)]
    known = list(range(300))
    out = m.follow_batch(requests(spark, pairs), user_table(spark, known), edge_table(spark, [(0, 5)]))
    edges, status, counters = follow_one_by_one(pairs, known, [(0, 5)])
    assert sorted((r.follower_id, r.following_id) for r in out.edges.collect()) == sorted(edges)
    assert {r.user_id: (r.follower_count, r.following_count) for r in out.users.collect()} == counters
    assert out.log.filter("status = 'COMMITTED'").count() == status.count("COMMITTED")


def test_follow_batch_with_a_reused_request_id(spark):
    batch = spark.createDataFrame([(1, 1, 2, at(1)), (1, 2, 3, at(2)), (2, 1, 2, at(3))],
                                  "request_id long, follower_id long, following_id long, at timestamp_ntz")
    out = m.follow_batch(batch, user_table(spark, [1, 2, 3]), edge_table(spark, [(3, 3)]))
    assert sorted(r.status for r in out.log.collect()) == ["ABORTED", "COMMITTED", "COMMITTED"]
    assert sorted((r.follower_id, r.following_id) for r in out.added.collect()) == [(1, 2), (2, 3)]


def test_follow_batch_with_no_requests(spark):
    out = m.follow_batch(requests(spark, []), user_table(spark, [1]), edge_table(spark, [(1, 1)]))
    assert (out.edges.count(), out.users.count(), out.log.count()) == (1, 1, 0)


def test_insert_ignore_is_idempotent(spark, rows):
    target = edge_table(spark, [(1, 2)])
    new = spark.createDataFrame([(1, 2, at(5)), (3, 4, at(9)), (3, 4, at(7))],
                                "follower_id long, following_id long, created_at timestamp_ntz")
    pair, order = ["follower_id", "following_id"], [F.asc("created_at")]
    once = m.insert_ignore(target, new, pair, order)
    assert rows(once) == rows(edge_table(spark, [(1, 2)]).union(new.filter(F.col("created_at") == F.lit(at(7)))))
    assert rows(m.insert_ignore(once, new, pair, order)) == rows(once)


EVENTS = "event_id long, post_id long, user_id long, content string, created_at timestamp_ntz, indexed_at timestamp_ntz"
MODEL = ("post_id long, user_id long, content string, created_at timestamp_ntz, indexed_at timestamp_ntz, "
         "first_event_id long, last_event_id long")


def event(n, post, user, text):
    return (n, post, user, text, at(n), at(n))


def upsert_one_by_one(events):
    model = {}
    for n, post, user, text, created, indexed in sorted(set(events)):
        first = model.get(post)
        model[post] = ((user, text, created, indexed, n, n) if first is None
                       else (first[0], text, first[2], indexed, first[4], n))
    return sorted((p, *v) for p, v in model.items())


def test_upsert_keeps_first_values_and_ignores_replays(spark, rows):
    rng = random.Random(4)
    events = [event(n, rng.randrange(6), rng.randrange(3), f"text {n}") for n in range(40)]
    want = upsert_one_by_one(events)
    empty = spark.createDataFrame([], MODEL)

    def run(*batches):
        model = empty
        for batch in batches:
            model = m.upsert_posts(model, m.fold_events(spark.createDataFrame(batch, EVENTS)))
        return sorted(tuple(r) for r in model.collect())

    assert run(events) == want
    assert run(events[:17], events[17:]) == want
    assert run(events, events[:10], events) == want
    shuffled = events * 2
    rng.shuffle(shuffled)
    assert run(shuffled) == want


def test_folding_folds_is_the_same(spark, rows):
    events = [event(n, n % 4, n % 3, f"t{n}") for n in range(30)]
    parts = [m.fold_events(spark.createDataFrame(events[i::3], EVENTS)) for i in range(3)]
    merged = m.merge_folds(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[0]))
    assert rows(merged) == sorted(upsert_one_by_one(events), key=repr)


def test_counters(spark, rows):
    table = spark.createDataFrame([(1, "a", 0), (2, "b", 5), (3, "c", 2)], "user_id long, name string, post_count long")
    removed = spark.createDataFrame([(1,), (2,), (2,), (9,), (3,), (3,), (3,)], "user_id long")
    assert rows(m.floor_decrement(table, "user_id", "post_count", removed)) == [(1, "a", 0), (2, "b", 3), (3, "c", 0)]
    deltas = spark.createDataFrame([(1, 2), (1, 3), (3, -1)], "user_id long, post_count long")
    assert rows(m.apply_counters(table, deltas, "user_id", ["post_count"])) == [(1, "a", 5), (2, "b", 5), (3, "c", 1)]


@pytest.mark.parametrize("keep", [False, True])
def test_like_batch_counts_new_likes_only(spark, rows, keep):
    posts = spark.createDataFrame([(1, 10), (2, 0)], "post_id long, like_count long")
    users = spark.createDataFrame([(7,), (8,)], "user_id long")
    likes = spark.createDataFrame([(1, 7, T0)], "post_id long, user_id long, created_at timestamp_ntz")
    asked = spark.createDataFrame([(0, 1, 7, at(1)), (1, 1, 8, at(2)), (2, 1, 8, at(3)), (3, 2, 8, at(4)),
                                   (4, 2, 99, at(5))],
                                  "request_id long, post_id long, user_id long, at timestamp_ntz")
    out = m.like_batch(asked, posts, likes, users, keep=keep)
    assert rows(out.posts) == [(1, 11), (2, 1)]
    assert rows(out.likes) == sorted([(1, 7, T0), (1, 8, at(2)), (2, 8, at(4))], key=repr)
    again = m.like_batch(asked, out.posts, out.likes, users)
    assert rows(again.posts) == rows(out.posts)


def test_transaction_fold(spark):
    log = [("a", 1, "PREPARED", at(0)), ("a", 2, "COMMITTED", at(3)), ("b", 1, "PREPARED", at(1)),
           ("c", 2, "ABORTED", at(9)), ("c", 1, "PREPARED", at(8))]
    df = spark.createDataFrame(log, "tx_id string, seq long, status string, at timestamp_ntz")
    got = {r.tx_id: tuple(r)[1:] for r in m.fold_transactions(df).collect()}
    assert got == {"a": ("COMMITTED", at(0), at(3), 3000.0), "b": ("PREPARED", at(1), None, None),
                   "c": ("ABORTED", at(8), at(9), 1000.0)}


STEPS = [("STARTED", "CREATE_POST"), ("STARTED", "UPDATE_COUNTERS"), ("STARTED", "SEND_NOTIFICATION")]
DONE, UNDONE = ("COMPLETED", "DONE"), ("COMPENSATED", "ROLLBACK_DONE")


def test_sagas_end_anywhere(spark, rows):
    paths = {"s1": STEPS[:1], "s2": STEPS[:2], "s3": STEPS, "s4": STEPS + [DONE], "s5": STEPS + [UNDONE],
             "s6": STEPS[:1] + [UNDONE]}
    log = [(s, n, "PUBLISH_POST", status, step, '{"user_id": 5}', 100 + int(s[1]), at(n))
           for s, path in paths.items() for n, (status, step) in enumerate(path)]
    random.Random(1).shuffle(log)
    events = spark.createDataFrame(log, "saga_id string, seq long, saga_type string, saga_status string, "
                                        "step_name string, payload string, post_id long, at timestamp_ntz")
    sagas = m.fold_sagas(events)
    got = {r.saga_id: (r.saga_status, r.step_name, r.counted, r.user_id) for r in sagas.collect()}
    assert got == {s: (*p[-1], STEPS[1] in p, 5) for s, p in paths.items()}
    posts = spark.createDataFrame([(100 + n, 5) for n in range(1, 7)], "post_id long, user_id long")
    users = spark.createDataFrame([(5, 3), (6, 0)], "user_id long, post_count long")
    out = m.apply_sagas(sagas, posts, users)
    assert rows(out.posts) == [(101, 5), (102, 5), (103, 5), (104, 5)]
    assert rows(out.users) == [(5, 2), (6, 0)]


def test_delete_by_key(spark, rows):
    table = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    gone = spark.createDataFrame([(2,), (2,), (None,), (7,)], "k long")
    assert rows(m.delete_by_key(table, gone, "k")) == [(1, "a"), (None, "c")]
