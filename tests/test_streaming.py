import json
import os

import pytest
from pyspark.sql import functions as F

from convivio import schema
from convivio.streaming import outbox
from test_maintenance import EVENTS, at, event, upsert_one_by_one


def rows_of(events):
    return [(n, "POST_CREATED", post, json.dumps({
        "post_id": post, "user_id": user, "content": text, "created_at": created.isoformat(sep=" ")}), False, created)
        for n, post, user, text, created, _ in events]


def write(spark, rows, path):
    spark.createDataFrame(rows, schema.EVENT_OUTBOX).coalesce(1).write.mode("append").parquet(path)


def project(spark, base, max_files=1):
    stream = outbox.read_outbox(spark, f"{base}/events", max_files)
    query = outbox.start_projection(stream, f"{base}/model", f"{base}/checkpoint")
    query.awaitTermination()
    return sorted(tuple(r) for r in outbox.read_model(spark, f"{base}/model").collect())


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


def test_rounds_equal_one_batch_and_replays_change_nothing(spark, base):
    events = [event(n, n % 5, n % 3, f"text {n}") for n in range(60)]
    write(spark, rows_of(events[:20]), f"{base}/events")
    write(spark, rows_of(events[20:30]), f"{base}/events")
    assert project(spark, base) == upsert_one_by_one(events[:30])
    write(spark, rows_of(events[25:]), f"{base}/events")
    write(spark, rows_of(events[:5]), f"{base}/events")
    assert project(spark, base) == upsert_one_by_one(events)
    folds = [d for d in os.listdir(f"{base}/model/folds") if d.startswith("batch_id=")]
    assert len(folds) == 4
    assert project(spark, base) == upsert_one_by_one(events)


def test_late_old_event_does_not_overwrite(spark, base):
    late, newer = event(3, 1, 8, "old"), event(9, 1, 9, "new")
    write(spark, rows_of([newer]), f"{base}/events")
    project(spark, base)
    write(spark, rows_of([late]), f"{base}/events")
    (row,) = project(spark, base)
    assert row[1:3] == (8, "new")


def test_snapshot_and_later_batches(spark, base):
    events = [event(n, n % 4, n, f"t{n}") for n in range(24)]
    write(spark, rows_of(events[:12]), f"{base}/events")
    project(spark, base)
    snapshot = f"{base}/snapshot"
    outbox.read_model(spark, f"{base}/model").write.parquet(snapshot)
    write(spark, rows_of(events[12:]), f"{base}/events")
    want = project(spark, base)
    for after in (-1, 0):
        got = outbox.read_model(spark, f"{base}/model", snapshot, after)
        assert sorted(tuple(r) for r in got.collect()) == want == upsert_one_by_one(events)


def test_bad_payloads_go_to_rejects(spark, base):
    good = rows_of([event(1, 1, 1, "fine")])
    bad = [(n, "POST_CREATED", n, text, False, at(n)) for n, text in enumerate([
        None, "", "{", "[]", '{"post_id": "x"}', '{"post_id": 1, "user_id": 2, "content": "c"}',
        '{"post_id": 1, "user_id": 2, "content": "c", "created_at": "yesterday"}'], start=10)]
    write(spark, good + bad, f"{base}/events")
    assert [r[0] for r in project(spark, base)] == [1]
    rejected = outbox.rejects(spark, f"{base}/model")
    assert sorted(r.event_id for r in rejected.collect()) == list(range(10, 17))
    assert rejected.columns == schema.EVENT_OUTBOX.names


def test_batches_of_pending_events_reach_the_same_model(spark):
    events = [event(n, n % 7, n % 3, f"t{n}") for n in range(50)]
    bad = (50, "POST_CREATED", 1, "{", False, at(50))
    table = spark.createDataFrame(rows_of(events) + [bad], schema.EVENT_OUTBOX)
    model = spark.createDataFrame([], schema.POSTS_READ_MODEL)
    taken = []
    for _ in range(3):
        out = outbox.project_once(table, model, batch_size=20)
        table = spark.createDataFrame(out.outbox.collect(), schema.EVENT_OUTBOX)
        model = spark.createDataFrame(out.model.collect(), schema.POSTS_READ_MODEL)
        taken.append(table.filter("processed").count())
    assert taken == [20, 40, 50]
    assert sorted(tuple(r) for r in model.collect()) == upsert_one_by_one(events)
    assert [r.event_id for r in table.filter("NOT processed").collect()] == [50]
    whole = outbox.project_once(spark.createDataFrame(rows_of(events), schema.EVENT_OUTBOX),
                                spark.createDataFrame([], schema.POSTS_READ_MODEL))
    assert sorted(tuple(r) for r in whole.model.collect()) == upsert_one_by_one(events)


def test_decode_of_an_empty_outbox(spark):
    out = outbox.decode(spark.createDataFrame([], schema.EVENT_OUTBOX))
    assert out.events.count() == out.rejects.count() == 0


def test_iso_times_are_read(spark):
    payload = json.dumps({"post_id": 1, "user_id": 2, "content": "ñ \"q\"", "created_at": "2026-04-13T02:57:02.746186"})
    df = spark.createDataFrame([(1, "POST_CREATED", 1, payload, False, at(0))], schema.EVENT_OUTBOX)
    row = outbox.decode(df).events.first()
    assert row.content == "ñ \"q\"" and row.created_at.microsecond == 746186


def test_visible_rows_equal_distinct_keys(spark, base):
    events = [event(n, n // 2, 1, "x") for n in range(100)]
    for half in (events[:50], events[50:]):
        write(spark, rows_of(half), f"{base}/events")
    query = outbox.start_projection(outbox.read_outbox(spark, f"{base}/events", 1), f"{base}/model", f"{base}/checkpoint")
    query.awaitTermination()
    assert outbox.projected_rows(spark, f"{base}/model") == 100
    assert outbox.read_model(spark, f"{base}/model").count() == 50
    assert spark.createDataFrame(events, EVENTS).select(F.countDistinct("post_id")).first()[0] == 50


def test_processed_events_are_skipped_and_all_batches_counted(spark, base):
    events = [event(n, n % 3, 1, f"t{n}") for n in range(6)]
    done = [(*row[:4], True, row[5]) for row in rows_of([event(99, 7, 1, "old")])]
    for row in [*rows_of(events), *done, (50, "POST_CREATED", 1, "{", False, at(50))]:
        write(spark, [row], f"{base}/events")
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 2)
    try:
        assert project(spark, base) == upsert_one_by_one(events)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    counts = outbox.batch_counts(spark, f"{base}/model").agg(F.count("*"), F.sum("events"), F.sum("rejects")).first()
    assert tuple(counts) == (8, 6, 1) and outbox.projected_rows(spark, f"{base}/model") == 6


def test_compaction_over_rounds(spark, base):
    events, snapshot = [event(n, n % 4, n, f"t{n}") for n in range(24)], None
    for low in range(0, 24, 8):
        write(spark, rows_of(events[low:low + 8]), f"{base}/events")
        project(spark, base)
        if low < 16:
            snapshot = outbox.compact(spark, f"{base}/model", snapshot)
    assert snapshot.after_batch == 1
    got = outbox.read_model(spark, f"{base}/model", *snapshot)
    assert sorted(tuple(r) for r in got.collect()) == upsert_one_by_one(events)
    last = outbox.compact(spark, f"{base}/model", snapshot)
    assert outbox.compact(spark, f"{base}/model", last) == last
    assert sorted(tuple(r) for r in spark.read.parquet(last.snapshot).collect()) == upsert_one_by_one(events)
