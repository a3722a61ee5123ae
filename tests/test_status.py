"""Status folds as streams: late and repeated events, restarts, and plans without a sort."""

import os
import random

import pytest
from pyspark.sql import functions as F

from convivio.operators import maintenance as m
from convivio.sources import merges, tables
from convivio.streaming import status
from test_maintenance import at

LOG = "tx_id string, seq long, status string, at timestamp_ntz"


def log(count):
    rows = []
    for n in range(count):
        rows.append((f"tx{n}", 1, "PREPARED", at(n)))
        if n % 3:
            rows.append((f"tx{n}", 2, "COMMITTED" if n % 2 else "ABORTED", at(n + 5)))
    random.Random(7).shuffle(rows)
    return rows


def run(spark, base, start):
    events = status.read_events(spark, f"{base}/events", spark.createDataFrame([], LOG).schema)
    query = start(events, f"{base}/table", f"{base}/checkpoint", 8)
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def test_three_runs_out_of_order_and_replayed(spark, tmp_path, rows):
    base, events = str(tmp_path), log(40)
    parts = [events[30:], events[:20], events[10:40]]
    for n, part in enumerate(parts):
        tables.append(spark.createDataFrame(part, LOG).coalesce(1), f"{base}/events")
        assert run(spark, base, status.start_transactions) == len(part)
        want = m.fold_transactions(spark.createDataFrame(sorted(set(sum(parts[:n + 1], []))), LOG))
        got = merges.read_shards(spark, f"{base}/table", want.schema)
        assert rows(got) == rows(want)
    # A restart finds its place in the checkpoint and has nothing to do.
    assert run(spark, base, status.start_transactions) == 0


@pytest.mark.parametrize("known", [True, False])
def test_folds_of_known_texts_need_no_sort(spark, known):
    tx = spark.createDataFrame([("a", 1, "PREPARED", at(0)), ("a", 2, "ODD", at(1)), ("b", 1, None, at(2))], LOG)
    kept = {} if known else {"statuses": None}
    folded = m.fold_transactions(tx, **kept)
    assert {r.tx_id: r.status for r in folded.collect()} == {"a": None if known else "ODD", "b": None}
    assert ("SortAggregate" in folded._jdf.queryExecution().executedPlan().toString()) != known
    steps = spark.createDataFrame([("s", 1, "P", "STARTED", "CREATE_POST", '{"user_id": 4}', 9, at(0)),
                                   ("s", 2, "P", "COMPLETED", "DONE", "not json", 9, at(1))],
                                  "saga_id string, seq long, saga_type string, saga_status string, step_name string, "
                                  "payload string, post_id long, at timestamp_ntz")
    sagas = m.fold_sagas(steps, **(kept if known else kept | {"steps": None}))
    assert [tuple(r)[:6] for r in sagas.collect()] == [("s", "COMPLETED", "DONE", 9, 4, False)]
    assert ("SortAggregate" in sagas._jdf.queryExecution().executedPlan().toString()) != known


def test_saga_stream_matches_the_batch_fold(spark, tmp_path, rows):
    steps = [("STARTED", "CREATE_POST"), ("STARTED", "UPDATE_COUNTERS"), ("COMPENSATED", "ROLLBACK_DONE")]
    events = spark.createDataFrame(
        [(f"s{i}", n, "P", *steps[n], '{"user_id": 5}', i, at(n)) for i in range(30) for n in range(i % 3 + 1)],
        "saga_id string, seq long, saga_type string, saga_status string, step_name string, payload string, post_id long, at timestamp_ntz")
    base, want = str(tmp_path), m.fold_sagas(events)
    for part in (events.filter(F.col("seq") > 0), events.filter("seq = 0"), events):
        tables.append(part, f"{base}/events")
        stream = status.read_events(spark, f"{base}/events", events.schema, max_files=100)
        status.start_sagas(stream, f"{base}/table", f"{base}/checkpoint", 8).awaitTermination()
    assert rows(merges.read_shards(spark, f"{base}/table", want.schema)) == rows(want)


def test_state_is_written_without_lookups(spark, tmp_path):
    """The state store counts no rows, which costs a look-up for each write, and commits changes instead of snapshots."""
    base = str(tmp_path)
    tables.append(spark.createDataFrame(log(10), LOG), f"{base}/events")
    run(spark, base, status.start_transactions)
    found = [f for _, _, files in os.walk(f"{base}/checkpoint/state") for f in files]
    assert any(f.endswith(".changelog") for f in found) and not any(f.endswith(".zip") for f in found)
