"""Merges folder by folder against the full join, and what they read and write."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from convivio import schema
from convivio.operators import maintenance
from convivio.sources import merges

SHARDS = 64
MODEL = schema.POSTS_READ_MODEL


def model_rows(spark, ids, text, event):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return spark.range(ids).select(
        F.col("id").alias("post_id"), (F.col("id") % 7).alias("user_id"), F.concat(F.lit(text), "id").alias("content"),
        at.alias("created_at"), at.alias("indexed_at"), F.lit(event).cast("long").alias("first_event_id"),
        F.lit(event).cast("long").alias("last_event_id"))


def files(path):
    found = glob.glob(f"{path}/shard=*/*.parquet")
    return {f: os.stat(f).st_mtime_ns for f in found}


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "model")
    merges.write_shards(model_rows(spark, 20000, "old", 1), path, "post_id", SHARDS)
    return path


@pytest.fixture
def batch(spark):
    """A hundred keys of three shards, one of them new."""
    rows = model_rows(spark, 20000 + 3, "new", 9).filter("post_id % 64 in (2, 5, 34)")
    return rows.orderBy(F.desc("post_id")).limit(100)


def test_only_touched_folders_are_read_and_written(spark, stored, batch, rows):
    full = rows(maintenance.upsert_posts(merges.read_shards(spark, stored, MODEL), batch))
    before, read = files(stored), []

    def fold(current, part):
        read.extend(r[0] for r in current.select(F.input_file_name()).distinct().collect())
        merged = maintenance.upsert_posts(current, part)
        plan = current._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [shard" in plan and "IN (2,5,34)" in plan
        return merged

    result = merges.merge(stored, batch, "post_id", MODEL, fold, SHARDS)
    after, touched = files(stored), ("/shard=2/", "/shard=5/", "/shard=34/")
    assert result.shards == [2, 5, 34]
    assert read and all(any(t in f for t in touched) for f in read)
    same = {f for f in before if after.get(f) == before[f]}
    assert same == {f for f in before if not any(t in f for t in touched)}
    assert all(any(t in f for t in touched) for f in set(after) - same)
    now = rows(merges.read_shards(spark, stored, MODEL))
    assert now == full
    assert result.rows == merges.read_shards(spark, stored, MODEL, result.shards).count()


def test_a_batch_id_is_merged_once(spark, stored, batch, rows):
    first = merges.merge_posts(stored, batch, SHARDS, 7)
    kept = files(stored)
    assert merges.merge_posts(stored, batch.withColumn("last_event_id", F.lit(99).cast("long")), SHARDS, 7) == ([], 0)
    assert files(stored) == kept and first.rows > 0


def test_a_lost_driver_leaves_a_stage_to_publish(spark, stored, batch, rows):
    """The folders of the batch are gone, as when the swap was cut off; the stage alone brings them back."""
    merges.merge_posts(stored, batch, SHARDS, 1)
    want = rows(merges.read_shards(spark, stored, MODEL))
    os.remove(f"{stored}/_merges/batch-1.done")
    for file in glob.glob(f"{stored}/shard=5/*"):
        os.rename(file, f"{stored}/_merges/{os.path.basename(file)}")
    # What was staged counts, not what the repeated call brings.
    other = batch.withColumn("post_id", F.col("post_id") + 1)
    again = merges.merge_posts(stored, other, SHARDS, 1)
    assert again.shards == [2, 5, 34] and rows(merges.read_shards(spark, stored, MODEL)) == want


def test_a_table_that_is_not_there_yet_and_null_keys(spark, tmp_path, batch, rows):
    path = str(tmp_path / "new")
    with_null = batch.unionByName(batch.limit(1).withColumn("post_id", F.lit(None).cast("long")))
    assert merges.merge_posts(path, with_null, SHARDS).rows == 100
    assert rows(merges.read_shards(spark, path, MODEL)) == rows(batch)
    assert merges.merge_posts(path, batch.limit(0), SHARDS, 3) == ([], 0)


def test_stored_rows_without_an_event_are_updated(spark):
    old = model_rows(spark, 2, "old", 1).withColumn("last_event_id", F.lit(None).cast("long"))
    new = model_rows(spark, 1, "new", 5)
    got = {r.post_id: (r.content, r.last_event_id) for r in maintenance.upsert_posts(old, new).collect()}
    assert got == {0: ("new0", 5), 1: ("old1", None)}


def test_counters_with_floor_and_hot_key(spark, tmp_path):
    path, table = str(tmp_path / "users"), spark.range(50).select(F.col("id").alias("user_id"), F.lit(3).cast("long").alias("n"))
    merges.write_shards(table, path, "user_id", 8)
    deltas = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 9).otherwise(77).cast("long").alias("user_id"), F.lit(-1).cast("long").alias("n"))
    for _ in range(2):
        merges.merge_counters(path, deltas, "user_id", table.schema, ["n"], 8, "a", floor=0)
    got = dict(tuple(r) for r in merges.read_shards(spark, path, table.schema).collect())
    assert got == {i: 0 if i == 9 else 3 for i in range(50)}


def test_text_keys(spark, tmp_path, rows):
    path = str(tmp_path / "status")
    one = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "tx_id string, seq long")
    merges.replace_rows(path, one, "tx_id", 16, 0)
    result = merges.replace_rows(path, spark.createDataFrame([("b", 2), ("d", 2)], one.schema), "tx_id", 16, 1)
    assert len(result.shards) <= 2
    assert rows(merges.read_shards(spark, path, one.schema)) == [("a", 1), ("b", 2), ("c", 1), ("d", 2)]
