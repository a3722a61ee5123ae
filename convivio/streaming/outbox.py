"""Projection of the event outbox into the posts read model with Structured Streaming.

Each micro-batch is folded to one row per post and written to its own `batch_id=N` folder; the
read model is the fold of those rows. Writing costs what the batch holds, not what the model
holds, and a batch that is retried or replayed overwrites its own folder with the same rows.
The stream's checkpoint takes the place of the outbox's processed flag.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.filters import pending
from ..operators.maintenance import fold_events, merge_folds, upsert_posts
from ..operators.ordering import oldest_pending
from ..schema import EVENT_OUTBOX, POSTS_READ_MODEL, SHARDS
from ..sources import merges

PAYLOAD = "post_id long, user_id long, content string, created_at string"


class Decoded(NamedTuple):
    events: DataFrame
    rejects: DataFrame


def parse(outbox: DataFrame) -> DataFrame:
    """Outbox rows with their payload fields in `_p` columns and whether all of them are there.

    The generator keeps the JSON from being parsed once per use of a field.
    """
    fields = F.inline_outer(F.array(F.from_json("payload", PAYLOAD))).alias(
        "_p_post_id", "_p_user_id", "_p_content", "_p_created_at")
    parsed = outbox.select("*", fields).withColumn("_p_at", F.col("_p_created_at").try_cast("timestamp_ntz"))
    needed = ("_p_post_id", "_p_user_id", "_p_content", "_p_at")
    return parsed.withColumn("_whole", reduce(and_, [F.col(c).isNotNull() for c in needed]))


def split(parsed: DataFrame) -> Decoded:
    events = parsed.filter("_whole").select(
        "event_id", F.col("_p_post_id").alias("post_id"), F.col("_p_user_id").alias("user_id"),
        F.col("_p_content").alias("content"), F.col("_p_at").alias("created_at"),
        F.col("created_at").alias("indexed_at"))
    kept = [c for c in parsed.columns if c != "_whole" and not c.startswith("_p_")]
    return Decoded(events, parsed.filter("NOT _whole").select(*kept))


def decode(outbox: DataFrame) -> Decoded:
    """Split the outbox into events with their payload fields and rows that cannot be decoded.

    A payload is rejected when it is null, is not valid JSON, or lacks a field the read model needs.
    indexed_at is the outbox row's own time, so a replay gives the same value.
    """
    return split(parse(outbox))


def project_batch(outbox: DataFrame) -> DataFrame:
    """Fold one batch of outbox rows to read-model rows."""
    return fold_events(decode(outbox).events)


class Projection(NamedTuple):
    model: DataFrame
    outbox: DataFrame


def project_once(outbox: DataFrame, model: DataFrame, batch_size: int | None = None) -> Projection:
    """The projection as one batch over tables: pending events into the model, then flagged.

    `batch_size` takes the oldest pending events only. Rows that cannot be decoded stay pending.
    Without it the flags follow from each row alone and need no join.
    """
    batch = pending(outbox) if batch_size is None else oldest_pending(outbox, batch_size)
    events = decode(batch).events
    if batch_size is None:
        flagged = parse(outbox).withColumn("processed", F.col("processed") | F.col("_whole"))
    else:
        done = events.select("event_id", F.lit(True).alias("_done"))
        flagged = outbox.join(done, "event_id", "left").withColumn(
            "processed", F.col("processed") | F.coalesce("_done", F.lit(False)))
    return Projection(upsert_posts(model, fold_events(events)), flagged.select(*outbox.columns))


def read_outbox(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """The outbox folder as a stream of Parquet files."""
    return (spark.readStream.schema(EVENT_OUTBOX).option("maxFilesPerTrigger", max_files).parquet(path))


def start_projection(outbox: DataFrame, model_path: str, checkpoint: str,
                     trigger: dict | None = None) -> StreamingQuery:
    """Run the projection of pending events; by default over everything available, then stop."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        parsed = parse(pending(batch)).persist()
        try:
            events, bad = split(parsed)
            fold_events(events).write.mode("overwrite").parquet(f"{model_path}/folds/batch_id={batch_id}")
            bad.write.mode("overwrite").parquet(f"{model_path}/rejects/batch_id={batch_id}")
            counts = parsed.agg(F.count_if("_whole").alias("events"), F.count_if(~F.col("_whole")).alias("rejects"))
            counts.write.mode("overwrite").parquet(f"{model_path}/counts/batch_id={batch_id}")
        finally:
            parsed.unpersist()

    return (outbox.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def start_merged_projection(outbox: DataFrame, model_path: str, checkpoint: str, shards: int = SHARDS,
                            trigger: dict | None = None) -> StreamingQuery:
    """The projection into a read model in hash layout: each batch rewrites the folders of its posts only.

    Reading the model then needs no fold. Use it while a batch touches few of the folders, and `start_projection`
    when it touches most. A batch that is retried is merged once.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        parsed = parse(pending(batch)).persist()
        try:
            events, bad = split(parsed)
            merges.merge_posts(f"{model_path}/posts", fold_events(events), shards, batch_id)
            bad.write.mode("overwrite").parquet(f"{model_path}/rejects/batch_id={batch_id}")
        finally:
            parsed.unpersist()

    return (outbox.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def merged_model(spark: SparkSession, model_path: str) -> DataFrame:
    """The read model of `start_merged_projection`: a plain scan."""
    return merges.read_shards(spark, f"{model_path}/posts", POSTS_READ_MODEL)


def batch_counts(spark: SparkSession, model_path: str) -> DataFrame:
    """Events and rejects of every batch so far, one row each."""
    return spark.read.schema("events long, rejects long, batch_id long").parquet(f"{model_path}/counts")


def projected_rows(spark: SparkSession, model_path: str) -> int:
    """Events projected so far, over all batches."""
    return batch_counts(spark, model_path).agg(F.sum("events")).first()[0] or 0


class Snapshot(NamedTuple):
    snapshot: str
    after_batch: int


def compact(spark: SparkSession, model_path: str, previous: Snapshot | None = None) -> Snapshot:
    """Write the read model as of the last counted batch, from the previous snapshot on.

    Pass the result on to `read_model`, which then reads later batches only. Folded batches stay, so a compaction that
    is lost or repeated harms nothing.
    """
    last = batch_counts(spark, model_path).agg(F.max("batch_id")).first()[0]
    if last is None or (previous and previous.after_batch >= last):
        return previous or Snapshot(None, -1)
    path = f"{model_path}/snapshots/upto={last}"
    read_model(spark, model_path, *(previous or ()), until_batch=last).write.mode("overwrite").parquet(path)
    return Snapshot(path, last)


def read_model(spark: SparkSession, model_path: str, snapshot: str | None = None,
               after_batch: int = -1, until_batch: int | None = None) -> DataFrame:
    """The current read model: the folded batches, over an older snapshot if there is one.

    `after_batch` prunes the batches a snapshot already holds. Reading them again is harmless.
    `until_batch` leaves later batches out.
    """
    rows = spark.read.schema(POSTS_READ_MODEL).parquet(f"{model_path}/folds").filter(F.col("batch_id") > after_batch)
    if until_batch is not None:
        rows = rows.filter(F.col("batch_id") <= until_batch)
    folds = merge_folds(rows.drop("batch_id"))
    if snapshot is None:
        return folds
    return upsert_posts(spark.read.schema(POSTS_READ_MODEL).parquet(snapshot), folds)


def rejects(spark: SparkSession, model_path: str) -> DataFrame:
    """All rejected outbox rows so far."""
    return spark.read.schema(EVENT_OUTBOX).parquet(f"{model_path}/rejects").drop("batch_id")
