"""Status of transactions and sagas, kept up to date as their events arrive.

A streaming aggregation holds the fold of every key in a state store, which is checkpointed; a restart goes on from
there. After each micro-batch the rows of the keys that changed replace theirs in a stored table in hash layout, folder by
folder, so the table is read by a plain scan. The folds depend neither on the order of events nor on repeats.

State is one row of numbers for each key. With the RocksDB provider, which `build_session` sets, it lies on the executors' disks
and its changes go to the checkpoint; it is split by key over as many tasks as the first run had shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.maintenance import fold_sagas, fold_transactions
from ..schema import SHARDS
from ..sources import merges


def read_events(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 1000) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def start_fold(events: DataFrame, fold: Callable[[DataFrame], DataFrame], key: str, path: str, checkpoint: str,
               shards: int = SHARDS, trigger: dict | None = None) -> StreamingQuery:
    """Keep `path` equal to fold(all events so far); by default over everything available, then stop."""

    def apply(changed: DataFrame, batch_id: int) -> None:
        merges.replace_rows(path, changed, key, shards, batch_id)

    return (fold(events).writeStream.outputMode("update").foreachBatch(apply)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def start_transactions(events: DataFrame, path: str, checkpoint: str, shards: int = SHARDS) -> StreamingQuery:
    return start_fold(events, fold_transactions, "tx_id", path, checkpoint, shards)


def start_sagas(events: DataFrame, path: str, checkpoint: str, shards: int = SHARDS) -> StreamingQuery:
    return start_fold(events, fold_sagas, "saga_id", path, checkpoint, shards)
