"""Merging small batches into a stored table, folder by folder (copy on write).

The table is in hash layout: rows with one key are in one `shard=N` folder. A batch names its shards; only their
folders are read, only they are written, and all others keep their files. That pays while a batch touches few
folders, so the number of shards should be large against the keys of a batch; a batch that touches all of them costs a rewrite.

A merge with a batch id is done once. The new folders are first written whole to a stage inside the table's own
`_merges` folder, which readers skip, and are then swapped in by a dynamic partition overwrite. A driver that
is lost in between leaves the stage: the same call swaps it in again without reading the table. A call for a finished batch does
nothing, so counters are safe too. Merges of one table must follow each other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import shard_of
from ..operators.maintenance import apply_counters, upsert_posts
from ..schema import POSTS_READ_MODEL, SHARDS
from ..session import durable, path_exists, scratch_path

Fold = Callable[[DataFrame, DataFrame], DataFrame]


class Merged(NamedTuple):
    """The shards a merge touched, and the rows it wrote; both empty when the batch was done before."""

    shards: list[int]
    rows: int


def shard_of_key(schema: T.StructType, key: str, shards: int) -> Column:
    """The shard of a key: the remainder of whole numbers, as in the hash layout, and of a hash of anything else."""
    if isinstance(schema[key].dataType, T.IntegralType):
        return shard_of(F.col(key), shards)
    return F.pmod(F.xxhash64(key), F.lit(shards).cast("long"))


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place, True).close()


def write_shards(df: DataFrame, path: str, key: str, shards: int = SHARDS) -> None:
    """A new table in hash layout, for keys of any type."""
    placed = df.withColumn("shard", shard_of_key(df.schema, key, shards))
    placed.hint("rebalance", "shard").write.mode("errorifexists").partitionBy("shard").parquet(path)


def touched_shards(keys: DataFrame, key: str, shards: int) -> list[int]:
    """The shards that a batch's keys are in: at most `shards` numbers reach the driver."""
    found = keys.filter(F.col(key).isNotNull()).select(shard_of_key(keys.schema, key, shards)).distinct().collect()
    return sorted(r[0] for r in found)


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table that Catalyst knows to be empty, so that joins with it are planned away."""
    return spark.range(0).filter(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_shards(spark: SparkSession, path: str, schema: T.StructType, touched: Sequence[int] | None = None) -> DataFrame:
    """The table without its shard column, or the rows of some shards; a table not yet written is empty."""
    if not path_exists(spark, path):
        return no_rows(spark, schema)
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("shard", T.LongType())])).parquet(path)
    if touched is not None:
        rows = rows.filter(F.col("shard").isin(list(touched)))
    return rows.drop("shard")


def publish(spark: SparkSession, stage: str, path: str, touched: Sequence[int] = ()) -> int:
    """Swap the staged folders in and return the rows written; harmless when repeated.

    Touched shards that have no rows left get an empty file.
    """
    seen, rows = Observation(), spark.read.parquet(stage)
    left = {r[0] for r in rows.select("shard").distinct().collect()}
    for shard in set(touched) - left:
        rows.drop("shard").limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path}/shard={shard}")
    staged = rows.hint("rebalance", "shard")
    # Counted where it is written: after the exchange, so that a lost map output is not counted twice.
    (staged.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path))
    return seen.get["rows"]


def merge(path: str, batch: DataFrame, key: str, schema: T.StructType, fold: Fold, shards: int = SHARDS,
          batch_id: int | str | None = None, stored: bool = False) -> Merged:
    """Replace the touched shards by fold(their rows, the batch).

    `fold` must keep every row's key. Batch rows with a null key are left out. The batch is read more than once, so it is
    stored first, unless it is `stored` already.
    """
    spark = batch.sparkSession
    done = f"{path}/_merges/batch-{batch_id}.done"
    if batch_id is not None and path_exists(spark, done):
        return Merged([], 0)
    stage = scratch_path(spark, "merge") if batch_id is None else f"{path}/_merges/batch-{batch_id}"
    if not path_exists(spark, f"{stage}/_SUCCESS"):
        batch = batch.filter(F.col(key).isNotNull())
        batch = batch if stored else durable(batch)
        touched = touched_shards(batch, key, shards)
        # Stored with the stage, so that a repeated call swaps in what was staged, whatever batch it is given.
        listed = spark.createDataFrame([(shard,) for shard in touched], "shard long")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{stage}-touched")
        merged = fold(read_shards(spark, path, schema, touched), batch)
        placed = merged.withColumn("shard", shard_of_key(merged.schema, key, shards))
        placed.write.mode("overwrite").parquet(stage)
    else:
        touched = sorted(r["shard"] for r in spark.read.schema("shard long").parquet(f"{stage}-touched").collect())
    rows = publish(spark, stage, path, touched) if touched else 0
    if batch_id is not None:
        mark(spark, done)
    return Merged(touched, rows)


def merge_posts(path: str, folded: DataFrame, shards: int = SHARDS, batch_id: int | str | None = None) -> Merged:
    """Upsert folded events into a stored read model."""
    return merge(path, folded, "post_id", POSTS_READ_MODEL, upsert_posts, shards, batch_id)


def merge_counters(path: str, deltas: DataFrame, key: str, schema: T.StructType, counters: Sequence[str],
                   shards: int = SHARDS, batch_id: int | str | None = None, floor: int | None = None) -> Merged:
    """Add deltas to the counters of a stored table. Give a batch id, or a repeated batch counts twice.

    Deltas are summed per key before they are staged, and keys that the table does not have are left out.
    """
    summed = deltas.groupBy(key).agg(*[F.sum(c).alias(c) for c in counters])
    return merge(path, summed, key, schema, lambda current, batch: apply_counters(current, batch, key, counters, floor),
                 shards, batch_id)


def replace_rows(path: str, batch: DataFrame, key: str, shards: int = SHARDS, batch_id: int | str | None = None) -> Merged:
    """Put each batch row in the place of the stored row with its key; the batch has one row for each key."""
    def fold(current: DataFrame, batch: DataFrame) -> DataFrame:
        return current.join(batch.select(key), key, "left_anti").select(*batch.columns).unionByName(batch)

    return merge(path, batch, key, batch.schema, fold, shards, batch_id)
