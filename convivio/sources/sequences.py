"""Dense ids that go on over batches, as a database's serial columns do.

A ledger, a small Parquet table, has the first id and the size of every batch; the next batch begins after the highest
id given out. A batch that is repeated, because its job failed later on, gets the same range again, and as its rows
are numbered in the order of a key, every row gets the same id. Batches of one ledger must follow each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranks import number_rows
from ..session import path_exists

_LEDGER = "first long, count long, batch_id string"


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """first, count and batch_id of every batch so far."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(path)


def last_id(spark: SparkSession, path: str, start: int = 1) -> int:
    """The highest id given out, start - 1 if there is none."""
    return ledger(spark, path).agg(F.max(F.col("first") + F.col("count") - 1)).first()[0] or start - 1


def allocate(spark: SparkSession, path: str, batch_id: int | str, count: int, start: int = 1) -> int:
    """The first of `count` ids for a batch; the same one for a batch that had its ids before."""
    given = ledger(spark, path).filter(F.col("batch_id") == str(batch_id)).first()
    if given is not None:
        if given["count"] != count:
            raise ValueError(f"batch {batch_id} had {given['count']} rows before and has {count} now")
        return given["first"]
    first = last_id(spark, path, start) + 1
    row = spark.createDataFrame([(first, count)], "first long, count long")
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return first


def number_batch(df: DataFrame, order: list[str], name: str, path: str, batch_id: int | str, start: int = 1) -> DataFrame:
    """Number a batch's rows in the order of a key, after all earlier batches of the ledger."""
    return number_rows(df, order, name, lambda total: allocate(df.sparkSession, path, batch_id, total, start))


def number_after(stored: DataFrame, df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number rows after the highest `name` of a stored table, from 1 if it is empty.

    This is safe in a repeated batch where the rows to number are those that the table does not have yet.
    """
    highest: Column = F.max(name)
    return number_rows(df, order, name, lambda _: (stored.agg(highest).first()[0] or 0) + 1)
