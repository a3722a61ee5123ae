"""Grouped and global aggregates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import round_even, size_text


def daily_posts(posts: DataFrame) -> DataFrame:
    """Posts and mean likes per day, newest first; one small row per day leaves each map task."""
    return (posts.groupBy(F.to_date("created_at").alias("creation_date"))
            .agg(F.count(F.lit(1)).alias("num_posts"), F.avg("like_count").alias("avg_likes"))
            .orderBy(F.desc("creation_date")))


def distinct_counts(df: DataFrame, group: str, **columns: str) -> DataFrame:
    """Several COUNT(DISTINCT) in one group (expanded by Catalyst, spread over the values)."""
    return df.groupBy(group).agg(*[F.countDistinct(c).alias(n) for n, c in columns.items()])


def distinct_bitmaps(df: DataFrame, group: str, *columns: str) -> DataFrame:
    """The distinct whole numbers of several columns as bitmaps: group, name of the column, bucket, bitmap.

    A bitmap takes 4 KB for 32,768 neighbouring numbers, so this suits dense ids. Bitmaps of batches can be stored and
    united later (`unite_bitmaps`), which counts of distinct values cannot.
    """
    entries = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("long").alias("value")) for c in columns])
    each = df.select(group, F.inline(F.filter(entries, lambda e: e["value"].isNotNull())))
    return each.groupBy(group, "name", F.bitmap_bucket_number("value").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("value")).alias("bitmap"))


def unite_bitmaps(bitmaps: DataFrame, group: str) -> DataFrame:
    """The bitmaps of several batches as one."""
    return bitmaps.groupBy(group, "name", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def bitmap_counts(bitmaps: DataFrame, group: str, **columns: str) -> DataFrame:
    """Distinct values per group from united bitmaps; `columns` names the result for each column."""
    sizes = F.bitmap_count("bitmap")
    return bitmaps.groupBy(group).agg(*[
        F.coalesce(F.sum(F.when(F.col("name") == column, sizes)), F.lit(0).cast("long")).alias(name)
        for name, column in columns.items()])


def row_span(df: DataFrame, at: str = "created_at") -> DataFrame:
    """Row count with first and last moment; one row even for an empty input."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.min(at).alias("first_write"),
                  F.max(at).alias("last_write"))


def partition_distribution(placed: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows per (table, partition) and each table's skew, the largest partition over the mean.

    `placed` maps a table name to its DataFrame and partition expression.
    """
    cells = None
    for name, (df, place) in placed.items():
        part = df.groupBy(F.expr(place).cast("string").alias("partition_name")).agg(
            F.count(F.lit(1)).alias("row_count"))
        part = part.select(F.lit(name).alias("table_name"), "partition_name", "row_count")
        cells = part if cells is None else cells.unionByName(part)
    # One row per partition of a table is left here, a handful per window.
    table = Window.partitionBy("table_name")
    return cells.withColumn("skew", F.max("row_count").over(table) / F.avg("row_count").over(table))


def _listed_files(spark: SparkSession, path: str) -> DataFrame:
    """Path and length of a table's Parquet files, from the file listing (no file is opened)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", True).load(path).select("path", "length"))


def layout_distribution(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Rows, files, bytes and readable size per partition folder of a written layout."""
    folder = F.concat(F.lit(f"{column}="), F.col(column).cast("string"))
    rows = spark.read.parquet(path).groupBy(folder.alias("partition_name")).agg(
        F.count(F.lit(1)).alias("row_count"))
    named = F.regexp_extract("path", f"/({column}=[^/]+)/", 1)
    sizes = _listed_files(spark, path).groupBy(named.alias("partition_name")).agg(
        F.count(F.lit(1)).alias("num_files"), F.sum("length").alias("size_bytes"))
    return rows.join(sizes, "partition_name").withColumn("size", size_text(F.col("size_bytes")))


def file_sizes(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Data files and megabytes per table."""
    listed = None
    for name, path in paths.items():
        files = _listed_files(spark, path).select(F.lit(name).alias("table_name"), F.col("length").alias("bytes"))
        listed = files if listed is None else listed.unionByName(files)
    return (listed.groupBy("table_name")
            .agg(F.count(F.lit(1)).alias("num_ranges"),
                 (F.sum("bytes") / 1024.0 / 1024.0).alias("size_mb"))
            .orderBy(F.desc("num_ranges"), "table_name"))


def group_megabytes(df: DataFrame, group: str, size: Column) -> DataFrame:
    """Rows and megabytes per group, from a size in bytes per row; a null size adds nothing."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("num_rows"),
                                 (F.sum(size) / 1024.0 / 1024.0).alias("size_mb"))


def spread(df: DataFrame, group: str, value: str, digits: int = 2) -> DataFrame:
    """Mean, minimum and maximum, rounded half to even."""
    return df.groupBy(group).agg(*[
        round_even(fn(value), digits).alias(name)
        for fn, name in ((F.avg, "average"), (F.min, "minimum"), (F.max, "maximum"))])


def group_sizes(df: DataFrame, *group: str) -> DataFrame:
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("row_count"))
