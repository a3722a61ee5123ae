"""Reading and writing tables: scans, appends, layouts, text and JSON files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import shard_of
from ..schema import SHARDS
from ..session import path_exists


def scan(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a Parquet table; columns and filters are pushed into the scan by Catalyst."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def run_sql(spark: SparkSession, sql: str, args: dict | list | None = None, **frames: DataFrame) -> DataFrame:
    """Parametrised SQL over named DataFrames."""
    return spark.sql(sql, args=args, **frames)


def scan_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int,
              parts: int, **options: str) -> DataFrame:
    """Read a live database table as `parts` key ranges (needs the driver jar on the classpath)."""
    return spark.read.jdbc(url, table, column=key, lowerBound=low, upperBound=high,
                           numPartitions=parts, properties=options)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Add a batch of rows in one job and return the path written to."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)
    return path


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Add a batch of rows and return how many were written, without a second pass.

    They are counted in the tasks that write, each of which commits once, so retried tasks and lost shuffle files do
    not count twice.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("append").partitionBy(*partition_by).parquet(path)
    return seen.get["rows"]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Insert-select: cast to the table's types, add absent columns as null, fix the order."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def series(spark: SparkSession, count: int, name: str = "id") -> DataFrame:
    """The integers 1..count, made in parallel."""
    return spark.range(1, count + 1).withColumnRenamed("id", name)


def write_hash_layout(df: DataFrame, path: str, key: str, shards: int = SHARDS) -> str:
    """Place rows in `shard=<key mod shards>` folders.

    The rebalance gathers each shard's rows into full files; AQE splits a shard that is too big
    for one task, so neither a hot key nor a big shard ends up in a single writer.
    """
    placed = df.withColumn("shard", shard_of(F.col(key), shards))
    placed.hint("rebalance", "shard").write.mode("errorifexists").partitionBy("shard").parquet(path)
    return path


def write_month_layout(df: DataFrame, path: str, at: str = "created_at") -> str:
    """Place rows in `created_month=yyyyMM` folders; any month is accepted."""
    placed = df.withColumn("created_month", F.date_format(F.col(at), "yyyyMM"))
    (placed.hint("rebalance", "created_month")
        .write.mode("errorifexists").partitionBy("created_month").parquet(path))
    return path


def read_hash_layout_key(spark: SparkSession, path: str, key: str, value: int,
                         shards: int = SHARDS) -> DataFrame:
    """Rows of one key, with the shard predicate added so only its folder is listed."""
    return scan(spark, path).filter((F.col("shard") == value % shards) & (F.col(key) == value))


def write_lookup_table(df: DataFrame, path: str, column: str, distinct_rows: int, row_group_bytes: int = 32 * 2**20) -> str:
    """A table with a Bloom filter on one column in every row group, for lookups of single values such as names.

    A lookup by equality then skips the row groups whose filter rules the value out, in whatever order the rows lie.
    `distinct_rows` is the number of different values expected in a row group; the filter takes some ten bits for each.
    """
    (df.write.mode("errorifexists").option(f"parquet.bloom.filter.enabled#{column}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{column}", str(distinct_rows))
        .option("parquet.block.size", str(row_group_bytes)).parquet(path))
    return path


def write_feed_layout(df: DataFrame, path: str, files: int, user: str = "user_id", at: str = "created_at") -> str:
    """Rows ordered by user and newest first, in `files` folders that follow each other, with an index of their users.

    The moment is part of the order, so a user with very many rows is spread over several files, newest ones in the first.
    """
    ranged = df.repartitionByRange(files, F.col(user), F.col(at).desc()).sortWithinPartitions(F.col(user), F.col(at).desc())
    ranged.withColumn("part", F.spark_partition_id()).write.mode("errorifexists").partitionBy("part").parquet(f"{path}/rows")
    index = scan(df.sparkSession, f"{path}/rows").groupBy("part").agg(
        F.min(user).alias("low"), F.max(user).alias("high"), F.count(F.lit(1)).alias("rows"))
    index.coalesce(1).write.mode("errorifexists").parquet(f"{path}/index")
    return path


def read_feed_layout(spark: SparkSession, path: str, value: int, user: str = "user_id") -> DataFrame:
    """The rows of one user; the index names the few folders to list, no other file is opened."""
    held = scan(spark, f"{path}/index").filter(F.lit(value).between(F.col("low"), F.col("high"))).select("part").collect()
    parts = [r["part"] for r in held]
    return scan(spark, f"{path}/rows").filter(F.col("part").isin(parts) & (F.col(user) == value)).drop("part")


def read_since(spark: SparkSession, path: str, since: Column, at: str = "created_at") -> DataFrame:
    """Rows at or after `since` from a month layout; earlier months are pruned."""
    months = F.col("created_month").cast("string") >= F.date_format(since, "yyyyMM")
    return scan(spark, path).filter(months & (F.col(at) >= since))


def with_origin(df: DataFrame) -> DataFrame:
    """Add the file each row came from (call right after the read)."""
    return df.select("*", F.col("_metadata.file_path").alias("origin_path"),
                     F.col("_metadata.file_name").alias("origin_file"))


# All fields are quoted and quotes are doubled, so that line breaks, quotes, backslashes and blanks come back as they
# were. Null has a mark of its own, apart from empty text; a text that equals the mark would come back as null.
_CSV = {"header": "true", "escape": '"', "nullValue": "\\N", "lineSep": "\n",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with a header; an empty input gives a folder without rows."""
    df.write.mode("errorifexists").options(**_CSV, quoteAll="true").csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of `write_csv`. Texts may hold line breaks, so each file is read by one task."""
    return spark.read.schema(schema).options(**_CSV, multiLine="true").csv(path)


def write_json(df: DataFrame, path: str) -> str:
    """JSON Lines, one object per row, written by all tasks."""
    df.write.mode("errorifexists").json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_documents(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Whole-file JSON documents with their file names; a byte-order mark is accepted."""
    reader = spark.read.option("multiLine", True)
    docs = (reader if schema is None else reader.schema(schema)).json(path)
    return docs.select("*", F.col("_metadata.file_name").alias("file_name"))


def read_expected(spark: SparkSession, folder: str, files: Mapping[str, str]) -> DataFrame:
    """One row for each expected document: name, payload, available, broken.

    `files` gives the file of each name. A file that is not there, or does not hold JSON, has a null payload and is not available;
    the latter is marked as broken. An empty file counts as not there. A byte-order mark is accepted. The folder itself may be missing.
    """
    wanted = spark.createDataFrame(list(files.items()), "name string, file string")
    if not path_exists(spark, folder):
        return wanted.select("name", F.lit(None).cast("string").alias("payload"), F.lit(False).alias("available"),
                             F.lit(False).alias("broken"))
    listed = spark.read.format("binaryFile").load(folder)
    there = listed.select(F.element_at(F.split("path", "/"), -1).alias("file"),
                          F.try_validate_utf8(F.col("content").cast("string")).alias("text"))
    there = there.withColumn("text", F.regexp_replace("text", "^\ufeff", ""))
    whole = F.when(F.try_parse_json("text").isNotNull(), F.col("text"))
    found = there.select("file", whole.alias("payload"), F.lit(True).alias("_there"))
    return wanted.join(found, "file", "left").select(
        "name", "payload", F.col("payload").isNotNull().alias("available"),
        (F.coalesce("_there", F.lit(False)) & F.col("payload").isNull()).alias("broken"))
