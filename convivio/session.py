"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE is what keeps one hot key from pinning a task: it splits skewed join partitions,
# also when that costs an extra exchange, and merges tiny shuffle partitions.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    # State of streams on the executors' disks, not in their heaps.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Without a count of the rows held, a write needs no look-up; a commit uploads its changes, not a snapshot.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Bytes of a shuffle that AQE merges into one task. Numbers are compressed there, and the hash maps and sort buffers of a task
# hold some forty times as much: about 700 MB for this size, and 3 GB for the 64 MB that are Spark's default.
MERGED_BYTES = 16 * 2**20
_MERGED, _FIRST = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# A map task aggregates what it reads; some ten million pairs of ids in 128 MiB of a file fill a hash map of 1.1 GB.
_SPLITS = "spark.sql.files.minPartitionNum"


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session; master and sizes come from spark-submit on a cluster."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {_MERGED: str(MERGED_BYTES), **SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession, folder: str | None = None) -> SparkSession:
    """Apply the runtime settings the operators rely on to a session made elsewhere."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    if folder:
        size_tasks(spark, folder)
        bound_tasks(spark, folder)
    return spark


def task_sizes(input_bytes: int) -> tuple[int, int]:
    """Shuffle partitions and bytes per read task for an input of this size.

    A query may shuffle about as many bytes as its largest table holds, so there is one shuffle
    partition per 256 MiB, and at most 100,000 of them. Read tasks grow to 1 GiB, because the
    driver tracks read tasks times shuffle partitions. At 100 TB both are near 100,000.
    """
    mib = 2**20
    return (min(100_000, -(-input_bytes // (256 * mib))),
            max(128 * mib, min(1024 * mib, input_bytes // 100_000)))


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


_FOLDER_BYTES: dict[str, int] = {}


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes under a folder, listed once per process."""
    if folder not in _FOLDER_BYTES:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        _FOLDER_BYTES[folder] = system.getContentSummary(path).getLength()
    return _FOLDER_BYTES[folder]


def size_tasks(spark: SparkSession, folder: str) -> None:
    """Raise, never lower, the session's task sizes to suit a folder; AQE merges small partitions."""
    partitions, read_bytes = task_sizes(folder_bytes(spark, folder))
    if partitions > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    if read_bytes > spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes():
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(read_bytes))


def bound_tasks(spark: SparkSession, folder: str) -> None:
    """Keep the memory of one task the same for folders of any size up to 160 GB; above, it is left to spills.

    AQE merges no more than `MERGED_BYTES` into one task, and shuffles are first cut into at least as many partitions as the
    folder holds such pieces, 10,000 at most. Tables are read in as many splits, 2,000 at most, so that the blocks of a shuffle
    do not get tiny: splits grow from 31 GiB on and have their 128 MiB again from 250 GiB on. A row group is never split. A
    smaller size and higher numbers of the session stay.
    """
    in_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if in_bytes(spark.conf.get(_MERGED)) > MERGED_BYTES:
        spark.conf.set(_MERGED, str(MERGED_BYTES))
    pieces = min(10_000, -(-folder_bytes(spark, folder) // MERGED_BYTES))
    if pieces > int(spark.conf.get(_FIRST, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(_FIRST, str(pieces))
    splits, usual = min(2_000, pieces), spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
    if splits > int(spark.conf.get(_SPLITS, None) or usual or spark.sparkContext.defaultParallelism):
        spark.conf.set(_SPLITS, str(splits))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir`. Only a local session may go without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="convivio-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A path no other call returns, in this application's part of the shared folder."""
    return f"{shared_dir(spark)}/convivio-{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder, which outlives lost executors.

    Against an RDD checkpoint this runs the plan once, is columnar, and later reads are pruned.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
