"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this library assumes; callers may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce shuffle partitions to the advisory size, not to the most tasks
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # the older 96-bit form has no statistics, so a time filter could skip no row group
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # delete checkpoint files once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "kpiloom",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local-mode
    session without that setting (tests, laptops) gets a fresh temporary
    folder; a cluster session without it is an error, because a folder on
    one machine does not survive the loss of that machine.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the context and its checkpoint folder
        if not conf:
            raise RuntimeError("set spark.checkpoint.dir on the Spark Connect server") from None
        return conf
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = conf or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")
        conf = tempfile.mkdtemp(prefix="kpiloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def reliable_checkpoint(df):
    """Cut lineage with a reliable (shared-folder) checkpoint, never a local one."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, compression: str | None = None):
    """``df`` written as Parquet in the shared checkpoint folder and read back, until the application ends.

    Cuts the lineage: a lost executor re-reads files.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/kpiloom-step-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    fs, where = hadoop_path(spark, path)
    fs.deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a path in any storage Spark reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def input_files(spark: SparkSession, paths) -> list[tuple[str, int, int]]:
    """(path, bytes, time) of every file under the paths, from the storage itself."""
    out = []
    for p in paths:
        fs, where = hadoop_path(spark, p)
        if not fs.exists(where):
            continue
        if fs.getFileStatus(where).isFile():
            s = fs.getFileStatus(where)
            out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
            continue
        files = fs.listFiles(where, True)
        while files.hasNext():
            s = files.next()
            out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return out


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the input files, in whatever storage they are."""
    return sum(n for _, n, _ in input_files(spark, paths))


def size_session(spark: SparkSession, paths, partition_bytes: int = 128 << 20) -> None:
    """Apply ``sizing`` for the given input to a running session."""
    for k, v in sizing(input_bytes(spark, paths), spark.sparkContext.defaultParallelism, partition_bytes).items():
        spark.conf.set(k, v)


def sizing(total_input_bytes: int, cores: int, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Shuffle and scan settings sized to the input.

    About ``partition_bytes`` of input per shuffle partition (AQE then
    coalesces small ones and splits skewed ones), never fewer than two per
    core; scan splits of at most ``partition_bytes`` but small enough that
    every core gets work.  At 100 TB and 128 MB this gives about 800,000
    initial shuffle partitions (AQE coalesces by size).
    """
    n = max(2 * cores, -(-total_input_bytes // partition_bytes))
    split = max(16 << 20, min(partition_bytes, total_input_bytes // max(1, 2 * cores)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
    }
