"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""
from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "docnorm") -> SparkSession:
    """Session used by tests and bench. On a cluster, build the session yourself."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    A local session (driver and executors in one process) gets a folder under the system
    temp dir when none is set; on a cluster an unset folder is an error, since executors
    do not share the driver's disk.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="docnorm-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]):
    """Session settings for a while; afterwards they are as they were."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


# Documents at rest: stored whole, not shredded into a column a path, since every query reads whole
# documents, and buffers and footers of hundreds of columns cost more than they save. Keys and texts
# repeat from document to document, so files are packed by zstd. Shuffle files go with the job.
STORE_CONF = {"spark.sql.variant.inferShreddingSchema": "false", "spark.sql.parquet.compression.codec": "zstd",
              "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def keep_documents(docs, path: str):
    """Write ``docs`` to ``path`` in the shared checkpoint folder and read them from there: a
    checkpoint, packed, that its owner deletes (``delete_path``)."""
    spark = docs.sparkSession
    with session_conf(spark, STORE_CONF):
        docs.write.mode("overwrite").parquet(path)
    return spark.read.schema(docs.schema).parquet(path)


def keyed_side(df):
    """The side of a join that holds keys and grows with the data: joined by a sorted shuffle.

    Left to itself, Spark plans a broadcast through the driver whenever it estimates a side as
    small, and it estimates from the size of compressed files, without what a generator adds."""
    return df.hint("merge")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table of the shared checkpoint folder; other paths are refused."""
    if not path.startswith(ensure_checkpoint_dir(spark).rstrip("/") + "/"):
        raise ValueError(f"not an intermediate table: {path}")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def table_path(spark: SparkSession, *parts: str) -> str:
    """Path for an intermediate table inside the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)


def recommended_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Settings for a cluster run over ``input_bytes`` of documents on ``total_cores`` cores.

    Shuffle partitions are sized from the data (~256 MB each, never fewer than 2x cores);
    AQE coalesces small ones and splits skewed ones at run time; file splits stay at
    128 MB so a scan task's VARIANT batch fits comfortably in executor memory.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
