"""Helpers shared by the operators: written tables, a distributed rank, word pattern."""
from __future__ import annotations

import gc
import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from docnorm.session import delete_path, table_path

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def write_table(df: DataFrame, name: str, level: int = 3) -> DataFrame:
    """Write ``df`` as a compressed table in the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` does, but columnar and compressed, so that what
    follows survives lost executors without holding the rows twice.
    """
    spark = df.sparkSession
    path = table_path(spark, "docnorm-llm", f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", level).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.table_path = path
    return out


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more. Spark drops the shuffle files of the
    plans that made them once the driver has collected the plans, which this asks for."""
    for t in tables:
        delete_path(spark, t.table_path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package whatever folder the driver was started in.

    On a cluster the package is installed or shipped with ``--py-files``; there this adds a
    path that workers do not have and ignore.
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def n_words(text: Column) -> Column:
    """Number of words (null text: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Add the 1-based position of each row in the given order, without a global window.

    Rows are range-partitioned and written; each partition numbers its own rows, and the
    running sum over partition counts (a row per partition) gives the offset.
    """
    spark = df.sparkSession
    parts = write_table(df.repartitionByRange(shuffle_partitions(spark), *order)
                        .withColumn("_part", F.spark_partition_id()), "rank")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (parts.withColumn("_own", own).join(offsets, "_part")
            .withColumn(name, (F.col("_own") + F.col("_off")).cast("long")).drop("_part", "_own", "_off"))
