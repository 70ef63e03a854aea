"""Document sources and sinks.

A collection at rest is JSON lines (one document per line, splittable) or a table with a
JSON text / VARIANT column. Documents become one VARIANT column ``doc`` plus ``_seq``, the
dense 0-based arrival index. Unparsable lines (broken JSON, duplicate keys) are kept
aside as rejects instead of failing the load.
"""
from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

SEQ = "_seq"
DOC = "doc"


# Offset tables (one row per input split or file) are broadcast up to this many rows
# (~100 MB); beyond it they are joined like any table.
MAX_BROADCAST_SPLITS = 1_000_000


def estimated_splits(spark: SparkSession, path: str) -> int | None:
    """Upper bound of input splits of ``path`` (globs allowed) from file-system metadata
    only: files + total bytes / maxPartitionBytes. None when it cannot be told."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        matches = fs.globStatus(p) or []
        files = size = 0
        for st in matches:
            summary = fs.getContentSummary(st.getPath())
            files += int(summary.getFileCount())
            size += int(summary.getLength())
        split = _bytes(str(spark.conf.get("spark.sql.files.maxPartitionBytes", "134217728")))
        return files + size // max(split, 1) + 1
    except Exception:  # unknown: no broadcast hint, AQE decides from run-time sizes
        return None


def _bytes(text: str) -> int:
    """Spark byte-size text ('134217728', '128m', '1g', '64MB') -> bytes."""
    t = text.strip().lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}
    return int(t[:-1]) * units[t[-1]] if t and t[-1] in units else int(t)


def _offsets_side(offsets: DataFrame, splits: int | None) -> DataFrame:
    return F.broadcast(offsets) if splits is not None and splits <= MAX_BROADCAST_SPLITS else offsets


def with_dense_seq(df: DataFrame, order_cols: list[str], seq: str = SEQ, splits: int | None = None) -> DataFrame:
    """Dense 0-based index in ``order_cols`` order without a global sort.

    Rows are numbered inside each input split (``monotonically_increasing_id`` is
    consecutive there); the per-split counts (one row per split) get running offsets and
    are joined back — broadcast when ``splits`` (an upper bound of the number of splits,
    see ``estimated_splits``) is at most ``MAX_BROADCAST_SPLITS``, else a regular join.
    """
    base = df.withColumn("_mid", F.monotonically_increasing_id())
    per_split = base.groupBy(*order_cols).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = per_split.withColumn("_off", F.sum("_n").over(w) - F.col("_n")).drop("_n")
    out = base.join(_offsets_side(offsets, splits), on=order_cols, how="inner")
    return out.withColumn(seq, F.col("_off") + F.col("_mid") - F.col("_m0")).drop("_mid", "_m0", "_off", *order_cols)


FENCE = "_fence"


def parse_documents(df: DataFrame, text_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """JSON text column -> ``doc`` VARIANT (NULL when unparsable or duplicate keys).

    The projection carries a non-deterministic ``_fence`` column; filters that read it
    stay above the parse, so each line is parsed once (a pushed-down ``doc IS NOT NULL``
    would parse it a second time inside the filter)."""
    keep = keep or []
    return df.select(*keep, F.try_parse_json(F.col(text_col)).alias(DOC), F.col(text_col).alias("_raw"),
                     F.spark_partition_id().alias(FENCE))


def read_documents(spark: SparkSession, path: str, fmt: str = "jsonl", text_col: str = "json",
                   seq_col: str | None = None, with_rejects: bool = False):
    """A1: full scan of a collection in natural order, unfiltered.

    fmt='jsonl'   JSON lines files; ``_seq`` = dense index in (file, offset) order.
    fmt='parquet' a table with a JSON text column ``text_col`` (or a VARIANT column) and an
                  optional stored arrival column ``seq_col``.
    Returns ``docs`` (``_seq``, ``doc``) or ``(docs, rejects)`` with ``with_rejects``.
    """
    if fmt == "jsonl":
        # blank lines separate nothing: they are neither documents nor rejects, nor counted
        raw = spark.read.text(path).where(F.trim(F.col("value")) != "").select(
            "value", F.col("_metadata.file_path").alias("_fp"), F.col("_metadata.file_block_start").alias("_bs"))
        raw = with_dense_seq(raw, ["_fp", "_bs"], splits=estimated_splits(spark, path))
        parsed = parse_documents(raw, "value", [SEQ])
    elif fmt == "parquet":
        t = spark.read.parquet(path)
        if seq_col is None:
            # dense index in (file, row) order: per-file counts (one row per file) get
            # running offsets and are broadcast back
            t = t.select("*", F.col("_metadata.file_path").alias("_fp"), F.col("_metadata.row_index").alias("_ri"))
            files = t.groupBy("_fp").agg(F.count(F.lit(1)).alias("_n"))
            w = Window.orderBy("_fp").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            offs = files.withColumn("_off", F.sum("_n").over(w) - F.col("_n")).drop("_n")
            t = t.join(_offsets_side(offs, estimated_splits(spark, path)), "_fp").withColumn(
                SEQ, F.col("_off") + F.col("_ri")).drop("_fp", "_ri", "_off")
            seq_col = SEQ
        dtype = dict(t.dtypes)[text_col]
        if dtype == "variant":
            parsed = t.select(F.col(seq_col).cast("bigint").alias(SEQ), F.col(text_col).alias(DOC),
                              F.lit(None).cast("string").alias("_raw"), F.lit(0).alias(FENCE))
        else:
            parsed = parse_documents(t.withColumn(SEQ, F.col(seq_col).cast("bigint")), text_col, [SEQ])
    else:
        raise ValueError(fmt)
    docs = parsed.where(F.col(DOC).isNotNull() & (F.col(FENCE) >= 0)).select(SEQ, DOC)
    if not with_rejects:
        return docs
    rejects = parsed.where(F.col(DOC).isNull() & (F.col(FENCE) >= 0)).select(
        SEQ, F.col("_raw").alias("raw"), F.lit("unparsable_json").alias("reject_reason"))
    return docs, rejects


def load_sample(spark: SparkSession, path: str) -> DataFrame | None:
    """A3: a JSON **array** file (Extended JSON sample) -> (``_seq``, ``doc``); None if the
    file is missing or not a JSON array. A JSON array cannot be split, so each file is one
    row before the explode; samples are small by construction (A2)."""
    try:
        whole = spark.read.text(path, wholetext=True).select(
            F.col("_metadata.file_path").alias("_fp"), F.try_parse_json("value").alias("_v"))
    except Exception:  # missing path -> None, like the source
        return None
    items = whole.select("_fp", F.posexplode(F.try_variant_get("_v", "$", "array<variant>")).alias("_pos", DOC))
    w = Window.orderBy("_fp", "_pos")
    return items.select((F.row_number().over(w) - 1).cast("bigint").alias(SEQ), DOC)


def export_sample(docs: DataFrame, path: str, n: int = 200) -> int:
    """A2: first ``n`` documents (by ``_seq``) as one JSON array file; non-ASCII kept.

    Returns the number of documents written; an empty input writes nothing and warns.
    The ``limit`` is the feature (a bounded sample), planned as a top-k.
    """
    first = docs.orderBy(SEQ).limit(n).select(SEQ, F.to_json(F.col(DOC)).alias("j"))
    arr = first.agg(F.count(F.lit(1)).alias("n"),
                    F.concat(F.lit("["), F.array_join(F.transform(
                        F.array_sort(F.collect_list(F.struct(SEQ, "j"))), lambda x: x["j"]), ",\n"),
                        F.lit("]")).alias("value"))
    row = arr.select("n").first()
    count = row["n"] if row else 0
    if not count:
        warnings.warn("empty collection: no sample written")
        return 0
    arr.select("value").coalesce(1).write.mode("overwrite").text(path)
    return int(count)


def count_documents(docs: DataFrame) -> int:
    """A4: number of source documents (0 -> the caller stops after the refresh)."""
    return docs.count()


def write_table(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None,
                fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Bulk write of a target table (to a catalog table, or a path when given)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w.save(path)
    else:
        w.saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 1000,
               properties: dict | None = None) -> None:
    """A5 into a relational database through Spark's JDBC writer (paged batches)."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batchsize))
    df.write.jdbc(url=url, table=table, mode=mode, properties=props)


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """A profile DataFrame to files (JSON by default)."""
    df.write.mode("overwrite").format(fmt).save(path)
