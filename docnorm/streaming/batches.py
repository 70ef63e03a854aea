"""Incremental loads as Structured Streaming micro-batches.

The source tool walks a collection in batches of documents and commits each batch.
Here new JSON-lines files of a collection arrive in a folder; every micro-batch is
parsed and merged into the target tables with the collection's key policies
(``refresh=False``), through ``foreachBatch``. A batch marker written after the merge
makes a replayed epoch (after a failure) a no-op, so the merge is applied once.
"""
from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans import load as L
from ..session import ensure_checkpoint_dir
from ..sources.documents import SEQ, parse_documents, with_dense_seq

EPOCH_STRIDE = 10 ** 12  # fixed value: room for document indexes inside one micro-batch


def _docs_of_batch(batch: DataFrame, epoch_id: int) -> tuple[DataFrame, DataFrame]:
    """Documents of a micro-batch and the lines that are none."""
    seq = with_dense_seq(batch, ["_fp", "_bs"])
    seq = seq.withColumn(SEQ, F.col(SEQ) + F.lit(epoch_id) * F.lit(EPOCH_STRIDE))
    parsed = parse_documents(seq, "value", [SEQ])
    docs = parsed.where(F.col("doc").isNotNull() & (F.col("_fence") >= 0)).select(SEQ, "doc")
    return docs, parsed.where(F.col("doc").isNull() & (F.col("_fence") >= 0)).select(
        SEQ, F.col("_raw").alias("raw"), F.lit("unparsable_json").alias("reject_reason"))


def stream_collection(spark: SparkSession, source_dir: str, collection: str, store: L.Store,
                      checkpoint: str | None = None, max_files_per_trigger: int = 100,
                      run_ts: Column | None = None, available_now: bool = True, check_parents: bool = True):
    """Start (and with ``available_now`` run to completion) an incremental load of the
    JSON-lines files under ``source_dir`` into ``store``. Returns the StreamingQuery."""
    checkpoint = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "docnorm-streams", collection)
    # markers are plain folders of shared storage, beside the tables or, for catalog
    # tables, beside the stream's checkpoint
    marks = L.Store(spark, store.root or checkpoint)

    def merge(batch: DataFrame, epoch_id: int) -> None:
        epoch = os.path.join(collection, f"epoch={epoch_id}")
        if marks.exists("_batches", epoch):
            return
        docs, unparsed = _docs_of_batch(batch, epoch_id)
        L.load_collection(spark, collection, docs, store, run_ts=run_ts, refresh=False, check_parents=check_parents,
                          unparsed=unparsed, load_id=f"{collection}-{epoch_id}")
        marks.write("_batches", epoch, spark.createDataFrame([(epoch_id,)], "epoch long"))

    stream = (spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger).load(source_dir)
              .select("value", F.col("_metadata.file_path").alias("_fp"),
                      F.col("_metadata.file_block_start").alias("_bs")))
    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q
