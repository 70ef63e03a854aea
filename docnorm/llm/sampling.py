"""Bounded, repeatable samples of labelled rows for fitting small models on the driver."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from docnorm.llm.common import write_table


def bounded_sample(rows: DataFrame, label: str, per_label: int, total: int, order: Column) -> DataFrame:
    """At most ``min(per_label, total / labels)`` rows of each label, those with the smallest
    hash of ``order``. Classes smaller than that are taken whole.

    A first threshold on the hash, from the classes' counts, keeps the texts that meet in the
    final ranking near the bound whatever the size of the input.
    """
    # written, so that the size is known when the join is planned and the texts stay put
    counts = write_table(rows.groupBy(label).agg(F.count(F.lit(1)).alias("_n")), "label-counts")
    labels = counts.count()
    bound = min(per_label, max(1, total // max(labels, 1)))
    unit = (F.xxhash64(order).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))).alias("_unit")
    rough = (rows.select("*", unit).join(counts, label)
             .where(F.col("_unit") * F.col("_n") < bound + 6 * bound ** 0.5 + 6))
    first = Window.partitionBy(label).orderBy("_unit", order)
    return rough.withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") <= bound).drop("_nth", "_n", "_unit")
