"""Mix sources to target weights by nested hash thresholds (DataFrame functions only).

Every document has a fixed hash in [0, 2^60). A source that has to give a fraction of its
words gives the documents whose hash lies below a threshold; a larger budget only raises
the threshold, so budgets nest and reruns agree. The threshold is found from histograms:
words are summed by source and 1024 hash buckets, the bucket where the running sum passes
the budget is the boundary, and only the documents of that bucket are summed again by the
next ten bits, until it holds one document. Nothing is sorted by hash.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from docnorm.llm.common import global_rank, n_words, table, write_table

HASH_BITS, STEP_BITS = 60, 10


def doc_hash(doc_id: Column, seed: str) -> Column:
    """60 bits of md5 over seed and id; the same on every run and engine."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def source_key(source: Column) -> Column:
    """Equality key that keeps null apart from every text."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def targets(sizes: DataFrame, max_repeats: int = 3, cycle: int = 3) -> DataFrame:
    """Target words of each source from (skey, source, source_size).

    Sources by code point, null last, weigh 1..cycle, repeating, and share all words by
    weight. No target passes ``max_repeats`` times the source; the excess is shared again
    by weight until no target is above. Each round is one aggregate over the sources that
    returns three numbers.
    """
    ranked = write_table(
        global_rank(sizes, [F.col("source").asc_nulls_last()], "_rank")
        .withColumn("weight", (F.col("_rank") - 1) % cycle + 1).drop("_rank"), "sources")
    cap = F.col("source_size") * max_repeats
    total, weights = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    full: Column = F.lit(False)
    share, n_full = None, -1
    while True:
        row = ranked.agg(F.count_if(full).alias("n"), F.sum(F.when(full, cap)).alias("c"),
                         F.sum(F.when(full, F.col("weight"))).alias("w")).first()
        left, weight = (total or 0) - (row["c"] or 0), (weights or 0) - (row["w"] or 0)
        if row["n"] == n_full or weight <= 0:
            break
        n_full, share = row["n"], (left, weight)
        full = cap.cast("double") <= F.col("weight") * (F.lit(float(left)) / F.lit(float(weight)))
    left, weight = share or (0, 1)
    even = F.col("weight") * (F.lit(float(left)) / F.lit(float(weight)))
    return ranked.withColumn("target", F.when(full, cap.cast("double")).otherwise(even))


def thresholds(sized: DataFrame, goal: DataFrame) -> DataFrame:
    """(skey, epochs, threshold) from sized documents (skey, size, h) and targets.

    A document is taken ``epochs`` times, once more when its hash is below the threshold.
    The boundary document is taken if that brings the source nearer to its target; rows
    that share a hash (one id repeated) are taken or left together.
    """
    size = F.col("source_size")
    epochs = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(F.lit(0)).cast("long")
    state = goal.select("skey", epochs.alias("epochs"),
                        (F.col("target") - epochs * size).alias("rest"), F.lit(0).cast("long").alias("low"))
    state = state.withColumn("done", F.col("rest") <= 0)
    for shift in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        state = write_table(state, "thresholds")
        if state.where(~F.col("done")).isEmpty():
            break
        inside = F.shiftright("h", shift + STEP_BITS) == F.shiftright("low", shift + STEP_BITS)
        hist = (sized.where("size > 0").join(state.where(~F.col("done")).select("skey", "low", "rest"), "skey")
                .where(inside).groupBy("skey", "rest", F.shiftright("h", shift).alias("bucket"))
                .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs")))
        run = F.sum("words").over(Window.partitionBy("skey").orderBy("bucket"))
        first = F.row_number().over(Window.partitionBy("skey").orderBy("bucket"))
        cut = (hist.withColumn("run", run).where("run > rest").withColumn("nth", first).where("nth = 1")
               .select("skey", (F.col("rest") - (F.col("run") - F.col("words"))).alias("_rest"),
                       F.shiftleft("bucket", shift).alias("_low"), "words",
                       ((F.col("docs") == 1) | F.lit(shift == 0)).alias("_done")))
        take = F.when(F.col("_done") & (F.col("_rest") * 2 >= F.col("words")), F.lit(1 << shift)).otherwise(F.lit(0))
        state = state.join(cut, "skey", "left").select(
            "skey", "epochs", F.coalesce("_rest", "rest").alias("rest"),
            F.coalesce(F.col("_low") + take, F.col("low")).alias("low"),
            (F.col("done") | F.coalesce("_done", F.lit(True))).alias("done"))
    else:
        state = write_table(state, "thresholds")
    return state.select("skey", "epochs", F.col("low").alias("threshold"))


def plan_mix(docs: DataFrame, seed: str = "mix", max_repeats: int = 3) -> tuple[DataFrame, DataFrame]:
    """(sized documents, plan by source) for documents (doc_id, text, source, ...).

    Null text and text without words have size 0; a null source is a source of its own; an
    empty table gives two empty results. Columns beyond the three are not read.
    """
    sized = write_table(docs.select(
        "doc_id", "source", source_key(F.col("source")).alias("skey"), n_words(F.col("text")).alias("size"),
        doc_hash(F.col("doc_id"), seed).alias("h")), "sized")
    sizes = sized.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    goal = targets(sizes, max_repeats)
    plan = write_table(goal.join(thresholds(sized, goal), "skey")
                       .select("skey", "source_size", "target", "epochs", "threshold"), "mix-plan")
    return sized, plan


def repeats() -> Column:
    """How often a document is taken, from its hash and its source's plan."""
    return F.col("epochs") + (F.col("h") < F.col("threshold")).cast("long")


def mix_counts(docs: DataFrame, seed: str = "mix", max_repeats: int = 3) -> DataFrame:
    """doc_id, size, source_size, target and taken words (repeats counted) per document."""
    sized, plan = plan_mix(docs, seed, max_repeats)
    return sized.join(plan, "skey").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * repeats()).alias("taken"))


def mix(docs: DataFrame, seed: str = "mix", max_repeats: int = 3) -> DataFrame:
    """The mixture itself: rows of ``docs``, each as often as its source's plan takes it."""
    _, plan = plan_mix(docs, seed, max_repeats)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                      source_key(F.col("source")).alias("skey"), doc_hash(F.col("doc_id"), seed).alias("h"))
    taken = row.join(plan.select("skey", "epochs", "threshold"), "skey").where(repeats() > 0)
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), repeats()))).select("_row.*")


def op9_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix_counts(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || left(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 15))::BIGINT AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source),
r AS (SELECT *, coalesce(sum(3 * source_size) OVER o, 0) AS caps, coalesce(sum(w) OVER o, 0) AS ws,
             sum(source_size) OVER () AS total, sum(w) OVER () AS weights
      FROM s WINDOW o AS (ORDER BY 3.0 * source_size / w, w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, (3 * source_size)::DOUBLE <= w * ((total - caps)::DOUBLE / (weights - ws)::DOUBLE) AS capped FROM r),
t AS (SELECT source, source_size,
             CASE WHEN capped THEN (3 * source_size)::DOUBLE
                  ELSE w * ((max(total) OVER () - coalesce(sum(CASE WHEN capped THEN 3 * source_size END) OVER (), 0))::DOUBLE
                            / (max(weights) OVER () - coalesce(sum(CASE WHEN capped THEN w END) OVER (), 0))::DOUBLE) END AS target
      FROM c),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t),
x AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS run
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN rest <= 0 THEN 0 WHEN run <= rest THEN 1
                              WHEN run - size <= rest AND (rest - (run - size)) * 2 >= size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM x
"""
