"""Exact top-k by inner product over a bit-sliced index.

Components are quantised to integers. The index of a block of rows keeps, per row and bit
position, one bitmap over the dimensions: slice j of a row has bit d set where bit j of
component d is set (two's complement, the top slice counts negative). A slice's share of an
inner product is bitmap arithmetic: AND with the query's slices and count bits. Slices are
added from the most significant downward; after each, a row stays only if what it has plus
the most the remaining slices can add reaches the k-th best lower bound. Rows left at the
last slice have exact scores, and ties at the boundary go to the smaller id.
Sums that could pass int64 are taken in Python integers, by the same steps.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from docnorm.llm.common import table, write_table

SCALE, TOP, BLOCK_ROWS, QUERY_ROWS = 1024, 10, 4096, 1024
#: Vectors with larger quantised components travel as they are and are quantised to Python integers.
LARGEST = 1 << 40
#: Scores leave a block as two longs, score >> LIMB and the rest, so that none is cut.
LIMB = 62


def quantised(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def slices(values: np.ndarray, bits: int) -> np.ndarray:
    """[bits, words, rows] bitmaps over dimensions of integers [rows, dimensions], top slice first."""
    rows, dims = values.shape
    words = -(-dims // 64)
    padded = np.zeros((rows, words * 64), values.dtype)
    padded[:, :dims] = values
    out = np.empty((bits, words, rows), np.uint64)
    for j in range(bits):
        bit = (padded >> (bits - 1 - j) & 1).astype(np.uint8)
        out[j] = np.packbits(bit, axis=1).view(np.uint64).T
    return out


def weights(bits: int) -> np.ndarray:
    """Worth of each slice, top first, in two's complement."""
    worth = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
    worth[0] = -worth[0]
    return worth


def best_rows(index: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and exact scores of the k best rows of a block, without those of id ``own``."""
    bits, bits_q = len(index), int(max(query.max(), -1 - query.min(), 0)).bit_length() + 1
    of_query = slices(query[None, :], bits_q)[:, :, 0]
    most, least = int(query[query > 0].sum()), int(query[query < 0].sum())
    wide = bits + bits_q + len(query).bit_length() >= LIMB
    kind = object if wide else np.int64
    rows = np.flatnonzero(ids != own)
    score = np.zeros(len(rows), kind)
    for j in range(bits):
        here = index[j][:, rows]
        added = np.zeros(len(rows), kind)
        for top in range(0, bits_q, 24):  # query slices whose counts are summed in int64
            of = of_query[top:top + 24]
            part = np.zeros(len(rows), np.int64)
            worth = weights(len(of)) if top == 0 else 1 << np.arange(len(of) - 1, -1, -1, dtype=np.int64)
            for q, w in zip(of, worth, strict=True):
                count = np.bitwise_count(here & q[:, None])
                part += w * (count.sum(axis=0, dtype=np.int64) if len(count) > 1 else count[0].astype(np.int64))
            added += part.astype(kind) * (1 << (bits_q - top - len(of)))
        score += added * ((1 << (bits - 1 - j)) * (-1 if j == 0 else 1))
        rest = (1 << (bits - 1 - j)) - 1
        if rest and len(rows) > k and j:
            kth = np.sort(score)[len(score) - k] if wide else np.partition(score, len(score) - k)[len(score) - k]
            stay = (score + rest * most >= kth + rest * least).astype(bool)
            rows, score = rows[stay], score[stay]
    best = np.array(sorted(range(len(rows)), key=lambda i: (-score[i], ids[rows[i]]))[:k], np.int64) if wide else np.lexsort((ids[rows], -score))[:k]
    return rows[best], score[best]


def integers(rows: pd.DataFrame, dims: int, scale: int) -> np.ndarray:
    """[rows, dims] quantised components: int64, or Python integers if a row holds large ones."""
    out = np.zeros((len(rows), dims), object if rows["large"].notna().any() else np.int64)
    for i, (v, large) in enumerate(zip(rows["values"], rows["large"], strict=True)):
        if large is None:
            out[i, :len(v)] = v.tolist() if out.dtype == object else v
        else:
            out[i, :len(large)] = [math.floor(x * scale) if abs(x) < 1 << 53 else int(x) * scale for x in large.tolist()]
    return out


def search_block(vectors: pd.DataFrame, queries: pd.DataFrame, k: int, scale: int = SCALE) -> pd.DataFrame:
    """Each query's k best rows of one block of vectors (vec_id, values or large)."""
    dims = max(len(v) for rows in (vectors, queries) for c in ("values", "large") for v in rows[c] if v is not None)
    values = integers(vectors, dims, scale)
    bits = int(max(values.max(initial=0), -1 - values.min(initial=0), 0)).bit_length() + 1
    index, ids = slices(values, bits), vectors["vec_id"].to_numpy()
    found = []
    for at, own in enumerate(queries["vec_id"]):
        rows, score = best_rows(index, ids, integers(queries.iloc[at:at + 1], dims, scale)[0], own, k)
        high = np.array([min(max(int(s) >> LIMB, -1 << 62), 1 << 62) for s in score], np.int64)
        low = np.array([int(s) & (1 << LIMB) - 1 for s in score], np.int64)
        found.append(pd.DataFrame({"query_id": own, "vec_id": ids[rows], "high": high, "low": low}))
    return pd.concat(found) if found else nothing()


def nothing() -> pd.DataFrame:
    return pd.DataFrame({"query_id": [], "vec_id": [], "high": [], "low": []}, dtype="int64")


def top_k(vectors: DataFrame, is_query: Column, k: int = TOP, scale: int = SCALE,
          block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the highest integer inner product.

    Blocks of vectors meet blocks of queries, so memory is bounded by the two block sizes at
    any input size; each pair of blocks returns at most k rows a query. Ties go to the
    smaller vec_id; rows with a query's own vec_id are not its candidates. Vectors that are
    null or hold null or non-finite components and rows without vec_id take no part; shorter
    vectors count as padded with zeros. Query rows that repeat an id count once. A score among
    the k best that a long can't hold is an error, as in SQL. Other columns are not read.
    """
    rough = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"), is_query.alias("asks"))
    fit = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    large = F.exists("embedding", lambda x: F.abs(x) >= LARGEST / scale)
    rows = write_table(rough.where(F.col("vec_id").isNotNull() & F.coalesce(fit, F.lit(False)) & (F.size("embedding") > 0))
                       .select("vec_id", "asks", F.when(~large, quantised(F.col("embedding"), scale)).alias("values"),
                               F.when(large, F.col("embedding")).alias("large"))
                       .withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    blocks, query_blocks = max(1, -(-n // block_rows)), max(1, -(-n_queries // query_rows))
    spread = lambda of: F.explode(F.sequence(F.lit(0), F.lit(of - 1)))
    side = (rows.select("vec_id", "values", "large", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"))
            .withColumn("query_block", spread(query_blocks)))
    asked = (rows.where("asks").dropDuplicates(["vec_id"])
             .select("vec_id", "values", "large", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int").alias("query_block"))
             .withColumn("block", spread(blocks)))

    def search(left, right):
        if left.empty or right.empty:
            return nothing()
        return search_block(left, right, k, scale)

    found = (side.groupBy("block", "query_block").cogroup(asked.groupBy("block", "query_block"))
             .applyInPandas(search, "query_id long, vec_id long, high long, low long"))
    best = Window.partitionBy("query_id").orderBy(F.col("high").desc(), F.col("low").desc(), "vec_id")
    fits = F.col("high").between(-(1 << 63 - LIMB), (1 << 63 - LIMB) - 1)
    score = F.when(fits, F.shiftleft("high", LIMB) + F.col("low")).otherwise(F.raise_error(F.lit("score beyond long")).cast("long"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", score.alias("score")))


def op3_bit_sliced_top_k(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""
