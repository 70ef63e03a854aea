"""Periodic runs of words, found by joining suffixes in the order of falling common prefixes.

A run is a stretch of words with smallest period ``q``, at least two periods long, that can't
be extended. Its first suffix and the one ``q`` words on share exactly the run's length less
``q`` words. The suffixes of a document are ordered by prefix doubling, and neighbours in that
order are united by decreasing common prefix (LCP), as Kruskal's algorithm takes edges. A
class is an ordered set of positions; union-find names it, the smaller set goes into the
larger. Whenever a union makes two positions adjacent whose distance is within the LCP, the
stretch between them repeats: they seed a run of that period, and since they were apart until
now their common prefix is the LCP itself, so the run's end is known. The seed counts where
the words before both differ, which gives every run once, with its smallest period.

A run of ``min_length`` words or more has an LCP of half of that, so only positions whose
next ``min_length`` / 2 words come again in the document are united; most documents have none.
"""
from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docnorm.llm.common import WORD, table

MIN_LENGTH = 12
RUN = "array<struct<start:long,length:long,period:long>>"


def codes_of(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal for equal words."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def repeats_any(codes: np.ndarray, width: int) -> bool:
    """Whether ``width`` consecutive words may come twice (hashes: never a false no)."""
    n = len(codes) - width + 1
    if n < 2:
        return False
    h = np.zeros(n, np.uint64)
    for j in range(width):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + codes[j:j + n].astype(np.uint64)
    h.sort()
    return bool((h[1:] == h[:-1]).any())


def suffix_order(codes: np.ndarray) -> np.ndarray:
    """Positions ordered by the words that follow (shorter first), by prefix doubling."""
    rank, step, n = np.unique(codes, return_inverse=True)[1].astype(np.int64) + 1, 1, len(codes)
    while step < n and rank.max() < n:
        beyond = np.zeros(n, np.int64)
        beyond[:n - step] = rank[step:]
        rank = np.unique(rank * (n + 1) + beyond, return_inverse=True)[1].astype(np.int64) + 1
        step *= 2
    order = np.empty(n, np.int64)
    order[rank - 1] = np.arange(n)
    return order


def common_prefixes(codes: list[int], order: np.ndarray) -> np.ndarray:
    """Words shared by each suffix in order with the one before it (the first: 0)."""
    n = len(codes)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    out, have = [0] * n, 0
    for i, j in enumerate(before.tolist()):
        if j < 0:
            have = 0
            continue
        most = n - max(i, j)
        while have < most and codes[i + have] == codes[j + have]:
            have += 1
        out[i] = have
        have = max(have - 1, 0)
    return np.array(out, np.int64)[order]


def find_runs(codes: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``min_length`` words or more, by start, then period."""
    least = -(-min_length // 2)
    if not repeats_any(codes, max(least, 1)):
        return []
    order, words = suffix_order(codes), codes.tolist()
    shared = common_prefixes(words, order)
    edges = np.flatnonzero(shared >= max(least, 1))
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    at, common = order.tolist(), shared[edges].tolist()
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    runs = []

    def find(i: int) -> int:
        root = i
        while (above := parent.setdefault(root, root)) != root:
            root = above
        while parent[i] != root:
            parent[i], i = root, parent[i]
        return root

    def seed(i: int, j: int, lcp: int) -> None:
        period = j - i
        if period <= lcp and period + lcp >= min_length and (i == 0 or words[i - 1] != words[j - 1]):
            runs.append((i, period + lcp, period))

    for edge, lcp in zip(edges.tolist(), common, strict=True):
        large, small = find(at[edge - 1]), find(at[edge])
        held, added = members.setdefault(large, [large]), members.setdefault(small, [small])
        if len(held) < len(added):
            large, small, held, added = small, large, added, held
        parent[small] = large
        del members[small]
        # places of the added in the larger set as it was: what stands next to them there
        places = [bisect_left(held, i) for i in added]
        for nth, (i, place) in enumerate(zip(added, places, strict=True)):
            if place and (nth == 0 or places[nth - 1] != place):
                seed(held[place - 1], i, lcp)
            if place < len(held) and (nth + 1 == len(added) or places[nth + 1] != place):
                seed(i, held[place], lcp)
        if len(added) * 32 < len(held):
            for i, place in zip(reversed(added), reversed(places), strict=True):
                held.insert(place, i)
        else:
            held += added
            held.sort()  # two runs: merged in one pass
    return sorted(runs, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Mask of the words that no run holds behind its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def collapse_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and the collapsed
    text per row of docs (doc_id, text): each run cut to its first period, words joined by
    one space.

    Null, empty and white-space texts have no words, no runs and an empty collapsed text.
    Every row is a document of its own, also when ids repeat or are null; texts are taken
    whole, however long; an empty table gives an empty result. Other columns are not read.
    """

    def collapsed(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                some = batch.slice(low, 256)
                sizes, found, texts = [], [], []
                for text in some.column(1).to_pylist():
                    words = (text or "").encode().split()  # bytes split at exactly \x20 and \x09-\x0D
                    runs = find_runs(codes_of(words), min_length) if len(words) >= min_length else []
                    if runs:
                        keep = kept_words(len(words), runs)
                        texts.append(b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k]))
                    else:
                        texts.append(b" ".join(words))
                    sizes.append(len(words))
                    found.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs])
                kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(sizes, pa.int64()), pa.array(found, kind), pa.array(texts, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        collapsed, f"doc_id long, n_words long, runs {RUN}, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, of which a tenth of the documents repeats a stretch to its end.

    With h the CRC-32 of the decimal id and g = h / 10: where h ends in 0, word i from
    a = g % n on becomes word a + (i - a) % p with p = 1 + (n - a) / (3 + g % 8). Rows with a
    null id or without words stay.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g, n, words = F.floor(h / 10), F.size("words"), F.col("words")
    a = (F.col("g") % n).cast("int")
    p = (F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + F.col("g") % 8))).cast("int")
    planted = F.concat(
        F.slice(words, F.lit(1), F.col("a")),
        F.transform(F.sequence(F.lit(0), n - F.col("a") - 1), lambda i: F.element_at(words, F.col("a") + i % F.col("p") + 1)))
    chosen = (h % 10 == 0) & F.col("text").isNotNull()
    out = (docs.select("doc_id", "text", F.when(chosen, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("words"), g.alias("g"))
           .select("doc_id", "text", "words", "g", F.when(n > 0, a).alias("a")))
    out = out.select("doc_id", "text", "words", "a", p.alias("p"))
    return out.select("doc_id", F.when(n > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of all documents, a tenth of them with planted ones; digests of the outputs."""
    runs = F.col("runs")
    lines = F.transform(runs, lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    best = F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    out = collapse_runs(with_planted_runs(table(spark, sf_dir, "documents"))).withColumn("best", best)
    return out.select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), F.col("best.s").alias("start"), (-F.col("best.l")).alias("length"),
        F.col("best.p").alias("period"), F.expr("-1000 * best.l div best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
