"""Hierarchical packing of documents into windows of several lengths.

A document is routed to the shortest tier (1024, 512, 256 or 128 tokens) that holds it; of a
longer one, full windows are cut off and the rest is routed. Tiers are packed from the
longest: every document of a tier opens a window, and the gap behind it is filled from
shorter tiers, always with the longest piece that fits. Where none fits, the shortest that is
too long is cut, so that every window is full. What is left of a shard, less than one long
window, fills windows of the powers of two that its length is made of: nothing is padded.

Full windows are then dealt to training steps. A step holds windows of one tier and the same
number of tokens; windows are ranked by their attention cost (the sum of their pieces'
squared lengths) and dealt to the steps of their tier to and fro, so that steps cost alike.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docnorm.llm.common import global_rank, table, write_table
from docnorm.llm.tokens import VOCABULARY, encoder

TIERS, SHARD_TOKENS, STEP_TOKENS = (1024, 512, 256, 128), 1 << 22, 1 << 17
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, cost long"


class Waiting:
    """Pieces (document, start) by length; the lengths there are bits of one integer."""

    def __init__(self):
        self.by_length: dict[int, list[tuple[int, int]]] = {}
        self.lengths = self.tokens = 0

    def put(self, length: int, piece: tuple[int, int]) -> None:
        self.by_length.setdefault(length, []).append(piece)
        self.lengths |= 1 << length
        self.tokens += length

    def take(self, length: int) -> tuple[int, int]:
        pieces = self.by_length[length]
        if len(pieces) == 1:
            self.lengths &= ~(1 << length)
        self.tokens -= length
        return pieces.pop()

    def longest(self, most: int) -> int:
        """The greatest length there that is not over ``most``; 0: none."""
        return max((self.lengths & ((2 << most) - 1)).bit_length() - 1, 0)

    def shortest(self, over: int) -> int:
        """The least length there that is over ``over``."""
        beyond = self.lengths >> (over + 1)
        return over + (beyond & -beyond).bit_length()

    def fill(self, room: int) -> list[tuple[int, int, int]]:
        """Pieces (document, start, length) that fill ``room`` wholly; there must be as many tokens."""
        out = []
        while room:
            if length := self.longest(room):
                out.append((*self.take(length), length))
                room -= length
            else:
                length = self.shortest(room)
                document, start = self.take(length)
                out.append((document, start, room))
                self.put(length - room, (document, start + room))
                room = 0
        return out


def pack_tiers(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """(tier, pieces) of every window of a shard; a window's pieces add up to its tier.

    ``lengths``: tokens of each document. ``tiers``: powers of two, descending. The windows
    of the rest have their own length as tier.
    """
    top, windows, waiting = tiers[0], [], Waiting()
    for document, length in enumerate(lengths):
        whole = length - length % top
        windows += [(top, [(document, start, top)]) for start in range(0, whole, top)]
        if length > whole:
            waiting.put(length - whole, (document, whole))
    for tier, below in zip(tiers, (*tiers[1:], 0), strict=True):
        while waiting.tokens >= tier and (first := waiting.longest(tier)) > below:
            windows.append((tier, [(*waiting.take(first), first), *waiting.fill(tier - first)]))
    while waiting.tokens:
        tier = min(top, 1 << (waiting.tokens.bit_length() - 1))
        windows.append((tier, waiting.fill(tier)))
    return windows


def packed_pieces(docs: DataFrame, tiers: tuple[int, ...], vocabulary: str, end_id: int, shard_tokens: int) -> DataFrame:
    """Pieces of all documents, packed shard by shard within the tasks that read them."""

    def pieces(batches):
        from pyspark import TaskContext

        part, nth = TaskContext.get().partitionId() << 33, 0
        ids_of, end = encoder(vocabulary).ids, np.array([end_id], "<u4").tobytes()
        held, size = [], 0

        def packed():
            nonlocal nth
            columns: tuple[list, ...] = tuple([] for _ in range(9))
            for tier, window in pack_tiers([len(ids) // 4 for _, ids in held], tiers):
                offset, cost = 0, sum(n * n for _, _, n in window)
                for document, start, n in window:
                    doc_id, ids = held[document]
                    row = (doc_id, start, n, zlib.crc32(ids[4 * start:4 * (start + n)]), len(ids) // 4, part + nth, offset, tier, cost)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += n
                nth += 1
            kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    held.append((doc_id, ids_of(text) + end))
                    size += len(held[-1][1]) // 4
                    if size >= shard_tokens:
                        yield packed()
                        held, size = [], 0
        if held:
            yield packed()

    names = [c.split()[0] for c in PIECES.split(", ")]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, PIECES)


def with_steps(pieces: DataFrame, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Pieces (a written table) with the training step of their window.

    The windows of a tier are ranked by cost and dealt to its steps to and fro; the steps of
    the longest tier come first. A tier's steps differ by one window at most.
    """
    windows = pieces.where("offset = 0").select("sequence_id", "tier", "cost")
    counts = {r["tier"]: r["count"] for r in windows.groupBy("tier").count().collect()}  # a row per power of two
    ranked = global_rank(windows, [F.col("tier").desc(), F.col("cost").desc(), F.col("sequence_id")])
    step, before, first = F.lit(None).cast("long"), 0, 0
    for tier in sorted(counts, reverse=True):
        steps = -(-counts[tier] * tier // step_tokens)
        nth = F.col("rank") - 1 - before
        place = nth % steps
        back = F.floor(nth / steps) % 2 == 1
        step = F.when(F.col("tier") == tier, first + F.when(back, steps - 1 - place).otherwise(place)).otherwise(step)
        before, first = before + counts[tier], first + steps
    return pieces.join(ranked.select("sequence_id", step.cast("long").alias("step")), "sequence_id")


def pack_in_tiers(docs: DataFrame, tiers: tuple[int, ...] = TIERS, vocabulary: str = VOCABULARY, end_id: int = 0,
                  shard_tokens: int = SHARD_TOKENS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Pack documents (doc_id, text) into windows of ``tiers`` tokens (powers of two, descending).

    Returns per piece doc_id, start, length, ids_crc32, doc_tokens (with ``end_id``, which
    ends every document), sequence_id, offset, tier, cost (of its window) and step. A null or
    empty text is ``end_id`` alone. Every row is a document of its own, also when ids repeat
    or are null; an empty table packs to nothing. Other columns are not read.
    """
    if any(a < 2 * b for a, b in zip(tiers, tiers[1:])) or any(t & (t - 1) for t in tiers):
        raise ValueError("tiers are descending powers of two")
    return with_steps(write_table(packed_pieces(docs, tiers, vocabulary, end_id, shard_tokens), "tiered-pieces"), step_tokens)


def op13_tiered_packing(spark, sf_dir: str) -> DataFrame:
    return pack_in_tiers(table(spark, sf_dir, "documents"))
