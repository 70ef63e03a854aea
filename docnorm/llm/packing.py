"""Best-fit packing of token pieces by linear grouping.

Within a shard of pieces, the large ones are sorted and cut into groups of equal
cardinality, each group rounded up to its longest member. On these few sizes fill patterns
are optimised by exact subset sums, each pattern used as often as the groups allow. Then
the actual pieces take their group's places and the room left, rounding included, is given
to the small pieces by best fit. Shards are a hash of a row number, so neither a hot source
nor repeated rows gather in one task; a shard leaves at most a few sequences part empty.
"""
from __future__ import annotations

import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docnorm.llm.common import table, write_table
from docnorm.llm.tokens import VOCABULARY, encoder

CAPACITY, GROUPS, SHARD_PIECES = 2048, 512, 8192
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def group_sizes(lengths: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """(group of each length, rounded size of each group); ``lengths`` descend."""
    bounds = np.unique(np.linspace(0, len(lengths), min(groups, len(lengths)) + 1).astype(int))
    of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return of, lengths[bounds[:-1]]


def best_pattern(sizes: list[int], counts: list[int], room: int) -> dict[int, int]:
    """Groups and multiplicities whose rounded sizes fill ``room`` best.

    Reachable sums are bits of one integer, kept after every piece offered, so the best sum
    is read off the top bit and the pieces are found by walking back.
    """
    mask, reach, offered = (1 << (room + 1)) - 1, 1, []
    for g, (size, count) in enumerate(zip(sizes, counts, strict=True)):
        for _ in range(min(count, room // size)):
            offered.append((g, reach))
            grown = (reach | reach << size) & mask
            if grown == reach:
                offered.pop()
                break
            reach = grown
        if reach >> room & 1:
            break
    left, pattern = reach.bit_length() - 1, {}
    for g, before in reversed(offered):
        if not before >> left & 1:
            pattern[g] = pattern.get(g, 0) + 1
            left -= sizes[g]
    return pattern


def pack(lengths: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every length in 1..capacity, with the fewest bins of three views on
    which pieces are large: those over an eighth, a third or half of the capacity."""
    tried = [pack_above(lengths, capacity, groups, capacity // part) for part in (8, 3, 2)]
    bins = min(tried, key=lambda b: b.max(initial=-1))
    by_bin = np.argsort(bins, kind="stable")
    sizes = lengths[by_bin]
    starts = np.cumsum(sizes) - sizes
    new = np.r_[True, np.diff(bins[by_bin]) > 0][:len(bins)]
    offsets = np.empty(len(bins), np.int64)
    offsets[by_bin] = starts - np.repeat(starts[new], np.diff(np.r_[np.flatnonzero(new), len(bins)]))
    return bins, offsets


def pack_above(lengths: np.ndarray, capacity: int, groups: int, small: int) -> np.ndarray:
    """Bin of every length; those over ``small`` are grouped and rounded up."""
    order = np.argsort(-lengths, kind="stable")
    n_large = int((lengths > small).sum())
    large, bins, room = order[:n_large], np.empty(len(lengths), np.int64), []
    if n_large:
        of, sizes = group_sizes(lengths[large], groups)
        waiting = [list(large[of == g][::-1]) for g in range(len(sizes))]
        sizes = [int(s) for s in sizes]
        for first in range(len(sizes)):
            while waiting[first]:
                rest = [len(w) for w in waiting]
                rest[first] -= 1
                pattern = best_pattern(sizes, rest, capacity - sizes[first])
                pattern[first] = pattern.get(first, 0) + 1
                for _ in range(min(len(waiting[g]) // m for g, m in pattern.items())):
                    used = 0
                    for g, m in pattern.items():
                        for _ in range(m):
                            i = waiting[g].pop()
                            bins[i] = len(room)
                            used += int(lengths[i])
                    room.append(capacity - used)
    best_fit(order[n_large:], lengths, bins, room, capacity)
    return bins


def best_fit(pieces: np.ndarray, lengths: np.ndarray, bins: np.ndarray, room: list[int], capacity: int) -> None:
    """Put pieces, longest first, where least room is left; a new bin where none has room."""
    by_room: dict[int, list[int]] = {}
    for b, r in enumerate(room):
        by_room.setdefault(r, []).append(b)
    free = sorted(by_room)
    for i in pieces:
        need = int(lengths[i])
        at = bisect_left(free, need)
        if at == len(free):
            room.append(capacity)
            b, r = len(room) - 1, capacity
        else:
            r = free[at]
            b = by_room[r].pop()
            if not by_room[r]:
                del by_room[r]
                free.pop(at)
        bins[i], room[b] = b, r - need
        if room[b] not in by_room:
            by_room[room[b]] = []
            free.insert(bisect_left(free, room[b]), room[b])
        by_room[room[b]].append(b)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; the first takes the remainder."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)] if n else []


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = 0) -> DataFrame:
    """Pieces of every document: its ids, then ``end_id``. Null or empty text: one id."""
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches):
        ids_of = encoder(vocabulary).ids
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                out = []
                for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    ids = ids_of(text) + end
                    out += [(doc_id, k, s, n, zlib.crc32(ids[4 * s:4 * (s + n)]))
                            for k, (s, n) in enumerate(cut(len(ids) // 4, capacity))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), *[pa.int64()] * 3), strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, PIECES)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, groups: int = GROUPS,
                   shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Pack documents (doc_id, text) into sequences of at most ``capacity`` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. Every row is a
    document of its own, also when ids repeat or are null; an empty table packs to nothing.
    Only these two columns are read.
    """
    rows = write_table(token_pieces(docs, capacity, vocabulary).withColumn("row", F.monotonically_increasing_id()), "pieces")
    shards = max(1, -(-rows.count() // shard_pieces))

    def pack_shard(key, pieces):
        pieces = pieces.sort_values("row", ignore_index=True)
        bins, offsets = pack(pieces["length"].to_numpy(), capacity, groups)
        return pieces.assign(sequence_id=key[0] * (1 << 32) + bins, offset=offsets).drop(columns=["row", "shard"])

    return (rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards))).groupBy("shard")
            .applyInPandas(pack_shard, PIECES + ", sequence_id long, offset long"))


def op1_pack_best_fit(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
