"""Removal of repeated passages by longest-previous-factor arrays over suffix order.

A byte string of ``length`` that starts at two places is found in three steps.

1. Every window of ``length`` bytes is assigned to the smallest hash among its 64-byte
   grams, so equal windows share a gram at the same distance. About one place in seventy is
   such an anchor; those whose gram hash occurs once can't lie in a repeat and are dropped.
   Anchors that a task sees again with the same bytes around are settled there: one of them
   stands for all, so that a gram repeated over and over doesn't gather in one task.
2. Around each remaining anchor the bytes of its windows are cut out and sent to the anchor's
   task, so the copies of a repeat meet whatever documents they come from. Anchors with very
   many places are split further by the bytes that all windows of a part have in common.
3. A task orders the suffixes of its cuts up to ``length`` bytes by prefix doubling. Within a
   run of equal prefixes, ordered by place, the previous smaller place is the earlier match
   (the longest previous factor reaches ``length``) and the next one the later match.

Spans are united by document and cut out, of all copies or of all but the first.
"""
from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from docnorm.llm.common import shuffle_partitions, table

LENGTH, GRAM = 200, 64
#: Bytes hashed or ordered at once, places from which an anchor is split, starts in a part.
CHUNK, TASK_BYTES, HOT_PLACES, PART_STARTS = 1 << 19, 1 << 20, 512, 16
#: Columns added to those of the documents, named so that they don't meet others.
KEY, PLACES, SPANS = ("__repeat_id", "__repeat_text"), "__repeat_places", "__repeat_spans"
ODD = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)  # one size is kept, a worker's chunks are mostly alike
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """ODD^i and its inverse modulo 2^64 for i < n."""
    inverse = pow(int(ODD), -1, 1 << 64)
    up, down = np.ones(n, np.uint64), np.ones(n, np.uint64)
    up[1:], down[1:] = ODD, np.uint64(inverse)
    return np.cumprod(up), np.cumprod(down)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running sums of the bytes times falling powers, from which any span's hash is read."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(1 << len(data).bit_length())[1][:len(data)], out=total[1:])
    return total


def span_hashes(total: np.ndarray, first, end) -> np.ndarray:
    """64-bit hash of the bytes from ``first`` to ``end``, equal wherever the bytes are."""
    h = (total[end] - total[first]) * _powers(1 << (len(total) - 1).bit_length())[0][first]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of each run of ``gram`` bytes."""
    n = len(data) - gram + 1
    return span_hashes(prefix_sums(data), slice(0, n), slice(gram, gram + n))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        values, have = np.minimum(values[:-have], values[have:]), have * 2
    rest = width - have
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(gram hash, place, first start, last start) of the anchors of texts strung together.

    ``ends`` holds the end of the text of every byte; windows don't cross it. The leftmost of
    equal hashes counts, so that equal windows choose alike.
    """
    if len(data) < length:
        return tuple(np.zeros(0, t) for t in (np.uint64, *[np.int64] * 3))
    h = gram_hashes(data, gram)
    low = np.uint64((1 << 24) - 1)
    least = sliding_min((h & ~low) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
    place = (least & low).astype(np.int64)
    starts = np.flatnonzero(np.arange(len(place)) + length <= ends[:len(place)])
    place = place[starts]
    new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)]) if len(place) else place
    last = starts[np.r_[new[1:] - 1, len(place) - 1]] if len(place) else starts
    return h[place[new]], place[new], starts[new], last


def chunks(texts: list[bytes], length: int):
    """(data, text number, offset in its text, end) of pieces of at most CHUNK starts; a long
    text comes in pieces that overlap by ``length`` - 1 bytes."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - length + 1, 0), CHUNK):
            held.append((i, at, text[at:at + CHUNK + length - 1]))
            size += len(held[-1][2])
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


def same_cuts(data: np.ndarray, h: np.ndarray, first: np.ndarray, last: np.ndarray, length: int, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(again, leader) masks of anchors whose windows' bytes come several times in ``data``:
    the first by ``order`` leads, the others are there again. Equal hashes are compared."""
    cut = span_hashes(prefix_sums(data), first, last + length)
    by = np.lexsort((order, cut, h))
    same = (h[by[1:]] == h[by[:-1]]) & (cut[by[1:]] == cut[by[:-1]]) & (last[by[1:]] - first[by[1:]] == last[by[:-1]] - first[by[:-1]])
    again, leader, text, lead = np.zeros(len(h), bool), np.zeros(len(h), bool), data.tobytes(), -1
    for i in np.flatnonzero(same).tolist():
        a, b = by[i], by[i + 1]
        lead = a if lead < 0 or not again[a] else lead
        if text[first[b]:last[b] + length] == text[first[lead]:last[lead] + length]:
            again[b], leader[lead] = True, True
    return again, leader


def find_anchors(docs: DataFrame, length: int, gram: int, keep_first: bool) -> DataFrame:
    """gram, document (id_key, text_hash), place, starts before and behind it, of all anchors.

    ``sure`` rows are windows known to be repeats already, keyed by their document; anchors
    with the same bytes around as another of the same chunk come only as such.
    """

    def found(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                some = batch.slice(low, 1024)
                texts = [t or b"" for t in some.column("text").cast(pa.binary()).to_pylist()]
                ids, hashes = some.column("id_key"), some.column("text_hash")
                for held in chunks(texts, length):
                    sizes = np.array([len(t) for _, _, t in held])
                    bases = np.r_[0, np.cumsum(sizes)]
                    h, place, first, last = anchors(np.frombuffer(b"".join(t for _, _, t in held), np.uint8),
                                                    np.repeat(bases[1:], sizes), length, gram)
                    of = np.searchsorted(bases, place, "right") - 1
                    shift = np.array([at for _, at, _ in held])[of] - bases[of]
                    take = np.array([i for i, _, _ in held])[of]
                    own_id, own_hash = ids.to_numpy()[take], hashes.to_numpy()[take]
                    rank = np.empty(len(h), np.int64)
                    rank[np.lexsort((place + shift, own_hash, own_id))] = np.arange(len(h))
                    again, leader = same_cuts(np.frombuffer(b"".join(t for _, _, t in held), np.uint8), h, first, last, length, rank)
                    settled = again if keep_first else again | leader
                    # a settled row goes to its document's key; leaders stay anchors besides
                    rows = np.r_[np.flatnonzero(~again), np.flatnonzero(settled)]
                    sure = np.arange(len(rows)) >= (~again).sum()
                    key = np.where(sure, own_id[rows] * 31 + own_hash[rows], h.view(np.int64)[rows])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(own_id[rows]), pa.array(own_hash[rows]), pa.array((place + shift)[rows].astype(np.int32)),
                         pa.array((place - first)[rows].astype(np.int16)), pa.array((last - place)[rows].astype(np.int16)), pa.array(sure)],
                        names=["gram", "id_key", "text_hash", "place", "back", "ahead", "sure"])

    return docs.select("id_key", "text_hash", "text").mapInArrow(
        found, "gram long, id_key long, text_hash int, place int, back short, ahead short, sure boolean")


def parts_of(text: bytes, key: int, place: int, first: int, last: int, hot: bool, length: int) -> list[tuple[int, int, int]]:
    """(key, first start, last start) of the cuts of an anchor: one, or for an anchor of very
    many places one for every PART_STARTS starts, keyed by the bytes that all its windows hold."""
    if not hot:
        return [(key, first, last)]
    out = []
    for part in range((place - last) // PART_STARTS, (place - first) // PART_STARTS + 1):
        nearest = place - part * PART_STARTS
        core = text[max(nearest, 0):nearest - PART_STARTS + 1 + length]
        out.append((xxhash.xxh3_64_intdigest(core, seed=part & 0xFFFF) - (1 << 63), max(first, nearest - PART_STARTS + 1), min(last, nearest)))
    return out


def cut_out(rows: DataFrame, length: int) -> DataFrame:
    """Windows' bytes around the anchors of each document (text, places): key, cut, and the
    places (id_key, text_hash, start) where that cut stands. Equal cuts of a batch go once.
    A sure repeat has no bytes to compare: its cut is its length, in four bytes."""

    def cuts(batches):
        for batch in batches:
            seen: dict[tuple[int, bytes], list[int]] = {}
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            ids, hashes, places = (batch.column(c) for c in ("id_key", "text_hash", "places"))
            bounds, fields = places.offsets.to_numpy(), places.values.flatten()
            gram, place, back, ahead, hot, sure = (f.to_numpy(zero_copy_only=False) for f in fields)
            first, last = place - back, place + ahead
            for i, (id_key, text_hash, text) in enumerate(zip(ids.to_pylist(), hashes.to_pylist(), texts, strict=True)):
                # a row that stands there twice has found its places as often
                all_ = slice(bounds[i], bounds[i + 1])
                own = np.unique(place[all_] * 2 + sure[all_], return_index=True)[1] + bounds[i]
                for k, p, a, b, h, known in zip(*(x[own].tolist() for x in (gram, place, first, last, hot, sure)), strict=True):
                    if known:
                        seen.setdefault((k, (b + length - a).to_bytes(4, "little")), []).extend((id_key, text_hash, a))
                        continue
                    for key, s, e in parts_of(text, k, p, a, b, h, length):
                        seen.setdefault((key, text[s:e + length]), []).extend((id_key, text_hash, s))
            whole = list(seen.items())
            for at in range(0, len(whole), 4096):
                some = whole[at:at + 4096]
                where = np.fromiter(chain.from_iterable(w for _, w in some), np.int64).reshape(-1, 3)
                ends = pa.array(np.r_[0, np.cumsum([len(w) // 3 for _, w in some])].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for (k, _), _ in some], pa.int64()), pa.array([c for (_, c), _ in some], pa.binary()),
                     *(pa.ListArray.from_arrays(ends, pa.array(where[:, j].astype(t))) for j, t in enumerate((np.int64, np.int32, np.int32)))],
                    names=["key", "cut", "id_key", "text_hash", "start"])

    return rows.mapInArrow(cuts, "key long, cut binary, id_key array<long>, text_hash array<int>, start array<int>")


def prefix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of every suffix by its first ``length`` bytes (prefix doubling); ranks of suffixes
    shorter than that mean nothing."""
    have = min(8, length)
    words = np.zeros(len(data), np.uint64)
    for j in range(min(have, len(data))):
        words[:len(data) - j] |= data[j:].astype(np.uint64) << np.uint64(56 - 8 * j)
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    while have < length:
        step = min(have, length - have)
        beyond = np.zeros(len(rank), np.int64)
        beyond[:max(len(rank) - step, 0)] = rank[step:]
        rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + beyond, return_inverse=True)[1].astype(np.int64)
        have += step
    return rank


def earlier_and_later(data: np.ndarray, starts: np.ndarray, order: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether the ``length`` bytes at each start also start earlier or later, by ``order``.

    In suffix order, cut at ``length`` bytes and sorted by place among equals, the neighbour
    before is the previous smaller place with a common prefix that long, the one behind the
    next.
    """
    rank = prefix_ranks(data, length)[starts]
    suffixes = np.lexsort((order, rank))
    equal = rank[suffixes[1:]] == rank[suffixes[:-1]]
    before, behind = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    before[suffixes[1:]], behind[suffixes[:-1]] = equal, equal
    return before, behind


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """First and last index of each run of true."""
    edge = np.flatnonzero(np.diff(np.r_[0, mask.astype(np.int8), 0]))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True))


def match(rows: list[tuple], length: int, keep_first: bool) -> list[tuple]:
    """(id_key, text_hash, first byte, end) of the repeats among cuts (cut, id_keys, hashes, starts).

    Windows whose hash stands alone are left out before the suffixes are ordered; hashes only
    choose what is compared, the order compares bytes.
    """
    merged: dict[bytes, list[tuple]] = {}
    out = []
    for cut, *where in rows:
        if len(cut) < length:
            span = int.from_bytes(cut, "little")
            out += [(id_key, text_hash, start, start + span) for id_key, text_hash, start in zip(*where, strict=True)]
        else:
            merged.setdefault(cut, []).extend(zip(*where, strict=True))
    if not merged:
        return out
    places = [sorted(w) for w in merged.values()]
    by_place = np.empty(len(places), np.int64)
    by_place[sorted(range(len(places)), key=lambda r: places[r][0])] = np.arange(len(places))
    sizes = np.fromiter(map(len, merged), np.int64, len(merged))
    counts = sizes - length + 1
    bases = np.cumsum(sizes) - sizes
    firsts = np.cumsum(counts) - counts
    row = np.repeat(np.arange(len(sizes)), counts)
    inner = np.arange(len(row)) - firsts[row]
    data = np.frombuffer(b"".join(merged), np.uint8)
    h = gram_hashes(data, length)[bases[row] + inner]
    order = np.argsort(h)
    equal = h[order[1:]] == h[order[:-1]]
    shared = np.zeros(len(h), bool)
    shared[order[1:]] |= equal
    shared[order[:-1]] |= equal
    early, late = np.zeros(len(h), bool), np.zeros(len(h), bool)
    if shared.any():
        # the shared stretch of each cut, strung together
        chosen = np.flatnonzero(shared)
        own, begin = np.unique(row[chosen], return_index=True)
        low, high = inner[chosen[begin]], inner[chosen[np.r_[begin[1:] - 1, len(chosen) - 1]]]
        spans = high - low + length
        at = np.cumsum(spans) - spans
        some = data[np.repeat(bases[own] + low - at, spans) + np.arange(spans.sum())]
        shift = np.zeros(len(sizes), np.int64)
        shift[own] = at - low
        early[chosen], late[chosen] = earlier_and_later(
            some, shift[row[chosen]] + inner[chosen], by_place[row[chosen]] * (int(sizes.max()) + 1) + inner[chosen], length)
    any_ = early | late
    for r, (where, a, n) in enumerate(zip(places, firsts.tolist(), counts.tolist(), strict=True)):
        several = len(where) > 1
        mask = early[a:a + n] if keep_first else any_[a:a + n]
        ranges = [(0, n - 1)] if several and not keep_first else runs(mask) if mask.any() else []
        others = [(0, n - 1)] if several else []
        for nth, (id_key, text_hash, start) in enumerate(where):
            out += [(id_key, text_hash, start + x, start + y + length) for x, y in (others if nth else ranges)]
    return out


def repeated_spans(cuts: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """id_key, text_hash, first, end of the repeats, from cuts that meet by key.

    A task takes its cuts in key order, so much at a time as TASK_BYTES, whole keys only.
    """

    def spans(batches):
        def send(rows):
            out = match(rows, length, keep_first)
            for at in range(0, len(out), 50_000):
                some = np.array(out[at:at + 50_000], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(some[:, 0]), *(pa.array(some[:, j].astype(np.int32)) for j in (1, 2, 3))],
                                                 names=["id_key", "text_hash", "first", "end"])

        held, size, key = [], 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != key and size >= TASK_BYTES:
                    yield from send(held)
                    held, size = [], 0
                key = row[0]
                held.append(row[1:])
                size += len(row[1])
        if held:
            yield from send(held)

    return (cuts.repartition(shuffle_partitions(cuts.sparkSession), "key").sortWithinPartitions("key")
            .mapInArrow(spans, "id_key long, text_hash int, first int, end int"))


def keyed(docs: DataFrame) -> DataFrame:
    """docs with the two key columns: id and a hash of the text. A null id's is 62 bits of
    another hash behind the ids, so that rows without id are told apart by both."""
    id_key, text_hash = KEY
    behind = F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    return docs.withColumns({
        id_key: F.coalesce(F.col("doc_id").cast("long"), behind),
        text_hash: F.xxhash64(F.col("doc_id").isNull(), "text").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")})


def with_spans(docs: DataFrame, length: int = LENGTH, keep_first: bool = False) -> DataFrame:
    """All columns of docs with ``spans``, the repeated byte ranges (first, end) in no order,
    null where there are none, and two key columns (their names in KEY).

    Rows are keyed by id and text, so rows that share both share their spans. The two joins
    with the texts are on the same columns: they use one shuffle of the texts.
    """
    if length < 8:
        raise ValueError("a repeat has at least eight bytes")
    gram = min(GRAM, length)
    id_key, text_hash = KEY
    whole = keyed(docs)
    found = (find_anchors(whole.select(F.col(id_key).alias("id_key"), F.col(text_hash).alias("text_hash"), "text"), length, gram, keep_first)
             .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("gram"))).where("n > 1 OR sure")
             .groupBy(F.col("id_key").alias(id_key), F.col("text_hash").alias(text_hash)).agg(F.collect_list(F.struct(
                 "gram", "place", "back", "ahead", (F.col("n") > HOT_PLACES).alias("hot"), "sure")).alias(PLACES)))
    named = [F.col(id_key).alias("id_key"), F.col(text_hash).alias("text_hash"), F.col("text"), F.col(PLACES).alias("places")]
    others = [F.col(f"`{c}`").alias(f"other{i}") for i, c in enumerate(docs.columns) if c != "text"]
    cuts = cut_out(whole.join(found, [id_key, text_hash]).select(*named, *others), length)
    spans = repeated_spans(cuts, length, keep_first).groupBy(F.col("id_key").alias(id_key), F.col("text_hash").alias(text_hash)).agg(
        F.collect_list(F.struct("first", "end")).alias(SPANS))
    return whole.join(spans, [id_key, text_hash], "left").select(*[F.col(f"`{c}`") for c in docs.columns], SPANS)


def united(first: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal ranges covered by the spans."""
    if not len(first):
        return []
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.r_[True, first[1:] > reach[:-1]])
    return list(zip(first[new].tolist(), reach[np.r_[new[1:] - 1, len(first) - 1]].tolist(), strict=True))


def without(text: bytes, ranges: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for r in ranges for x in r), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def ranges_of(spans: pa.ListArray) -> list[list[tuple[int, int]]]:
    """United ranges of each row's spans (null: none)."""
    bounds = spans.offsets.to_numpy()
    first, end = (f.to_numpy() for f in spans.values.flatten())
    return [united(first[a:b], end[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def digests(docs: DataFrame, length: int = LENGTH, keep_first: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row of docs (doc_id, text).

    Null text counts as empty; rows that repeat are texts of their own, so both lose what
    they share; ids may be null or repeat; an empty table gives an empty result. Other
    columns are not read.
    """

    def digest(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            ranges = ranges_of(batch.column(SPANS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (
                    [len(t) for t in texts], [sum(b - a for a, b in r) for r in ranges], [len(r) for r in ranges])),
                 pa.array([hashlib.sha256(without(t, r)).hexdigest() for t, r in zip(texts, ranges, strict=True)], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return with_spans(docs.select(F.col("doc_id").cast("long"), "text"), length, keep_first).mapInArrow(
        digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def drop_repeats(docs: DataFrame, length: int = LENGTH, keep_first: bool = True) -> DataFrame:
    """Rows of docs without repeated passages, all columns as they were but ``text`` and, if
    there, ``n_chars``. The first copy stays: that of the smallest id (null last), then of the
    first place; rows that share id and text are not told apart and lose the passage both.
    Only whole characters are kept where a passage ends inside one. A text of which nothing
    but white space is left goes.
    """

    def dropped(batches):
        for batch in batches:
            texts, ranges = batch.column("text").cast(pa.binary()).to_pylist(), ranges_of(batch.column(SPANS))
            kept = [without(t, r).decode(errors="ignore") if r else t and t.decode() for t, r in zip(texts, ranges, strict=True)]
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns["text"] = pa.array(["" if t == b"" else k for t, k in zip(texts, kept, strict=True)], pa.string())
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([len(k) if r else n for k, r, n in zip(
                    kept, ranges, columns["n_chars"].to_pylist(), strict=True)], columns["n_chars"].type)
            stays = pa.array([not r or bool(k.strip()) for k, r in zip(kept, ranges, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([columns[c] for c in docs_columns], names=docs_columns).filter(stays)

    docs_columns = docs.columns
    return with_spans(docs, length, keep_first).mapInArrow(dropped, docs.schema)


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
