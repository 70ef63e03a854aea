"""Alignment of the tokens of two vocabularies over the same texts.

Vocabulary A is a byte-level BPE, B a sentence-piece BPE that marks a space in front of a
word. Neither holds a token that goes from another character into a space (checked for B when
it is loaded), so a space behind a word is an anchor: tokens of both end there, and the next
ones are space-marked. The windows between anchors are tokenised and checked: the bytes of
both sides' tokens must be those of the window, which verifies the shared end. A window and its
two tuples of ids then stand for each other, so Arrow's dictionary of the windows of a group
of texts is the memo: each distinct one is aligned once, and its groups and links are dealt
to all its places.

Within a window, offsets where tokens of both sides end cut the tokens into groups, and every
A token is linked with the B tokens whose bytes it overlaps. A written table holds per
document its distinct linked pairs with their numbers. Counts of pairs over the corpus, and
the highest of each B id, go back to the documents by a join: pairs that are frequent are
broadcast, as many as ``BROADCAST_PAIRS`` at most, and only the rare rest is shuffled.
"""
from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docnorm.llm.common import table, write_table
from docnorm.llm.tokens import VOCABULARY, encoder

PIECE_VOCABULARY = "piece_bpe_32k"
GROUP_BYTES, BROADCAST_PAIRS = 1 << 23, 1_000_000
#: ASCII white space, and the last two bytes that end any other Unicode white space.
BLANK, UNICODE_BLANK_1, UNICODE_BLANK_2 = (np.zeros(256, bool) for _ in range(3))
BLANK[[9, 10, 11, 12, 13, 32]] = True
UNICODE_BLANK_1[[0xC2, 0x80, 0x81, 0x9A]] = True
UNICODE_BLANK_2[[0x85, 0xA0, *range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F]] = True
DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, counts array<int>"


def distinct_windows(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct windows, the number of each window's, first window of each text and the end).

    A window opens with a text, or with a space behind anything but white space. What only
    may be white space by its last two bytes opens none: windows then are longer than need be.
    """
    data = b"".join(texts)
    raw, bounds = np.frombuffer(data, np.uint8), np.cumsum([0, *map(len, texts)])
    opens = np.append(raw == 32, True)
    if len(raw):
        before = BLANK[raw]
        before[1:] |= UNICODE_BLANK_1[raw[:-1]] & UNICODE_BLANK_2[raw[1:]]
        opens[1:] &= ~before
    opens[bounds] = True
    starts = np.flatnonzero(opens).astype(np.int32)
    windows = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data)]).dictionary_encode()
    return windows.dictionary.to_pylist(), windows.indices.to_numpy(), np.searchsorted(starts, bounds)


class Aligner:
    """Token ids of windows in both vocabularies and their alignments."""

    def __init__(self, vocabulary: str, piece_vocabulary: str):
        import public_tokenizers
        import sentencepiece

        self.a = encoder(vocabulary)
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{piece_vocabulary}.model"))
        self.size_a, self.size_b = max(self.a.tokens) + 1, self.b.vocab_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.size_b)]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{piece_vocabulary} has pieces that go from a word into a space")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_width = np.array([len(self.a.tokens.get(i, b"")) for i in range(self.size_a)], np.int64)
        self.b_width = np.array(list(map(len, self.b_bytes)), np.int64)
        #: an id and what stands behind it in the text of groups: A within a group, A at its end, B likewise
        self.labels = pa.array([f"{i}{mark}" for size, marks in ((self.size_a, ",|"), (self.size_b, ",;")) for mark in marks for i in range(size)],
                               pa.large_binary())

    def tokens(self, windows: list[bytes]) -> tuple[np.ndarray, ...]:
        """(A ids, A tokens of each window, B ids, B tokens of each window, whether both
        sides' bytes are the window's); windows that differ come without tokens."""
        text = [w.decode() for w in windows]
        # windows strung together are tokenised as one text, up to one that ends with white space
        breaks = [i for i, t in enumerate(text, 1) if t[-1].isspace()]
        a_ids = np.frombuffer(b"".join(self.a.plain("".join(text[i:j])) for i, j in zip([0, *breaks], [*breaks, len(text)], strict=True)), "<u4").astype(np.int64)
        size = np.fromiter(map(len, windows), np.int64, len(windows))
        n_a = np.diff(np.searchsorted(np.cumsum(self.a_width[a_ids]), np.r_[0, np.cumsum(size)], "right"))
        # the one space of an otherwise empty window is in front of nothing
        b_ids = [ids or [self.b.piece_to_id("▁")] for ids in self.b.encode([t[1:] for t in text], num_threads=1)]
        fine, data = np.ones(len(windows), bool), b"".join(windows)
        if b"".join(map(self.b_bytes.__getitem__, chain.from_iterable(b_ids))) != data:
            fine &= [b"".join(map(self.b_bytes.__getitem__, b)) == w for b, w in zip(b_ids, windows, strict=True)]
        if b"".join(map(self.a.tokens.__getitem__, a_ids.tolist())) != data:
            raise ValueError("the byte-level vocabulary doesn't hold every byte")
        if not fine.all():
            a_ids, n_a = a_ids[np.repeat(fine, n_a)], n_a * fine
            b_ids = [x if ok else [] for x, ok in zip(b_ids, fine, strict=True)]
        n_b = np.fromiter(map(len, b_ids), np.int64, len(windows))
        return a_ids, n_a, np.fromiter(chain.from_iterable(b_ids), np.int64, n_b.sum()), n_b, fine

    def align(self, windows: list[bytes]) -> tuple:
        """(A tokens, B tokens, groups, groups as text, linked pairs as 64-bit numbers, whether
        the bytes are the same) of distinct windows, each of which opens with a space.

        The ends of the tokens of all windows are places in one string of bytes. Between two
        neighbouring ends there is one token of either side: a link. Ends of both sides close
        a group.
        """
        a_ids, n_a, b_ids, n_b, fine = self.tokens(windows)
        a_end, b_end = np.cumsum(self.a_width[a_ids]), np.cumsum(self.b_width[b_ids])
        ends = np.sort(np.r_[a_end, b_end], kind="stable")
        again = np.r_[False, ends[1:] == ends[:-1]][:len(ends)]
        shared, ends = ends[again], ends[~again]
        pairs = a_ids[np.searchsorted(a_end, ends)] * self.size_b + b_ids[np.searchsorted(b_end, ends)]
        bounds = np.r_[0, np.cumsum(np.where(fine, np.fromiter(map(len, windows), np.int64, len(windows)), 0))]
        of_a, of_b = np.searchsorted(shared, a_end), np.searchsorted(shared, b_end)
        labels = np.r_[a_ids + self.size_a * (shared[of_a] == a_end), 2 * self.size_a + b_ids + self.size_b * (shared[of_b] == b_end)]
        in_order = np.argsort(np.r_[2 * of_a, 2 * of_b + 1], kind="stable")
        text = self.labels.take(pa.array(labels[in_order]))
        text_at = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1)[np.r_[0, np.cumsum(n_a + n_b)]]
        pairs_at = 8 * np.searchsorted(ends, bounds, "right")
        strung = (pa.Array.from_buffers(pa.large_binary(), len(windows), [None, pa.py_buffer(at.astype(np.int64)), data])
                  for at, data in ((text_at, text.buffers()[2]), (pairs_at, pa.py_buffer(pairs))))
        return n_a, n_b, np.diff(np.searchsorted(shared, bounds, "right")), *strung, fine

    def documents(self, texts: list[bytes]) -> list[pa.Array]:
        """Per text (a space in front): n_a, n_b, n_groups, n_links, digest of the groups,
        distinct pairs and how often each; zeros for an empty one and where bytes differ."""
        distinct, number, bounds = distinct_windows(texts)
        *sizes, text, pairs, fine = self.align(distinct)
        first, n = bounds[:-1], len(texts)
        whole = np.logical_and.reduceat(fine[number], first) & (np.fromiter(map(len, texts), np.int64, n) > 1)
        sizes = [np.add.reduceat(s[number], first) * whole for s in sizes]
        dealt = [x.take(pa.array(number)) for x in (text, pairs)]
        (text, text_at), (raw, raw_at) = ((memoryview(d.buffers()[2] or b""), np.frombuffer(d.buffers()[1], np.int64, len(number) + 1)[bounds]) for d in dealt)
        shas = [hashlib.sha256(text[a:b - 1]).hexdigest() if ok else "" for a, b, ok in zip(text_at[:-1].tolist(), text_at[1:].tolist(), whole, strict=True)]
        links = np.diff(raw_at) // 8
        of = np.repeat(np.arange(n), links)
        span = self.size_a * self.size_b
        keys = np.sort((of * span + np.frombuffer(raw, np.int64))[whole[of]])
        new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        often = np.diff(np.r_[new, len(keys)]).astype(np.int32)
        ends = pa.array(np.searchsorted(keys[new] // span, np.arange(n + 1)).astype(np.int32))
        return [*(pa.array(s) for s in sizes), pa.array(links * whole), pa.array(shas, pa.string()),
                pa.ListArray.from_arrays(ends, pa.array(keys[new] % span)), pa.ListArray.from_arrays(ends, pa.array(often))]


@lru_cache(maxsize=1)
def aligner(vocabulary: str = VOCABULARY, piece_vocabulary: str = PIECE_VOCABULARY) -> Aligner:
    """The worker's aligner; its vocabularies are kept between tasks."""
    return Aligner(vocabulary, piece_vocabulary)


def aligned_documents(docs: DataFrame, vocabulary: str = VOCABULARY, piece_vocabulary: str = PIECE_VOCABULARY) -> DataFrame:
    """The columns of DOCUMENT per row of docs (doc_id, text).

    ``pairs`` holds the distinct linked pairs of ids, each as A id * size of B + B id, and
    ``counts`` the links of each. Null and empty texts, and those whose tokens' bytes differ
    from a space and the text on either side, have no tokens: zeros, no digest, no pairs.
    """
    names = [c.split()[0] for c in DOCUMENT.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def aligned(batches):
        use = aligner(vocabulary, piece_vocabulary)

        def made(held):
            ids = pa.array([d for d, _ in held], pa.int64())
            return pa.RecordBatch.from_arrays([ids, *(c.cast(k) for c, k in zip(use.documents([t for _, t in held]), kinds[1:], strict=True))], names=names)

        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    held.append((doc_id, b" " + (text or "").encode()))
                    size += len(held[-1][1])
                    if size >= GROUP_BYTES:
                        yield made(held)
                        held, size = [], 0
        if held:
            yield made(held)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(aligned, DOCUMENT)


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """pair, count (links over all documents), best (whether its B id has no higher count)."""
    links = aligned.select(F.explode(F.arrays_zip("pairs", "counts")).alias("l"))
    pairs = write_table(links.groupBy(F.col("l.pairs").alias("pair")).agg(F.sum("l.counts").alias("count")), "pairs")
    highest = pairs.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("count").alias("highest"))
    return write_table(pairs.withColumn("b", F.col("pair") % size_b).join(highest, "b")
                       .select("pair", "count", (F.col("count") == F.col("highest")).alias("best")), "pair-counts")


def with_counts(aligned: DataFrame, pairs: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Written documents with n_best and count_sum over their links.

    Pairs with counts from a power of two on are broadcast, the lowest such that holds them
    to ``broadcast_pairs``; those below it, of which no one is frequent, are joined by shuffle.
    """
    level = F.floor(F.log2("count")).cast("int")
    sizes = {r["level"]: r["count"] for r in pairs.groupBy(level.alias("level")).count().collect()}  # 64 rows at most
    least, frequent = max(sizes, default=-1) + 1, 0
    for k in sorted(sizes, reverse=True):
        frequent += sizes[k]
        if frequent > broadcast_pairs:
            break
        least = k
    is_frequent = F.col("count") >= F.lit(2).cast("double") ** least
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "counts")).alias("l")).select(
        "row", F.col("l.pairs").alias("pair"), F.col("l.counts").alias("n"))
    found = links.join(F.broadcast(pairs.where(is_frequent)), "pair")
    sums = [F.sum(F.col("n") * F.col("count")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best")]
    out = found.groupBy("row").agg(*sums)
    if any(k < least for k in sizes):
        rest = links.join(F.broadcast(pairs.where(is_frequent).select("pair")), "pair", "left_anti").join(pairs.where(~is_frequent), "pair")
        out = out.union(rest.groupBy("row").agg(*sums)).groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    zero = F.lit(0).cast("long")
    return aligned.drop("pairs", "counts").join(out, "row", "left").withColumns(
        {c: F.coalesce(F.col(c).cast("long"), zero) for c in ("n_best", "count_sum")}).drop("row")


def align_tokenizers(docs: DataFrame, vocabulary: str = VOCABULARY, piece_vocabulary: str = PIECE_VOCABULARY,
                     broadcast_pairs: int = BROADCAST_PAIRS) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): per row of docs (doc_id, text) doc_id, n_a, n_b, n_groups, n_links,
    groups_sha256, n_best and count_sum; and the linked pairs with their counts.

    Every row is a document of its own, also when ids repeat or are null; texts are taken
    whole; an empty table gives empty results. Other columns are not read.
    """
    import public_tokenizers
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{piece_vocabulary}.model")).vocab_size()
    aligned = write_table(aligned_documents(docs, vocabulary, piece_vocabulary).withColumn("row", F.monotonically_increasing_id()), "aligned")
    pairs = pair_counts(aligned, size_b)
    return with_counts(aligned, pairs, broadcast_pairs), pairs


def op12_cross_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"))[0].select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
