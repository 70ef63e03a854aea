"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's shingles are hashed once; the lowest values are its sketch. Documents with one
shingle set collapse to one node first, before any list is built. Inverted lists of the
lowest values then propose pairs: in each list a member meets the member behind it (sorted
by the values that follow), the one with the smallest id and the smallest id of the most
frequent continuation, so proposals grow with the members, never with their square. Lists
that are long are split by a second retained value. The overlap of the sketches filters
proposals, the full shingle sets of both texts verify them, and verified links are joined
to components by label propagation with pointer jumping.

Proposals only join most of a group cheaply. What is left is generated in full: all shingles
are put in one order, rarest first, and sets as similar as asked share a shingle
of their prefixes in that order. Every pair of a list of the prefix shingles that is not in
one component yet and passes the bounds by size and place is verified as well. Postings carry
one bit of the least hash of each of BINS bins, so that a pair is only made where these bits
differ no more than those of sets as similar as asked may. The members of a list longer than PAIRED are sent on with their sketches, in blocks of BLOCK members that
meet two by two in tasks of their own; there the sketches are compared before a pair is made.
"""
from __future__ import annotations

from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from docnorm.llm.common import discard, table, write_table

SKETCH, KEYS, LONG_LIST, SPLITS, PAIRED, BLOCK, BINS = 48, 10, 512, 3, 32, 2048, 128
#: Chance that a pair as similar as asked is missed by its bins.
MISSED = 1e-9
#: Rows of so many members of long lists are broadcast to the sets, not joined by shuffle.
FEW = 500_000
SIMILARITY = 80
#: Shingles are ranked in so many buckets; any ranks give the same links.
RARE_BUCKETS = 1 << 22


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A-Z) words; bytes.split cuts at exactly \\x20 and \\x09-\\x0D."""
    return text.encode().lower().split()


def shingle_set(text: str, size: int) -> set:
    """Distinct shingles; fewer words: the whole sequence as one; no words: empty."""
    words = words_of(text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size)), strict=False))


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """Ascending 64-bit hashes of the distinct shingles."""
    words = words_of(text)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < size:
        own, size = np.array([xxhash.xxh3_64_intdigest(b" ".join(words))] if words else [], np.uint64), 1
    mixed = np.zeros(max(len(own) - size + 1, 0), np.uint64)
    for j in range(size):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + own[j:j + len(mixed)]
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def frequencies(docs: DataFrame, size: int) -> np.ndarray:
    """Documents per bucket of shingle hashes: the order of shingles, not a filter."""
    def count(batches):
        total = np.zeros(RARE_BUCKETS, np.int32)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                sets = [shingle_hashes(t or "", size) for t in batch.column(0).slice(at, 1024).to_pylist()]
                bucket, n = np.unique(np.concatenate(sets) & np.uint64(RARE_BUCKETS - 1), return_counts=True)
                total[bucket] += n.astype(np.int32)
        seen = np.flatnonzero(total)
        for at in range(0, len(seen), 65536):
            part = seen[at:at + 65536]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["bucket", "n"])

    counted = docs.select("text").mapInArrow(count, "bucket int, n int")
    often = counted.groupBy("bucket").agg(F.least(F.sum("n"), F.lit(65535)).cast("int").alias("n")).where("n > 1").toArrow()
    out = np.zeros(RARE_BUCKETS, np.uint16)
    out[often.column("bucket").to_numpy()] = often.column("n").to_numpy()
    return out


def prefix(hashes: np.ndarray, often: np.ndarray, similarity: int) -> np.ndarray:
    """The rarest shingles, as many that a set as similar as asked holds one of them."""
    least = -(-similarity * len(hashes) // 100)
    order = np.argsort(often[hashes & np.uint64(RARE_BUCKETS - 1)], kind="stable")
    return hashes[order[:len(hashes) - least + 1]].astype(np.int64)


def bin_bits(hashes: np.ndarray) -> np.ndarray:
    """Two longs: a bit of the least of the ascending hashes in each of BINS bins (empty bin: 0)."""
    bits = np.zeros(BINS, bool)
    down = hashes[::-1]
    bits[down & np.uint64(BINS - 1)] = down & np.uint64(BINS)  # the last of a bin, its least hash, stays
    return np.packbits(bits).view(np.int64)


@lru_cache
def bits_apart(similarity: int) -> int:
    """How many bin bits of sets as similar as asked differ at most, but for a chance of MISSED.

    The least hash of a bin in either set is in both with a chance of their similarity; the
    bits of two different ones differ with a chance of one half.
    """
    differ = (100 - similarity) / 200
    chance = [comb(BINS, k) * differ ** k * (1 - differ) ** (BINS - k) for k in range(BINS + 1)]
    return next(k for k in range(BINS + 1) if sum(chance[k + 1:]) < MISSED)


def sketches(docs: DataFrame, size: int, often: np.ndarray, similarity: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, node (digest of the whole set), keys, sketch, bins, prefix."""

    def sketch(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                sets = [shingle_hashes(t or "", size) for t in some.column(2).to_pylist()]
                node = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([
                    some.column(0), some.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(node, pa.binary()),
                    pa.array([s[:KEYS].astype(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array([s[:SKETCH].astype(np.uint16).astype(np.int16) for s in sets], pa.list_(pa.int16())),
                    pa.array(list(map(bin_bits, sets)), pa.list_(pa.int64())),
                    pa.array([prefix(s, often, similarity) if len(s) else [] for s in sets], pa.list_(pa.int64()))],
                    names=["doc_id", "text_hash", "n_shingles", "node", "keys", "sketch", "bins", "prefix"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        sketch, "doc_id long, text_hash long, n_shingles long, node binary, keys array<long>, sketch array<smallint>, bins array<long>, prefix array<long>")


def candidate_pairs(nodes: DataFrame) -> DataFrame:
    """Table of the distinct proposed pairs (a, b, near) of nodes (node, id, keys, sketch).

    ``near`` is false for the pairs with a list's smallest id or hub, true for neighbours.
    """
    postings = nodes.select("node", "id", "sketch", F.posexplode("keys").alias("at", "key"))
    long_lists = write_table(postings.groupBy("key").count().where(F.col("count") > LONG_LIST).select(
        "key", F.lit(True).alias("long")), "long-lists")
    after = F.slice("sketch", F.col("at") + 2, 6)
    # a long list is cut by each of the next retained values: members that are alike share some
    split = F.when(F.col("long"), F.transform(F.slice("sketch", F.col("at") + 2, SPLITS), lambda v: v.cast("int")))
    cuts = F.coalesce(F.when(F.size(split) > 0, split), F.array(F.lit(-1 << 20)))
    lists = (postings.join(long_lists, "key", "left").withColumn("after", after)
             .select("key", F.explode(cuts).alias("cut"), "node", "id", "sketch", "after"))
    of_list, me = Window.partitionBy("key", "cut"), F.struct("node", "sketch")
    ranked = (lists
              .withColumn("behind", F.lag(me).over(of_list.orderBy("after", "id", "node")))
              .withColumn("same", F.count(F.lit(1)).over(Window.partitionBy("key", "cut", "after")))
              .withColumn("hub", F.min_by(me, F.struct(-F.col("same"), "id", "node")).over(of_list))
              .withColumn("least", F.min_by(me, F.struct("id", "node")).over(of_list)))
    alike = F.size(F.array_intersect("sketch", "other.sketch")) * 2 >= F.least(F.size(F.array_distinct("sketch")),
                                                                             F.size(F.array_distinct("other.sketch")))
    proposals = F.array(F.struct(F.lit(False).alias("near"), F.col("least").alias("other")),
                        F.struct(F.lit(False).alias("near"), F.col("hub").alias("other")),
                        F.struct(F.lit(True).alias("near"), F.col("behind").alias("other")))
    proposals = F.array_distinct(F.filter(proposals, lambda p: p["other"]["node"].isNotNull() & (p["other"]["node"] != F.col("node"))))
    pairs = (ranked.select("node", "sketch", F.explode(proposals).alias("p")).select("node", "sketch", "p.near", "p.other")
             .where(alike)
             .select(F.least("node", "other.node").alias("a"), F.greatest("node", "other.node").alias("b"), "near")
             .groupBy("a", "b").agg(F.min("near").alias("near")))
    pairs = write_table(pairs, "pairs")
    discard(nodes.sparkSession, long_lists)
    return pairs


def bounded(n: np.ndarray, at: np.ndarray, i, j, similarity: int) -> np.ndarray:
    """Whether sets i and j may be as similar as asked: they share at most what stands at and
    behind the place ``at`` of a shingle in the order of either."""
    return (100 + similarity) * np.minimum(n[i] - at[i], n[j] - at[j]) >= similarity * (n[i] + n[j])


def listed_pairs(key: np.ndarray, label: np.ndarray, nid: np.ndarray, n_at: np.ndarray, bins: np.ndarray, similarity: int):
    """Arrays (a, b) of the pairs of whole lists, sorted by key and label, that no bound rules out.

    Members of one label make no pair. ``n_at``: size and place of the list's shingle;
    ``bins``: two longs of bin bits a row.
    """
    apart = bits_apart(similarity)
    ends = lambda new: np.repeat(*(lambda b: (b[1:], np.diff(b)))(np.r_[np.flatnonzero(new), len(key)]))
    new_key, n, at = np.r_[True, key[1:] != key[:-1]], n_at >> 32, n_at & 0xFFFFFFFF
    end, j = ends(new_key), ends(new_key | np.r_[True, label[1:] != label[:-1]])
    i = np.arange(len(key))
    while True:
        open_ = j < end[i]
        i, j = i[open_], j[open_]
        if not len(i):
            return
        ok = np.flatnonzero(bounded(n, at, i, j, similarity))
        ok = ok[np.bitwise_count((bins[i[ok]] ^ bins[j[ok]]).view(np.uint64)).sum(axis=1) <= apart]
        if len(ok):
            a, b = nid[i[ok]], nid[j[ok]]
            yield np.minimum(a, b), np.maximum(a, b)
        j = j + 1


def grouped(batches, n_keys: int):
    """Rows of whole groups (Arrow columns as arrays), from batches sorted by the first columns."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch])
        keys = [table.column(k).to_numpy() for k in range(n_keys)]
        last = np.logical_and.reduce([k == k[-1] for k in keys])
        cut = len(last) - int(last.sum())
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def meet(postings: DataFrame, similarity: int) -> DataFrame:
    """(a, b, label, list, n_at, m) from postings (key, label, nid, n_at, bins_0, bins_1): the pairs a, b of
    short lists, and the members a of long ones (b null) with what blocks need to know."""
    kinds, names = (*[pa.int64()] * 6,), ["a", "b", "label", "list", "n_at", "m"]

    def out(*columns):
        return pa.RecordBatch.from_arrays([pa.array(c, k) if c is not None else pa.nulls(len(columns[0]), k)
                                           for c, k in zip(columns, kinds, strict=True)], names=names)

    def short(batches):
        for batch in batches:
            yield batch.filter(pa.array(batch.column("m").to_numpy() <= PAIRED))

    def met(batches):
        long = []

        def watched():
            for batch in batches:
                long.append(batch.filter(pa.array(batch.column("m").to_numpy() > PAIRED)))
                yield batch

        for table in grouped(short(watched()), 1):
            for key, label, nid, n_at, m in (b.columns[:5] for b in long if b.num_rows):
                yield out(nid, None, label, key, n_at, m)
            long.clear()
            bins = np.stack([table.column(c).to_numpy() for c in ("bins_0", "bins_1")], axis=1)
            for a, b in listed_pairs(*(table.column(c).to_numpy() for c in range(4)), bins, similarity):
                yield out(a, b, None, None, None, None)
        for key, label, nid, n_at, m in (b.columns[:5] for b in long if b.num_rows):
            yield out(nid, None, label, key, n_at, m)

    of_list = Window.partitionBy("key")
    several = (postings.withColumns({"least": F.min("label").over(of_list), "most": F.max("label").over(of_list), "m": F.count(F.lit(1)).over(of_list)})
               .where("least < most").select("key", "label", "nid", "n_at", "m", "bins_0", "bins_1").sortWithinPartitions("key", "label"))
    return several.mapInArrow(met, "a long, b long, label long, list long, n_at long, m long")


def block_pairs(members: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b) of the members of long lists that no bound rules out and whose sketches
    share a third of their values. members: nid, label, list, n_at, m, sketch.

    A list falls into blocks of about BLOCK members by a hash, and every two blocks, or a
    block with itself, meet in a group of their own.
    """
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    met = (members.withColumns({"blocks": blocks, "own": F.pmod(F.xxhash64("nid"), blocks).cast("int")})
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("list", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "label", "nid", "n_at", "sketch"))

    def pairs(batches):
        for table in grouped(batches, 3):
            columns = [table.column(c).to_numpy() for c in range(7)]
            new = np.flatnonzero(np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:3]])])
            sketches = [np.unique(np.array(s, np.int16).view(np.uint16)) for s in table.column("sketch").to_pylist()]
            for lo, hi in zip(new, np.r_[new[1:], len(columns[0])], strict=True):
                yield from of_group(*(c[lo:hi] for c in columns[1:]), sketches[lo:hi])

    def of_group(low, high, own, label, nid, n_at, sketches):
        n, at, sizes = n_at >> 32, n_at & 0xFFFFFFFF, np.array(list(map(len, sketches)))
        values, starts = np.concatenate(sketches), np.cumsum(sizes) - sizes
        held, found = np.zeros(1 << 16, bool), []
        for i in range(len(nid) - 1):
            j = np.arange(i + 1, len(nid))
            ok = (label[j] != label[i]) & bounded(n, at, i, j, similarity)
            if low[0] != high[0]:
                ok &= own[j] != own[i]
            if ok.any():
                held[sketches[i]] = True
                shared = np.add.reduceat(held[values[starts[i + 1]:]], starts[i + 1:] - starts[i + 1], dtype=np.int64)
                held[sketches[i]] = False
                found.append(np.stack([np.full(len(j), nid[i]), nid[j]])[:, ok & (shared * 3 >= np.minimum(sizes[i], sizes[j]))])
        if found:
            a, b = np.concatenate(found, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return met.repartition("list", "low", "high").sortWithinPartitions("list", "low", "high").mapInArrow(pairs, "a long, b long")


def remaining_pairs(nodes: DataFrame, labels: DataFrame, similarity: int) -> tuple[DataFrame, list[DataFrame]]:
    """Distinct pairs (a, b) of nodes not under one label that may be as similar as asked: all there are.

    nodes: node, n_shingles, sketch, bins, prefix. Sketches must share a third of their values
    and bins differ by ``bits_apart``; with a similarity of 0.8 either fails with a probability
    below 1e-9. The tables they are made of come with them.
    """
    own = F.xxhash64("node")
    under = labels.select("node", F.xxhash64("label.node").alias("label"))
    sets = nodes.join(under, "node", "left").select(own.alias("nid"), F.coalesce("label", own).alias("label"), "n_shingles", "bins", "prefix")
    postings = (sets.select("nid", "label", "n_shingles", F.col("bins")[0].alias("bins_0"), F.col("bins")[1].alias("bins_1"),
                            F.posexplode("prefix").alias("at", "key"))
                .select("key", "label", "nid", F.shiftleft(F.col("n_shingles"), 32).bitwiseOR(F.col("at").cast("long")).alias("n_at"), "bins_0", "bins_1"))
    met = write_table(meet(postings, similarity), "met")
    far = met.where("b IS NULL").select(F.col("a").alias("nid"), "label", "list", "n_at", "m")
    far = F.broadcast(far) if far.count() <= FEW else far
    near = write_table(block_pairs(nodes.select(own.alias("nid"), "sketch").join(far, "nid"), similarity), "met")
    pairs = met.where("b IS NOT NULL").select("a", "b").union(near).distinct()
    a, b = (nodes.select(own.alias(x), F.col("node").alias(f"node_{x}"), F.col("sketch").alias(f"sketch_{x}")) for x in "ab")
    alike = F.size(F.array_intersect("sketch_a", "sketch_b")) * 3 >= F.least(F.size(F.array_distinct("sketch_a")), F.size(F.array_distinct("sketch_b")))
    return (pairs.join(a, "a").join(b, "b").where(alike)
            .select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))), [met, near]


def verified(pairs: DataFrame, texts: DataFrame, size: int, similarity: int = SIMILARITY) -> DataFrame:
    """Pairs (a, b) whose full shingle sets have at least ``similarity`` per cent in common."""

    def exact(batches):
        kept_a, set_a = None, None
        for batch in batches:
            ok = []
            for a, left, right in zip(*(batch.column(c).to_pylist() for c in ("a", "left", "right")), strict=True):
                if a != kept_a:
                    kept_a, set_a = a, shingle_set(left, size)
                set_b = shingle_set(right, size)
                both = len(set_a & set_b)
                ok.append(100 * both >= similarity * (len(set_a) + len(set_b) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("right"))
    return (pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "left", "right")
            .mapInArrow(exact, "a binary, b binary"))


def components(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, label) for every linked node; label is the least (id, node) of its component."""
    spark = links.sparkSession
    edges = write_table(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    own = F.struct(F.col("id").isNull().alias("no_id"), "id", "node")
    labels = write_table(edges.select(F.col("a").alias("node")).distinct().join(nodes.select("node", "id"), "node")
                         .select("node", own.alias("label")), "labels")
    before = labels
    while True:
        offered = (edges.join(labels, edges["a"] == labels["node"]).groupBy("b").agg(F.min("label").alias("offer"))
                   .withColumnRenamed("b", "node"))
        nearer = labels.join(offered, "node").select("node", F.least("label", "offer").alias("new"), "label")
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("beyond"))
        nxt = write_table(nearer.join(jump, F.col("new.node") == F.col("via"))
                          .select("node", F.least("new", "beyond").alias("label"), (F.col("label") != F.least("new", "beyond")).alias("moved")), "labels")
        done = nxt.where("moved").isEmpty()
        discard(spark, before)
        before, labels = nxt, nxt.select("node", "label")
        if done:
            discard(spark, edges)
            return labels


def near_duplicates(docs: DataFrame, size: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept, first per row of docs (doc_id, text).

    ``kept``: the row's id is its component's smallest. ``first`` marks the row's text as the
    one its component keeps. Documents without words (null text too) are linked with nothing
    and keep their own id. Rows that repeat an id are rows of their own; a null id counts as
    greater than every id. An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    rows = write_table(sketches(docs, size, frequencies(docs, size), similarity), "sketches")
    discard(spark)
    known = rows.where("node IS NOT NULL")
    ids = known.groupBy("node").agg(F.min("doc_id").alias("id"))
    one = known.groupBy("node", "keys", "sketch").agg(F.min("doc_id").alias("id"))
    nodes = write_table(one, "nodes")
    pairs = candidate_pairs(nodes)

    def texts_of(pairs):
        """The text of a node: that of the row with its smallest id."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(ids, "node")
        at = known.select("node", F.col("doc_id").alias("at_id"), "text_hash")
        places = (wanted.join(at, "node").where(F.col("id").eqNullSafe(F.col("at_id")))
                  .groupBy("node").agg(F.min(F.struct("at_id", "text_hash")).alias("p")).select("node", "p.at_id", "p.text_hash"))
        text = docs.select(F.col("doc_id").cast("long").alias("own_id"), F.xxhash64("text").alias("own_hash"), "text")
        found = text.join(places, F.col("own_id").eqNullSafe(F.col("at_id")) & (F.col("own_hash") == F.col("text_hash")))
        return write_table(found.select("node", "text").dropDuplicates(["node"]), "texts")

    texts = texts_of(pairs)
    links = write_table(verified(pairs.where(~F.col("near")), texts, size, similarity), "links")
    labels = components(links, nodes)
    a, b = (labels.select(F.col("node").alias(x), F.col("label.node").alias(f"of_{x}")) for x in "ab")
    open_pairs = (pairs.where("near").join(a, "a", "left").join(b, "b", "left")
                  .where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b"))
    more = write_table(verified(open_pairs, texts, size, similarity), "links")
    if not more.isEmpty():
        links = links.union(more)
        labels = components(links, nodes)
    whole = known.select("node", "n_shingles", "sketch", "bins", "prefix").dropDuplicates(["node"])
    discard(spark, texts)
    rest, made = remaining_pairs(whole, labels, similarity)
    rest = write_table(rest.join(pairs, ["a", "b"], "left_anti"), "pairs")
    discard(spark, *made)
    texts = texts_of(rest)
    discard(spark)
    more = write_table(verified(rest, texts, size, similarity), "links")
    discard(spark, texts, pairs, rest)
    if not more.isEmpty():
        labels = components(links.union(more), nodes)
    named = nodes.select("node", "id").join(labels, "node", "left").select(
        "node", F.when(F.col("label").isNotNull(), F.col("label.id")).otherwise(F.col("id")).alias("component"),
        F.coalesce(F.col("label.node"), F.col("node")).alias("lead"))
    out = rows.select("doc_id", "text_hash", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"),
                      (F.col("node").isNull() | (F.col("node") == F.col("lead"))).alias("first"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """Rows of ``docs``, one of each component (the smallest id); repeated rows stay once."""
    kept = near_duplicates(docs, size, similarity).where("kept AND first").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    row = docs.select(F.col("doc_id").cast("long").alias("_own_id"), F.xxhash64("text").alias("_own_hash"),
                      F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return (row.join(kept, F.col("_own_id").eqNullSafe(F.col("_id")) & (F.col("_own_hash") == F.col("_hash")))
            .dropDuplicates(["_own_id", "_own_hash"]).select("_row.*"))


def op7_minhash_near_dup(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"), size=2)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


# DuckDB: exact. Pairs are joined on the shingles of each set's prefix, rarest first.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN []
                          WHEN len(words) = 1 THEN words
                          ELSE list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS grams FROM w),
g AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
f AS (SELECT *, count(*) OVER (PARTITION BY gram) AS df FROM g),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY df, gram) AS nth FROM f)
      WHERE nth <= n - ceil(n * 0.8) + 1),
c AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM p x JOIN p y ON x.gram = y.gram AND x.doc_id < y.doc_id
      WHERE x.n * 100 >= y.n * 80 AND y.n * 100 >= x.n * 80),
e AS (SELECT a, b FROM c JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b
      WHERE 100 * len(list_intersect(x.grams, y.grams))
            >= 80 * (len(x.grams) + len(y.grams) - len(list_intersect(x.grams, y.grams)))),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS v, doc_id AS reach FROM s UNION SELECT r.v, l.b FROM r JOIN l ON l.a = r.reach),
k AS (SELECT v, min(reach) AS component_id FROM r GROUP BY v)
SELECT s.doc_id, len(s.grams)::BIGINT AS n_shingles, k.component_id, s.doc_id = k.component_id AS kept
FROM s JOIN k ON k.v = s.doc_id
"""
