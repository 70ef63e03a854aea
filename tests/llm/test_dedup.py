import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from docnorm.llm import near_dup, suffix_dedup


def covered(texts, length, keep_first):
    """Brute force: per text, the bytes under a window that starts elsewhere (earlier)."""
    seen = Counter(t[s:s + length] for t in texts for s in range(len(t) - length + 1))
    met, out = set(), []
    for t in texts:
        mask = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            window = t[s:s + length]
            if window in met if keep_first else seen[window] > 1:
                mask[s:s + length] = True
            met.add(window)
        out.append(mask)
    return out


def digest(text, mask):
    kept = bytes(np.frombuffer(text, np.uint8)[~mask])
    return len(text), int(mask.sum()), len(suffix_dedup.runs(mask)), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("keep_first", [False, True])
def test_repeats_of_hard_documents(hard, none, small, keep_first):
    docs = hard.select("doc_id", "text").unionByName(small.where("doc_id < 60").select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
    if keep_first:  # rows with one id and text can't be told apart
        docs, rows = docs.where("doc_id <> 5 AND doc_id <> 6"), [r for r in rows if r[0] not in (5, 6, None)]
    want = Counter((d, *digest(t, m)) for (d, t), m in zip(rows, covered([t for _, t in rows], 200, keep_first), strict=True))
    assert Counter(tuple(r) for r in suffix_dedup.digests(docs, keep_first=keep_first).collect()) == want
    assert suffix_dedup.digests(none).collect() == []


def test_hot_anchors_and_short_matches(llm, monkeypatch):
    """Anchors over HOT_PLACES are split; the result is the same."""
    rng = np.random.default_rng(3)
    word = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    shared = [word(130), word(61), word(45)]
    rows = [(i, word(30) + shared[i % 3] + word(40) + (shared[0] if i % 5 == 0 else "")) for i in range(60)]
    docs = llm.createDataFrame(rows, "doc_id long, text string").coalesce(3)
    want = Counter((d, *digest(t.encode(), m)) for (d, t), m in zip(rows, covered([t.encode() for _, t in rows], 40, False), strict=True))
    for hot in (512, 3):
        monkeypatch.setattr(suffix_dedup, "HOT_PLACES", hot)
        monkeypatch.setattr(suffix_dedup, "GRAM", 20)
        assert Counter(tuple(r) for r in suffix_dedup.digests(docs, length=40).collect()) == want


@settings(max_examples=80, deadline=None)
@given(st.lists(st.binary(max_size=60).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=6), st.integers(2, 20))
def test_windows_of_equal_bytes_choose_alike(texts, length):
    """Every window has an anchor, and equal windows an equal gram at an equal distance."""
    gram = max(1, length // 2)
    ends = np.repeat(np.cumsum([len(t) for t in texts]), [len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    h, place, first, last = suffix_dedup.anchors(data, ends, length, gram)
    chosen = {}
    for g, p, a, b in zip(h, place, first, last, strict=True):
        for s in range(a, b + 1):
            assert chosen.setdefault(data[s:s + length].tobytes(), (g, p - s)) == (g, p - s)
    assert sum(b - a + 1 for a, b in zip(first, last, strict=True)) == sum(max(len(t) - length + 1, 0) for t in texts)


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=80).map(lambda b: bytes(x % 3 for x in b)), st.integers(1, 30))
def test_prefix_ranks_order_suffixes(data, length):
    rank = suffix_dedup.prefix_ranks(np.frombuffer(data, np.uint8), length).tolist()
    cut = [data[i:i + length] for i in range(len(data) - length + 1)]
    order = sorted(set(cut))
    ranks = sorted(set(rank[:len(cut)]))
    assert [order.index(c) for c in cut] == [ranks.index(r) for r in rank[:len(cut)]]


def test_stage_keeps_the_first_copy_and_all_columns(hard, none):
    out = suffix_dedup.drop_repeats(hard)
    assert out.columns == hard.columns
    rows = {r.doc_id: r for r in out.where("doc_id > 6").collect()}
    before = {r.doc_id: r for r in hard.where("doc_id > 6").collect()}
    assert rows[10].text == before[10].text and rows[7].text == before[7].text
    assert "passage20" not in rows[11].text and rows[11].text.endswith("after it") and rows[11].n_chars == len(rows[11].text)
    assert 8 not in rows  # a shorter copy of the long text: nothing is left
    assert rows[9].text.encode().decode() == rows[9].text
    assert suffix_dedup.drop_repeats(none).collect() == []


def exact_components(rows, size):
    sets = [near_dup.shingle_set(t or "", size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def edited(rng, words, share):
    return [f"new{rng.integers(1 << 30)}" if rng.random() < share else w for w in words]


@pytest.mark.parametrize("size, paired", [(2, 32), (5, 1)])
def test_components_equal_brute_force(llm, hard, small, monkeypatch, size, paired):
    monkeypatch.setattr(near_dup, "PAIRED", paired)
    rng = np.random.default_rng(size)
    base = [f"w{i}" for i in rng.integers(0, 400, 300)]
    near = [(5000 + i, " ".join(edited(rng, base, rng.choice([0, 0.01, 0.03, 0.06, 0.1])))) for i in range(60)]
    chain = [(6000 + i, " ".join(f"c{j}" for j in range(i * 6, i * 6 + 90))) for i in range(12)]
    few = [(7000, "one two three"), (7001, "ONE two\tthree"), (7002, "one"), (7003, "One"), (7004, "two one three")]
    more = llm.createDataFrame(near + chain + few, "doc_id long, text string")
    docs = hard.select("doc_id", "text").unionByName(small.select((F.col("doc_id") + 100).alias("doc_id"), "text")).unionByName(more)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = near_dup.near_duplicates(docs, size).collect()
    key = lambda t: tuple(-1 if x is None else x for x in t)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=key) == sorted(exact_components(rows, size), key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_long_lists_are_split(llm, monkeypatch):
    rng = np.random.default_rng(9)
    common = [f"common{i}" for i in range(30)]
    rows = [(i, " ".join(common + [f"x{rng.integers(1 << 30)}" for _ in range(60)])) for i in range(40)]
    rows += [(100 + i, " ".join(edited(rng, rows[i][1].split(), 0.03))) for i in range(10)]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(near_dup, "LONG_LIST", 8)
    out = near_dup.near_duplicates(docs, 2).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == sorted(exact_components(rows, 2))


def test_bin_bits_of_similar_sets_stay_close():
    """Sets at exactly 0.8 differ by no more than allowed, other sets by more."""
    rng, apart = np.random.default_rng(3), near_dup.bits_apart(80)

    def differ(shared, own):
        h = np.unique(rng.integers(0, 1 << 64, shared + 2 * own, np.uint64))
        h = rng.permutation(h)
        a, b = np.sort(h[:shared + own]), np.sort(np.r_[h[:shared], h[shared + own:]])
        return int(np.bitwise_count((near_dup.bin_bits(a) ^ near_dup.bin_bits(b)).view(np.uint64)).sum())

    for shared, own in ((8, 1), (80, 10), (800, 100), (8000, 1000)):
        assert max(differ(shared, own) for _ in range(400)) <= apart
    assert min(differ(0, 300) for _ in range(400)) > apart
    assert not near_dup.bin_bits(np.array([], np.uint64)).any()


def test_one_document_of_each_group_stays(hard, none):
    out = near_dup.drop_near_duplicates(hard)
    assert out.columns == hard.columns
    ids = Counter(r.doc_id for r in out.collect())
    assert ids[5] == 1 and ids[6] == 2 and ids[7] == 1 and 8 not in ids and ids[None] == 2
    assert ids[1] == ids[2] == ids[3] == 1  # without words: linked with nothing
    assert near_dup.drop_near_duplicates(none).collect() == [] and near_dup.near_duplicates(none).collect() == []


@pytest.mark.parametrize("paired", [32, 1])
def test_few_links_within_dense_families(llm, monkeypatch, paired):
    """Templates: pages share about 0.7 of their shingles pairwise, a few pairs over 0.8."""
    monkeypatch.setattr(near_dup, "PAIRED", paired)
    rng = np.random.default_rng(21)
    rows = []
    for family in range(2):
        base = [f"t{family}w{i}" for i in range(240)]
        pages = [edited(rng, base, 0.09) for _ in range(200)]
        pages += [edited(rng, pages[i], 0.045) for i in range(0, 200, 3)]
        rows += [(family * 1000 + int(i), " ".join(pages[p])) for i, p in enumerate(rng.permutation(len(pages)))]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    out = near_dup.near_duplicates(docs, 2).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == sorted(exact_components(rows, 2))


@pytest.mark.parametrize("paired", [0, 2])
def test_long_lists_meet_in_blocks(llm, monkeypatch, paired):
    """Without proposals, all links come from the lists; long ones fall into many blocks."""
    monkeypatch.setattr(near_dup, "PAIRED", paired)
    monkeypatch.setattr(near_dup, "BLOCK", 7)
    rng = np.random.default_rng(4)
    base = [f"b{i}" for i in range(60)]
    rows = [(i, " ".join(edited(rng, base, rng.choice([0.02, 0.1])))) for i in range(120)]
    rows += [(200 + i, " ".join(f"s{j}" for j in range(2 + i % 7))) for i in range(14)]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    sets = near_dup.sketches(docs, 1, near_dup.frequencies(docs, 1), 80).where("node IS NOT NULL").dropDuplicates(["node"])
    none = llm.createDataFrame([], "node binary, label struct<node:binary>")
    pairs, _ = near_dup.remaining_pairs(sets, none, 80)
    got = {frozenset((bytes(r.a), bytes(r.b))) for r in pairs.collect()}
    by_node = {bytes(r.node): near_dup.shingle_set(dict(rows)[r.doc_id], 1) for r in sets.collect()}
    for a in by_node:
        for b in by_node:
            if a < b and 100 * len(by_node[a] & by_node[b]) >= 80 * len(by_node[a] | by_node[b]):
                assert frozenset((a, b)) in got


def test_texts_without_id_have_keys_of_their_own(llm):
    """So many texts that some share the shorter hash alone."""
    docs = llm.range(300_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    keys = suffix_dedup.keyed(docs).select(*suffix_dedup.KEY)
    assert keys.distinct().count() == 300_000 and keys.select(suffix_dedup.KEY[1]).distinct().count() < 300_000


def test_shingles_are_counted_over_all_documents(spark):
    docs = spark.range(40_000).select(F.format_string("a b c%d", "id").alias("text"))
    often = near_dup.frequencies(docs, 2)
    shared = near_dup.shingle_hashes("a b", 2)
    assert often[shared & np.uint64(near_dup.RARE_BUCKETS - 1)].tolist() == [40_000]
