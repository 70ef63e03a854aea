import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from docnorm.llm import tiered_packing as P

def check_windows(lengths, tiers, windows):
    cover = defaultdict(list)
    for tier, pieces in windows:
        assert tier & (tier - 1) == 0 and tier <= tiers[0]
        assert sum(n for _, _, n in pieces) == tier
        for document, start, n in pieces:
            assert n > 0
            cover[document].append((start, n))
    for document, length in enumerate(lengths):
        at = 0
        for start, n in sorted(cover[document]):
            assert start == at
            at += n
        assert at == length

@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 200), max_size=80))
def test_windows_are_full_and_hold_every_token_once(lengths):
    tiers = (64, 32, 16, 8)
    check_windows(lengths, tiers, P.pack_tiers(lengths, tiers))

def test_documents_stay_whole_where_they_can():
    """Cuts come with windows, not with documents: at most one for each window."""
    lengths = np.random.default_rng(3).geometric(1 / 300, 4000).tolist()
    windows = P.pack_tiers(lengths)
    check_windows(lengths, P.TIERS, windows)
    pieces = sum(len(p) for _, p in windows)
    assert pieces <= len(lengths) + len(windows)
    assert {t for t, _ in windows} >= set(P.TIERS[:2])

def test_a_gap_is_filled_from_shorter_tiers():
    windows = P.pack_tiers([40, 20, 4, 30, 34], (64, 32))
    assert [(t, [n for _, _, n in p]) for t, p in windows] == [(64, [40, 20, 4]), (64, [34, 30])]

def plain(docs, ids_of):
    """Ids, crc and length of each document, by the tokenizer's plain call."""
    return sorted(((r.doc_id is None, r.doc_id or 0), ids_of(r.text or "") + [0]) for r in docs.select("doc_id", "text").collect())

@pytest.fixture(scope="module")
def ids_of():
    import public_tokenizers
    from tokenizers import Tokenizer

    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: bpe.encode(text, add_special_tokens=False).ids

@pytest.mark.parametrize("shard_tokens", [500, 1 << 22])
def test_pieces_of_hard_documents(hard, none, ids_of, shard_tokens):
    rows = P.pack_in_tiers(hard, shard_tokens=shard_tokens, step_tokens=4096).collect()
    texts = defaultdict(list)
    for r in hard.select("doc_id", "text").collect():
        texts[r.doc_id].append(ids_of(r.text or "") + [0])
    held = defaultdict(int)
    for r in rows:
        fits = [t for t in texts[r.doc_id] if len(t) == r.doc_tokens
                and zlib.crc32(np.array(t[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32]
        assert fits
        held[r.doc_id] += r.length
    assert held == {d: sum(map(len, t)) for d, t in texts.items()}
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    for inside in sequences.values():
        at = 0
        for r in sorted(inside, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == inside[0].tier and len({r.step for r in inside}) == 1
        assert inside[0].cost == sum(r.length ** 2 for r in inside)
    assert P.pack_in_tiers(none).collect() == []

def test_steps_hold_one_tier_and_cost_alike(llm, small):
    rows = P.pack_in_tiers(small, step_tokens=8192).where("offset = 0").collect()
    steps = defaultdict(list)
    for r in rows:
        steps[r.step].append(r)
    assert sorted(steps) == list(range(len(steps)))
    by_tier = defaultdict(list)
    for inside in steps.values():
        assert len({r.tier for r in inside}) == 1
        by_tier[inside[0].tier].append(inside)
    for tier, own in by_tier.items():
        assert max(map(len, own)) * tier <= max(8192, tier) and max(map(len, own)) - min(map(len, own)) <= 1
        costs = [np.mean([r.cost for r in inside]) for inside in own]
        assert max(costs) - min(costs) <= 0.1 * tier ** 2

def test_query_packs_all_documents_without_padding(llm, small, ids_of):
    from docnorm.llm.queries import QUERIES

    rows = QUERIES["op13_tiered_packing"](llm, "/root/testdata/sf0.001").collect()
    want = {r.doc_id: ids_of(r.text or "") + [0] for r in small.select("doc_id", "text").collect()}
    cover = defaultdict(list)
    for r in rows:
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
        cover[r.doc_id].append((r.start, r.length))
    assert set(cover) == set(want)
    for doc_id, spans in cover.items():
        ends = [0, *np.cumsum([n for _, n in sorted(spans)]).tolist()]
        assert [s for s, _ in sorted(spans)] == ends[:-1] and ends[-1] == len(want[doc_id])
    used = defaultdict(int)
    for r in rows:
        used[r.sequence_id] += r.length
    assert all(n & (n - 1) == 0 and n <= 1024 for n in used.values())
    assert sum(n < 128 for n in used.values()) <= 7 * 8
