import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from docnorm.llm import packing, training_order
from docnorm.llm.tokens import encoder


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    from tokenizers import Tokenizer

    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: bpe.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_tokenizers_library(reference, small):
    odd = ["", "a", " ", "  a", "a  ", "a \n b\t\tc", " x\x1c y\x85z\xa0 ", "it's  we'll 12 345!! ...\n\n\nq", "x" * 3000,
           "日本語 é̀ ok", "\x00 \x1f a\x1e", "<|endoftext|> x<|endoftext|>", "a<|endoftext|>b", "<|endoftext", " " * 1_100_000 + "x\n", None]
    for text in odd + [r.text for r in small.select("text").collect()]:
        assert np.frombuffer(encoder().ids(text), "<u4").tolist() == reference(text)
        assert np.frombuffer(encoder(kind="H").ids(text), "<u2").tolist() == reference(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "b'", "s", "é", " ", "\t", "\n", "1.", "\x85", "\x1c", "<|endoftext|>", "<|"]), max_size=30).map("".join))
def test_ids_of_odd_texts(reference, text):
    assert np.frombuffer(encoder().ids(text), "<u4").tolist() == reference(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120), st.integers(1, 20))
def test_packing_is_a_packing(lengths, groups):
    lengths = np.array(lengths, np.int64)
    bins, offsets = packing.pack(lengths, 64, groups)
    places = defaultdict(list)
    for b, o, n in zip(bins, offsets, lengths, strict=True):
        places[b].append((o, n))
    for inside in places.values():
        inside.sort()
        assert [o for o, _ in inside] == [sum(n for _, n in inside[:i]) for i in range(len(inside))]
        assert sum(n for _, n in inside) <= 64


@pytest.mark.parametrize("low, high", [(1, 700), (1, 2049), (300, 1100)])
def test_packing_wastes_little(low, high):
    lengths = np.random.default_rng(5).integers(low, high, 5000)
    bins, _ = packing.pack(lengths)
    assert bins.max() + 1 <= 1.015 * -(-lengths.sum() // 2048) + 1


def test_best_pattern_fills_as_well_as_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(100):
        sizes = sorted(set(rng.integers(3, 40, 5).tolist()), reverse=True)
        counts, room = rng.integers(0, 3, len(sizes)).tolist(), int(rng.integers(5, 90))
        sums = {0}
        for s, c in zip(sizes, counts, strict=True):
            sums = {x + s * k for x in sums for k in range(c + 1) if x + s * k <= room}
        pattern = packing.best_pattern(sizes, counts, room)
        assert sum(sizes[g] * m for g, m in pattern.items()) == max(sums)
        assert all(m <= counts[g] for g, m in pattern.items())


def test_pieces_of_hard_documents(hard, none, reference):
    rows = packing.pack_documents(hard, shard_pieces=5).collect()
    want = []
    for r in hard.select("doc_id", "text").collect():
        ids = reference(r.text) + [0]
        want += [(r.doc_id, k, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())) for k, (s, n) in enumerate(packing.cut(len(ids), 2048))]
    key = lambda t: tuple(-1 if x is None else x for x in t)
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(want, key=key)
    filled = defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    assert all(sum(n for _, n in v) <= 2048 and sorted(v)[0][0] == 0 for v in filled.values())
    assert packing.pack_documents(none).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 64, 1000, 4097])
def test_permutation_is_a_bijection(n):
    slots = training_order.permute(np.arange(n), n, "key")
    assert sorted(slots.tolist()) == list(range(n))
    if n > 60:
        assert slots.tolist() != training_order.permute(np.arange(n), n, "other").tolist()


def test_shards_hold_every_token_in_slot_order(hard, none, reference, tmp_path):
    made = training_order.materialise(hard, str(tmp_path), "k", length=64, shard_sequences=50).collect()
    assert sorted(r.slot for r in made) == list(range(len(made)))
    records = list(training_order.read_slots(str(tmp_path), 0, len(made), 64, 50))
    resumed = list(training_order.read_slots(str(tmp_path), 77, 60, 64, 50))
    assert all((a == b).all() for a, b in zip(records[77:137], resumed, strict=True))
    for r in made:
        assert zlib.crc32(records[r.slot].tobytes()) == r.crc32
        assert r.shard == r.slot // 50 and r.byte_offset == r.slot % 50 * 128
    ids = sum((reference(r.text) + [0] for r in hard.select("text").collect()), [])
    held = np.concatenate([records[r.slot][:r.n_tokens] for r in made])
    assert sorted(held.tolist()) == sorted(ids)
    again = training_order.materialise(hard, str(tmp_path / "again"), "k", length=64, shard_sequences=50).collect()
    assert sorted(map(str, made)) == sorted(map(str, again))
    assert training_order.materialise(none, str(tmp_path / "none"), "k").collect() == []
    with pytest.raises(ValueError):
        training_order.materialise(hard, str(tmp_path), "other")


def test_a_repeated_task_leaves_the_shards_it_finds(llm, tmp_path):
    docs = llm.createDataFrame([(i, "some words " * i) for i in range(60)], "doc_id long, text string").coalesce(2)
    sequences = training_order.write_table(training_order.token_sequences(docs, 16), "sequences")
    n = sequences.count()
    write = lambda: training_order.write_shards(training_order.in_training_order(sequences, n, "k", 8), n, str(tmp_path), 16, 8).collect()
    first = sorted(write())
    before = {f.name: f.read_bytes() for f in tmp_path.iterdir()}
    assert sorted(write()) == first
    assert {f.name: f.read_bytes() for f in tmp_path.iterdir()} == before and len(before) == -(-n // 8)


def test_sequences_name_their_documents(llm, tmp_path):
    docs = llm.createDataFrame([(i, "token " * (i * 7 % 23)) for i in range(40)], "doc_id long, text string").coalesce(1)
    made = {r.slot: r for r in training_order.materialise(docs, str(tmp_path), "k", length=16).collect()}
    sequences = training_order.token_sequences(docs, 16).collect()
    lengths = [i * 7 % 23 + 1 for i in range(40)]
    ends = np.cumsum([len(encoder().ids("token " * (n - 1))) // 4 + 1 for n in lengths])
    begins = np.r_[0, ends[:-1]]
    for s in sequences:
        inside = [i for i in range(40) if begins[i] < s.nth * 16 + 16 and ends[i] > s.nth * 16]
        assert s.doc_ids == inside
    assert len(made) == len(sequences)
