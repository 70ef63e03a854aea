import hashlib
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from docnorm.llm import alignment as A
from docnorm.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def both():
    """(ids, bytes) of A and B of a whole text, by the plain calls of the two libraries."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    bpe.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in visible)}
    assert set(byte_of) == set(ByteLevel.alphabet())

    def a(text):
        ids = bpe.encode(" " + text, add_special_tokens=False).ids
        return ids, [bytes(byte_of[c] for c in bpe.id_to_token(i)) for i in ids]

    def b(text):
        ids = pieces.encode(text)
        return ids, [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else
                     pieces.id_to_piece(i).replace("▁", " ").encode() for i in ids]

    return a, b


def plain(text, both):
    """(A ids, B ids, groups, links) by byte ranges of whole texts; None: no tokens."""
    if not text:
        return None
    (a_ids, a_bytes), (b_ids, b_bytes) = both[0](text), both[1](text)
    if not b"".join(a_bytes) == b"".join(b_bytes) == b" " + text.encode():
        return None
    ends = lambda tokens: [sum(map(len, tokens[:i + 1])) for i in range(len(tokens))]
    a_ends, b_ends = (ends(t) if len(t) < 400 else list(__import__("itertools").accumulate(map(len, t))) for t in (a_bytes, b_bytes))
    shared = sorted(set(a_ends) & set(b_ends))
    groups, i, j = [], 0, 0
    for end in shared:
        k, m = a_ends.index(end, i) + 1, b_ends.index(end, j) + 1
        groups.append((a_ids[i:k], b_ids[j:m]))
        i, j = k, m
    links, j = [], 0
    for i, end in enumerate(a_ends):
        start = end - len(a_bytes[i])
        while b_ends[j] <= start:
            j += 1
        k = j
        while k < len(b_ids) and b_ends[k] - len(b_bytes[k]) < end:
            links.append((a_ids[i], b_ids[k]))
            k += 1
    return a_ids, b_ids, groups, links


def text_of(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def expected(docs, both):
    known = [(d, plain(t, both)) for d, t in docs]
    counts = Counter(link for _, p in known if p for link in p[3])
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(highest.get(b, 0), n)
    out = []
    for doc_id, p in known:
        if p is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        a_ids, b_ids, groups, links = p
        out.append((doc_id, len(a_ids), len(b_ids), len(groups), len(links), sum(counts[x] == highest[x[1]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(text_of(groups).encode()).hexdigest()))
    return out


ODD = ["", " ", "  ", "\n", "a", " a", "a ", "  a  b   c ", "a\n b\n\n  c\t d", "x  y   z　 w", "café naïve straße", "日本語 テキスト",
       "\U0001f600 ok \U0001f600\U0001f600", "a▁b c", "▁", "<s> </s> <unk> <0x41>", "<|endoftext|> x", "\x00 \x01", "é ́", "it's we'll 12345 !!!...",
       "word" * 300, "  " * 40 + "x", "a \x85 b\x85 c", "  a  b"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "the", " ", "  ", "\n", "\t", " ", "é", "　", "▁", "日", "<s>", "!", "12", "\x85", "\U0001f600"]), max_size=25).map("".join))
def test_windows_do_not_change_tokens(both, text):
    got = A.aligner().documents([b" " + text.encode()])
    want = plain(text, both) if text else None
    if text:
        assert [c.to_pylist()[0] for c in got[:4]] == ([len(want[0]), len(want[1]), len(want[2]), len(want[3])] if want else [0] * 4)
        assert got[4].to_pylist()[0] == (hashlib.sha256(text_of(want[2]).encode()).hexdigest() if want else "")


@pytest.mark.parametrize("broadcast_pairs", [0, 5, 60, 300])
def test_odd_texts_equal_the_plain_alignment(llm, both, broadcast_pairs):
    docs = [*enumerate(ODD), (None, None), (None, "without id"), (3, "a the"), (3, "a the")]
    df = llm.createDataFrame(docs, "doc_id long, text string")
    out, pairs = A.align_tokenizers(df, broadcast_pairs=broadcast_pairs)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    key = lambda t: tuple((x is None, x if x is not None else 0) for x in t)
    assert sorted((tuple(r) for r in out.select(*columns).collect()), key=key) == sorted(expected(docs, both), key=key)
    assert 60 < pairs.count() < 300  # so that the limits above leave all, most, some or none of the pairs to the shuffle


def test_query_equals_the_plain_alignment(llm, small, both):
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_cross_tokenizer_alignment"](llm, SMALL).collect()}
    want = expected([(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()], both)
    assert got == {w[0]: w for w in want}


def test_hard_documents(hard, none, both):
    out, _ = A.align_tokenizers(hard)
    assert out.count() == hard.count()
    want = expected([(r.doc_id, r.text) for r in hard.select("doc_id", "text").collect() if len(r.text or "") < 5000], both)
    got = [tuple(r) for r in out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").collect()]
    assert all(w[:5] + w[7:] in got for w in want)
    assert A.align_tokenizers(none)[0].collect() == []
