import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st

from docnorm.llm import periodic_runs as R
from docnorm.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def brute_runs(words, least):
    """Every stretch with smallest period q that can't grow, by trying all periods."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if i > start and length >= max(least, 2 * q):
                smaller = any(words[start:start + length - d] == words[start + d:start + length] for d in range(1, q))
                if not smaller:
                    out.append((start, length, q))
            i += i == start
    return sorted(out, key=lambda r: (r[0], r[2]))


words = st.lists(st.integers(0, 2), max_size=50) | st.lists(st.integers(0, 1), max_size=70)
periodic = st.tuples(st.lists(st.integers(0, 9), min_size=1, max_size=9), st.integers(1, 8), st.lists(st.integers(0, 9), max_size=9)).map(
    lambda t: t[2] + t[0] * t[1] + t[0][:len(t[0]) // 2] + t[2])


@settings(max_examples=400, deadline=None)
@given(words | periodic, st.sampled_from([1, 2, 5, 12]))
def test_runs_are_those_of_brute_force(codes, least):
    assert R.find_runs(np.array(codes, np.int64), least) == brute_runs(codes, least)


@settings(max_examples=100, deadline=None)
@given(words)
def test_suffix_order_and_common_prefixes(codes):
    order = R.suffix_order(np.array(codes, np.int64)).tolist() if codes else []
    assert order == sorted(range(len(codes)), key=lambda i: codes[i:])
    if codes:
        for a, b, lcp in zip(order, order[1:], R.common_prefixes(codes, np.array(order))[1:], strict=False):
            assert codes[a:a + lcp] == codes[b:b + lcp] and codes[a + lcp:a + lcp + 1] != codes[b + lcp:b + lcp + 1]


def test_long_runs_and_deep_nesting():
    assert R.find_runs(np.zeros(30_000, np.int64)) == [(0, 30_000, 1)]
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    assert R.find_runs(np.array(b[:700])) == brute_runs(b[:700], 12)
    lines = [x for i in range(3000) for x in (*range(12), 100 + i % 7)]
    assert R.find_runs(np.array(lines)) == [(0, len(lines), 91)]


def planted(doc_id, text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(found)
    if doc_id is None or not n:
        return found
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        found = [found[a + (i - a) % p] if i >= a else w for i, w in enumerate(found)]
    return found


def expected(doc_id, text):
    found = planted(doc_id, text)
    codes = R.codes_of([w.encode() for w in found])
    runs = brute_runs(codes.tolist(), 12) if len(found) < 1500 else R.find_runs(codes)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else [None] * 4),
            digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(" ".join(w for i, w in enumerate(found) if i not in gone)))


def test_query_equals_brute_force(llm, small):
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](llm, SMALL).collect()}
    want = {r.doc_id: expected(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()}
    assert got == want
    assert sum(w[1] > 0 for w in want.values()) > 10


def test_hard_documents(hard, none):
    key = lambda t: tuple((x is None, x if x is not None else 0) for x in t)
    rows = R.collapse_runs(hard).collect()
    want = []
    for r in hard.select("doc_id", "text").collect():
        found = (r.text or "").encode().split()
        runs = R.find_runs(R.codes_of(found))
        keep = R.kept_words(len(found), runs)
        want.append((r.doc_id, len(found), len(runs), b" ".join(w for w, k in zip(found, keep, strict=True) if k).decode()))
    assert sorted(((r.doc_id, r.n_words, len(r.runs), r.collapsed) for r in rows), key=key) == sorted(want, key=key)
    assert any(w[2] for w in want)
    assert R.collapse_runs(none).collect() == []
    assert R.with_planted_runs(hard).count() == hard.count()


def test_planting_takes_whole_texts(llm):
    rows = [(i, " \n".join(f"w{j % (i + 1)}" for j in range(i % 40))) for i in range(400)] + [(None, "a b c"), (10, None), (3, " \t")]
    got = {r.doc_id: r.text for r in R.with_planted_runs(llm.createDataFrame(rows, "doc_id long, text string")).collect() if r.doc_id not in (None, 10, 3)}
    for doc_id, text in rows[:400]:
        if doc_id not in (10, 3):
            assert got[doc_id].split() == planted(doc_id, text)
