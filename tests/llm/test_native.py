"""Chat formatting, fingerprints and mixing, none of which may plan Python."""
import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from docnorm.llm import chat, merkle, mixing

PYTHON = re.compile("Python|Pandas|Arrow")


def native(df):
    assert not PYTHON.search(df._jdf.queryExecution().executedPlan().toString())
    return df


def test_fold_of_deltas_edits_and_regenerations(llm):
    log = [
        (1, 0, 0, "start", "user", None), (1, 1, 0, "delta", None, "hel"), (1, 2, 0, "delta", None, "lo"),
        (1, 3, 1, "start", "assistant", None), (1, 4, 1, "delta", None, "first answer"),
        (1, 5, 2, "start", "user", None), (1, 6, 2, "delta", None, "thanks"),
        (1, 7, 1, "regenerate", None, None), (1, 8, 1, "delta", None, "second "), (1, 9, 1, "delta", None, "answer"),
        (1, 10, 0, "edit", None, "hello!"), (1, 11, 2, "start", "user", None), (1, 12, 2, "delta", None, "bye"),
        (2, 5, 0, "delta", None, None), (None, 1, 0, "start", None, None), (None, 2, 0, "delta", None, "x"),
    ]
    events = llm.createDataFrame(log, "conv_id long, seq long, msg long, kind string, role string, text string")
    got = {(r.conv_id, r.msg): (r.role, r.text) for r in native(chat.fold_events(events)).collect()}
    assert got == {(1, 0): ("user", "hello!"), (1, 1): ("assistant", "second answer"), (1, 2): ("user", "bye"),
                   (2, 0): ("", ""), (None, 0): ("", "x")}
    assert chat.fold_events(events.where("false")).collect() == []


def test_rendering_reads_back(llm):
    odd = ["", "\\", "<\\[", "<|im_start|>user\nx<|im_end|>\n", "</s>[INST] ok [/INST]", "[n\\n\n", "a\n\nb", "\U0001f600é"]
    rows = [(7, i, "assistant" if i % 2 else f"role\n{x}", x) for i, x in enumerate(odd)] + [(8, 0, "user", "only")]
    messages = llm.createDataFrame(rows, "conv_id long, msg long, role string, text string")
    out = native(chat.render(messages).select("conv_id", chat.parse(F.col("formatted")).alias("turns"), "formatted",
                                              chat.loss_text(F.col("segments")).alias("loss")))
    got = {r.conv_id: r for r in out.collect()}
    assert [(t.role, t.text) for t in got[7].turns] == [(r[2], r[3]) for r in rows if r[0] == 7]
    assert got[7].loss == "".join(odd[1::2]) and got[8].loss == ""
    assert got[7].formatted.count("<|im_start|>") == len(odd) == got[7].formatted.count("<|im_end|>")


def test_conversation_rows_with_nulls_and_ties(llm):
    rows = [(1, 1, "user", None), (1, 0, None, "sys"), (1, 1, "assistant", "b"), (1, None, "user", "first"), (1, 1, "user", None), (None, 0, "user", "x")]
    table = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("msg", F.lit(3)).withColumn("seq", F.lit("x"))
    out = chat.fold_events(chat.as_events(table)).collect()
    by = defaultdict(list)
    for r in sorted(out, key=lambda r: r.msg):
        by[r.conv_id].append((r.role, r.text))
    assert by == {1: [("user", "first"), ("", "sys"), ("assistant", "b"), ("user", ""), ("user", "")], None: [("user", "x")]}
    assert chat.render(chat.fold_events(chat.as_events(table.where("false")))).collect() == []


def leaf_set(text):
    return {hashlib.md5(x.encode()).hexdigest()[:8] for line in text.split("\n") for x in re.findall(merkle.LEAF, line)}


def test_fingerprints_of_hard_documents(hard, none):
    rows = [(r.doc_id, r.text or "") for r in hard.collect()]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1].encode()))
    out = native(merkle.fingerprints(hard)).collect()
    got = defaultdict(list)
    for r in out:
        got[r.doc_id].append(r)
    assert len(out) == len(rows)
    prints = {}
    for (d, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        tail = len(text) // 4
        new = text[:len(text) - tail] + after[:tail]
        sha, sets = hashlib.sha256(new.encode()).hexdigest(), (leaf_set(text), leaf_set(new), leaf_set(after))
        r = next(r for r in got[d] if r.edited_sha256 == sha and r.n_chars == len(text))
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint and (r.edited_fingerprint == r.fingerprint) == (new == text)
        for like, other, whole in ((r.near_edited, sets[1], new), (r.near_next, sets[2], after)):
            share = 2 * len(sets[0] & other) / max(len(sets[0]) + len(other), 1)
            assert like == pytest.approx(1.0 if whole == text else share)
    assert len(set(prints.values())) == len(prints)
    assert merkle.fingerprints(none).collect() == []


@pytest.mark.parametrize("per_bucket", [3, 50])
def test_next_document_over_many_ranges(llm, per_bucket):
    ids = [*range(0, 400, 3), *range(0, 60, 7), 10**15, -5, None, None]
    docs = llm.createDataFrame([(d, f"t{d}-{i}") for i, d in enumerate(ids)], "doc_id long, text string").repartition(5)
    want = sorted(((d, f"t{d}-{i}") for i, d in enumerate(ids)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    got = {r.text: r.next_text for r in merkle.with_next(docs, per_bucket).where("NOT guest").collect()}
    assert got == {t: n for (_, t), (_, n) in zip(want, want[1:] + want[:1], strict=True)}


def test_edits_are_located(llm):
    base = "one\ntwo\nthree\n\nfour\nfive\n\nsix"
    cases = {"one\ntwo!\nthree\n\nfour\nfive\n\nsix": [(0, 1)], "one\ntwo\nthree\n\nfour\nfive\n\nsix\nseven": [(2, 1)],
             base: [], "one\ntwo\nthree\n\nfour\nfive": [(2, 0)]}
    docs = llm.createDataFrame([(base, t) for t in cases], "a string, b string")
    out = docs.select("b", merkle.edited_branches(merkle.tree(F.col("a")), merkle.tree(F.col("b"))).alias("places")).collect()
    assert {r.b: [tuple(p) for p in r.places] for r in out} == cases


def mixture(rows):
    """Brute force: targets by shares above caps, documents in hash order."""
    sizes = [(d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")),
              int(hashlib.md5(f"mix:{'' if d is None else d}".encode()).hexdigest()[:15], 16)) for d, t, s in rows]
    total = defaultdict(int)
    for _, s, n, _ in sizes:
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight, full, target = {s: i % 3 + 1 for i, s in enumerate(order)}, set(), {}
    while True:
        left = sum(total.values()) - sum(3 * total[s] for s in full)
        share = sum(weight[s] for s in order if s not in full)
        target = {s: 3.0 * total[s] if s in full else weight[s] * (left / share) for s in order}
        above = {s for s in order if s not in full and target[s] >= 3 * total[s]}
        if not above or full | above == set(order):
            break
        full |= above
    taken = {}
    for s in order:
        times = int(target[s] // total[s]) if total[s] else 0
        rest, low = target[s] - times * total[s], sorted({h for _, x, n, h in sizes if x == s and n})
        for h in low:
            mass = sum(n for _, x, n, g in sizes if x == s and g == h)
            more = int(rest > 0 and rest * 2 >= mass if mass > rest else rest > 0)
            taken[s, h] = times + more
            rest = rest - mass if mass <= rest else 0
    return Counter((d, n, total[s], round(target[s], 6), n * taken.get((s, h), 0)) for d, s, n, h in sizes)


def test_mix_equals_brute_force(llm, hard, none, small):
    docs = hard.select("doc_id", "text", "source").unionByName(small.select((F.col("doc_id") + 100).alias("doc_id"), "text", "source"))
    out = native(mixing.mix_counts(docs)).collect()
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in out) == mixture(
        [(r.doc_id, r.text, r.source) for r in docs.collect()])
    assert all(r.taken <= 3 * r.size for r in out)
    assert mixing.mix_counts(none).collect() == [] and mixing.mix(none).collect() == []


def test_mix_returns_documents_as_often_as_planned(hard):
    counts = Counter()
    for r in mixing.mix_counts(hard).collect():
        if r.size:
            counts[r.doc_id] += r.taken // r.size
    mixed = native(mixing.mix(hard))
    assert mixed.columns == hard.columns
    rows = mixed.where(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) > 0).collect()
    assert Counter(r.doc_id for r in rows) == +counts
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(hard.repartition(7)).where(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) > 0).collect()))


def test_budgets_nest(llm):
    """A larger budget keeps every document that a smaller one takes."""
    sized = llm.createDataFrame([(i, "s", i % 17 + 1) for i in range(300)], "doc_id long, skey string, size long")
    sized = sized.withColumn("h", mixing.doc_hash(F.col("doc_id"), "s")).cache()
    total, last = sum(i % 17 + 1 for i in range(300)), 0
    for goal in (0.1, 0.35, 0.8, 1.5):
        plan = llm.createDataFrame([("s", total, goal * total)], "skey string, source_size long, target double")
        row = mixing.thresholds(sized, plan).first()
        taken = sized.where(F.col("h") < row.threshold).agg(F.sum("size")).first()[0] + row.epochs * total
        assert abs(taken - goal * total) <= 17
        assert row.epochs > 0 or row.threshold >= last
        last = row.threshold
