from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docnorm.llm import language, quality, top_k
from docnorm.llm.common import table

MEDIUM, LARGE = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def brute_top(rows, k=10):
    kept = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out, asked = [], set()
    for q, qv in kept:
        if q % 100 or q in asked:
            continue
        asked.add(q)
        found = sorted((-sum(a * b for a, b in zip(qv, v, strict=False)), i) for i, v in kept if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 4096])
def test_top_k_equals_brute_force(llm, block):
    rng = np.random.default_rng(block)
    rows = [(int(i), [float(x) for x in rng.normal(size=5).round(1)]) for i in range(-40, 230)]
    rows += [(300, [0.1, 0.2]), (301, None), (302, []), (303, [1.0, None]), (304, [float("nan")] * 5), (305, [float("inf")] * 5),
             (None, [1.0] * 5), (50, [9.0] * 5), (400, [0.0] * 5), (500, [float(x) for x in rng.normal(size=130) * 40])]
    vectors = llm.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, row int, block string")
    got = top_k.top_k(vectors, F.col("vec_id") % 100 == 0, block_rows=block, query_rows=2).collect()
    assert sorted(tuple(r) for r in got) == brute_top(rows)
    assert top_k.top_k(vectors.where("false"), F.col("vec_id") % 100 == 0).collect() == []
    assert top_k.top_k(vectors.where("vec_id = 100"), F.col("vec_id") % 100 == 0).collect() == []


@pytest.mark.parametrize("large", [1e5, 1e6, 1e12])
def test_top_k_of_large_components(llm, large):
    """Every finite vector takes part, and those whose scores could pass int64 are exact."""
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(x) for x in rng.normal(size=5).round(1)]) for i in range(-40, 230)]
    rows += [(301, [large, 0.1, 0.0, 0.0, 0.0]), (302, [0.3, -large, 0.0, 0.0, 0.0]), (303, [0.0, 0.0, 1.5, large / 3, 0.0])]
    rows += [(400, [large, 1.0, 0.0, 0.0, 2.0])] if large < 1e7 else []
    vectors = llm.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in top_k.top_k(vectors, F.col("vec_id") % 100 == 0, block_rows=100).collect())
    assert got == brute_top(rows) and {301, 302, 303} & {r[2] for r in got}


def test_scores_beyond_long_are_an_error(llm):
    vectors = llm.createDataFrame([(100, [1e9, 1.0]), (1, [1e9, 2.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="score beyond long"):
        top_k.top_k(vectors, F.col("vec_id") % 100 == 0).collect()


def test_slices_give_back_the_values():
    values = np.random.default_rng(2).integers(-900, 900, (20, 70))
    index = top_k.slices(values, 11)
    bits = np.unpackbits(index.transpose(0, 2, 1).copy().view(np.uint8).reshape(11, 20, -1), axis=2)[:, :, :70]
    assert ((bits * top_k.weights(11)[:, None, None]).sum(axis=0) == values).all()


def test_language_of_held_out_documents(llm):
    docs = table(llm, MEDIUM, "documents")
    out = language.op6_language_centroids(llm, MEDIUM).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r.held_out and r.lang]
    assert len(out) == docs.count() and np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in out) and {r.lang_pred for r in out} <= {r.lang for r in out} | {"und"}
    assert np.mean([r.rejected for r in out]) < 0.02


def test_language_of_hard_documents(hard, none):
    model = language.fit(hard)
    rows = language.predict(hard, model, [F.col("doc_id"), F.col("text")]).collect()
    letters = lambda t: t is not None and any(c.isalpha() for c in t)
    assert all((r.lang_pred in model.languages) if letters(r.text) else (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True) for r in rows)
    assert model.languages == ["de", "en", "fr"] and len(rows) == hard.count()
    assert language.drop_unidentified(hard).columns == hard.columns
    assert language.fit(none) is None and language.predict(none, None).collect() == []
    assert {r.lang_pred for r in language.predict(hard, None).collect()} == {"und"}
    assert language.drop_unidentified(none).collect() == []


def test_trigram_counts():
    one = language.trigram_counts(pa.array(["Abc  abc", None, "", "é", "É!", "12", "ab" * 50_000]))
    assert one.sum(axis=1).tolist() == [6, 0, 0, 2, 2, 0, 100_000]
    assert (one[3] == one[4]).all()
    joined = language.trigram_counts(pa.array(["x", "Abc  abc", "y"]).slice(1, 1))
    assert (joined[0] == one[0]).all()


def test_far_texts_are_rejected(llm):
    docs = table(llm, MEDIUM, "documents").where("lang IN ('en', 'de')")
    model = language.fit(docs)
    odd = llm.createDataFrame([(1, "qzx jqx vvkw zzq xqj wqk " * 20), (2, docs.where("lang = 'en' AND n_chars > 500").first().text)], "doc_id long, text string")
    assert {r.doc_id: r.rejected for r in language.predict(odd, model).collect()} == {1: True, 2: False}


def test_ordinal_regression_learns_graded_text():
    rng = np.random.default_rng(4)
    name = lambda i: "".join(chr(97 + (i // 26 ** j) % 26) for j in range(3))
    vocabulary = [["abcd"[g] + "word" + name(i) for i in range(20)] for g in range(4)]
    grades = rng.integers(0, 4, 600)
    texts = [" ".join(rng.choice(vocabulary[g] + ["noise" + name(i) for i in range(60)], 40)) for g in grades]
    csr = quality.packed(texts)
    model = quality.fit_rows(csr, grades, 4)
    tails = model.tails(csr)
    assert (np.diff(model.cuts) > 0).all() and (np.diff(tails, axis=1) <= 0).all()
    assert np.mean(np.abs(tails.sum(axis=1) - grades)) < 0.35


def test_likelihood_falls_along_the_gradient():
    """One small step along each parameter's slope lowers the loss."""
    rng = np.random.default_rng(8)
    texts, grades = [" ".join(rng.choice(list("abcdef"), 6)) for _ in range(60)], rng.integers(0, 3, 60)
    csr = quality.packed(texts)

    def loss(model):
        bounds = np.c_[np.ones(60), model.tails(csr), np.zeros(60)]
        share = 1 / np.bincount(grades, minlength=3)[grades] / 3
        return -(share * np.log(bounds[np.arange(60), grades] - bounds[np.arange(60), grades + 1])).sum()

    losses = [loss(quality.fit_rows(csr, grades, 3, steps=s, rare=0)) for s in (1, 10, 60)]
    assert losses[0] > losses[1] > losses[2]


def test_quality_of_held_out_documents(llm):
    docs, labels = table(llm, LARGE, "documents"), quality.ratings(table(llm, LARGE, "labels"))
    rated = docs.join(labels, "doc_id")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    model = quality.fit(docs, labels.where(~held))
    out = quality.grade(rated.where(held), model).join(labels, "doc_id").collect()
    mean = {g: np.mean([r.expected_grade for r in out if r.grade == g]) for g in (0, 1, 2)}
    assert mean[0] < mean[1] < mean[2]
    assert np.mean([r.kept for r in out if r.grade == 2]) > 0.9 and np.mean([r.kept for r in out if r.grade == 0]) < 0.1


def test_quality_sample_is_the_documented_one():
    readme = (Path(__file__).resolve().parents[2] / "README.md").read_text()
    assert f"`PER_GRADE = {quality.PER_GRADE}` a grade" in readme


def test_quality_of_hard_documents(llm, hard, none):
    labels = llm.createDataFrame([(4, 1, 0), (5, 0, 0), (6, 1, 1), (7, 1, None), (9, 1, 0), (10, 0, 1), (10, 1, 0), (None, 1, 1), (99, 1, 1)],
                                 "doc_id long, quality int, toxic int")
    rated = quality.ratings(labels)
    out = quality.grade(hard, quality.fit(hard, rated)).collect()
    assert len(out) == hard.count() and all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in out)
    assert quality.fit(hard, rated.where("false")) is None and quality.fit(none, rated) is None
    assert all(r.kept and r.expected_grade is None for r in quality.grade(hard, None).collect())
    assert quality.grade(none, None).collect() == []
