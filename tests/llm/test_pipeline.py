from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from docnorm.llm import near_dup, queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(llm, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    out, want = queries.QUERIES[name](llm, SMALL), con.sql(queries.ORACLE[name])
    norm = lambda v: round(v, 6) if isinstance(v, float) else v
    at = sorted(range(len(want.columns)), key=lambda i: want.columns[i])
    assert sorted(out.columns) == sorted(want.columns)
    assert Counter(tuple(norm(r[c]) for c in sorted(out.columns)) for r in out.collect()) == Counter(
        tuple(norm(r[i]) for i in at) for r in want.fetchall())


def test_stages_on_hard_documents(llm, hard, none):
    """Each stage takes what the one before kept; all but the last return documents' columns."""
    docs, empty = hard, none
    for name, stage in corpus_pipeline.STAGES:
        docs, empty = stage(llm, docs, SMALL), stage(llm, empty, SMALL)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == hard.columns, name
        rows = docs.collect()
        assert rows and empty.collect() == [], name
        docs = llm.createDataFrame(rows, docs.schema)


def test_pipeline_leaves_no_copies(llm):
    docs = E.queries()["pipeline"](llm, SMALL)
    assert docs.count() > 0 and {"doc_id", "sequence_id", "offset", "length"} <= set(docs.columns)
    first = corpus_pipeline.remove_near_duplicates(llm, corpus_pipeline.table(llm, SMALL, "documents"), SMALL)
    texts = [near_dup.shingle_set(r.text, 5) for r in first.collect()]
    assert not any(a and b and 100 * len(a & b) >= 80 * len(a | b) for i, a in enumerate(texts) for b in texts[:i])


def test_every_operator_is_registered():
    names = E.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert set(queries.ORACLE) <= set(E.oracle_sql())
