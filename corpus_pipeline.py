"""Corpus pipeline: language ID, near-duplicates, repeated passages, source mix, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result
as a table of the shared checkpoint folder and gives it to the next. All stages but the last
return the columns of documents.

SQL can't express the hashed centroids of the first stage; the tests compare every stage
with a plain version on a small table.
"""
from __future__ import annotations

from docnorm.llm.common import share_package, table, write_table
from docnorm.llm.language import drop_unidentified
from docnorm.llm.mixing import mix
from docnorm.llm.near_dup import drop_near_duplicates
from docnorm.llm.packing import pack_documents
from docnorm.llm.suffix_dedup import drop_repeats


def identify_language(spark, docs, sf_dir):
    """Documents without letters or far from every learned language go."""
    share_package(spark)
    return drop_unidentified(docs)


def remove_near_duplicates(spark, docs, sf_dir):
    """Of documents linked by five-word shingles at a similarity of 0.8, the smallest id stays."""
    share_package(spark)
    return drop_near_duplicates(docs, size=5)


def remove_repeated_passages(spark, docs, sf_dir):
    """Later copies of passages of 200 bytes and more go, the first stays."""
    share_package(spark)
    return drop_repeats(docs, keep_first=True)


def mix_sources(spark, docs, sf_dir):
    """Documents as often as the mix takes them; a document taken twice is there twice."""
    share_package(spark)
    return mix(docs)


def pack_sequences(spark, docs, sf_dir):
    """Token pieces placed in sequences of at most 2048 tokens."""
    share_package(spark)
    return pack_documents(docs)


STAGES = [
    ("language ID", identify_language),
    ("near-duplicates", remove_near_duplicates),
    ("repeated passages", remove_repeated_passages),
    ("source mix", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
