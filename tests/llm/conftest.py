import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from docnorm.llm.common import share_package, table  # noqa: E402

SMALL = "/root/testdata/sf0.001"
#: documents with null, empty and white-space texts, repeated rows, one id with two texts,
#: null ids, languages and sources, a very long text, and columns named like internal ones
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
LONG = " ".join(f"{WORDS[i % 19]}{i % 1009}" for i in range(19_000))
PASSAGE = " ".join(f"passage{i}" for i in range(40))
HARD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, None), (4, "word", "de", "b"),
    (5, "Same text of a repeated row, and a few more words to be longer than nothing.", "en", "a"),
    (5, "Same text of a repeated row, and a few more words to be longer than nothing.", "en", "a"),
    (6, "first text of six", "en", None), (6, "second text of six, another one", "fr", None),
    (None, "a text without id", "en", "c"), (None, "another text without id", None, "c"),
    (7, LONG, "en", "hot"), (8, LONG[:-40], "en", "hot"), (9, "über straße naïve 日本語 \U0001f600 é " * 9, "de", "hot"),
    (10, "x " + PASSAGE + " y", "en", "b"), (11, "before " + PASSAGE + "\n\nafter it", "en", "b"), (12, "ab" * 400, "en", "b"),
    (13, "12345 !!! ...", "en", "b"), (14, "<|im_end|> </s> [INST]", "en", "b"),
]
DOCUMENTS = "doc_id long, text string, lang string, source string"
CLASHING = ["size", "h", "skey", "bucket", "node", "key", "part", "row", "kept", "rank", "label", "n_chars"]


@pytest.fixture(scope="session")
def llm(spark):
    share_package(spark)
    return spark


@pytest.fixture(scope="session")
def hard(llm):
    extra = ", ".join(f"{c} long" for c in CLASHING)
    rows = [r + tuple(len(r[1] or "") if c == "n_chars" else i for c in CLASHING) for i, r in enumerate(HARD)]
    return llm.createDataFrame(rows, f"{DOCUMENTS}, {extra}").coalesce(2)


@pytest.fixture(scope="session")
def none(hard):
    return hard.where("false")


@pytest.fixture(scope="session")
def small(llm):
    return table(llm, SMALL, "documents")
