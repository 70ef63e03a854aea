"""Token ids of whole texts by a public byte-level BPE, for use inside Arrow tasks.

The ids equal those of the ``tokenizers`` file of the vocabulary (the tests compare them);
``tiktoken`` finds them with the same ranks, several times faster. The strings of special
tokens in a text are these tokens, as the file says, or ordinary text on request.
"""
from __future__ import annotations

import base64
import json
import re
from array import array
from functools import cached_property, lru_cache

VOCABULARY = "byte_bpe_50k"
#: ``tiktoken`` fails on very long runs of white space; texts with such go to ``tokenizers``.
LONG_RUN = re.compile(r"\s{10000}")


class Encoder:
    """Ids as native (little-endian) bytes of array type ``kind``: "I" four bytes, "H" two."""

    def __init__(self, vocabulary: str, kind: str):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        with open(public_tokenizers.path(f"{vocabulary}.json"), encoding="utf-8") as file:
            self.special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
        self.tokens = {i: t for t, i in ranks.items()}
        self.bpe = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.kind, self.file = kind, public_tokenizers.path(f"{vocabulary}.json")
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def plain(self, text: str) -> bytes:
        """Ids of a text in which special tokens' strings are ordinary text."""
        if len(text) >= 10_000 and LONG_RUN.search(text):
            return array(self.kind, self.slow.encode(text, add_special_tokens=False).ids).tobytes()
        return array(self.kind, self.bpe.encode_ordinary(text)).tobytes()

    @cached_property
    def slow(self):
        from tokenizers import Tokenizer

        out = Tokenizer.from_file(self.file)
        out.encode_special_tokens = True
        return out

    def ids(self, text: str | None) -> bytes:
        """Ids of a text (null: none), special tokens' strings as these tokens."""
        if not text:
            return b""
        if self.cut is None or not any(s in text for s in self.special):
            return self.plain(text)
        parts = self.cut.split(text)  # every other part is a special token's string
        return b"".join(array(self.kind, [self.special[p]]).tobytes() if i % 2 else self.plain(p) for i, p in enumerate(parts))


@lru_cache(maxsize=2)
def encoder(vocabulary: str = VOCABULARY, kind: str = "I") -> Encoder:
    """The worker's encoder; its vocabulary is kept between tasks."""
    return Encoder(vocabulary, kind)
