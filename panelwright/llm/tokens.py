"""Token counts by a whole-token shortcut.

A byte-level BPE vocabulary holds many strings that the library, given the string alone, encodes as one token. They are
proven on the driver, one by one, and shipped as a table. In the tasks a text is cut into pre-tokens; those in the table
count one each, and only the others go through the merges.
"""

from __future__ import annotations

import json
import os
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import put, python_tasks

#: Merged pre-tokens that a worker remembers, and the longest one (characters) worth remembering.
REMEMBERED, LONGEST = 200_000, 64
# Fixed value: how byte-level vocabularies of this family cut a text before the merges.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The same for texts of these characters alone, where the classes of Python's faster ``re`` agree with it.
PLAIN = "\\x00-\\x1b\\x20-\\xb1\\xb4-\\xb8\\xba\\xbb\\xbf-\\u024f"
PLAIN_PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class TokenTable:
    """What the tasks need; bounded by the vocabulary.

    ``whole`` are the proven strings, ``special`` the added tokens that the library finds inside texts, ``unsure`` a
    pattern of characters whose class depends on the Unicode version: texts with one go to the library whole.
    """

    model: str
    whole: frozenset[str]
    special: tuple[str, ...]
    unsure: str


def token_table(path: str) -> TokenTable:
    """Read a ``tokenizers`` file and prove its whole tokens.

    A string is proven if the pattern takes it as one pre-token and the library encodes it as exactly one token.
    Files with a normaliser or another pre-tokenizer are refused, since the pattern would not hold for them.
    """
    import regex
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        model = f.read()
    spec = json.loads(model)
    cutter = spec.get("pre_tokenizer") or {}
    plain = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
    if spec.get("normalizer") or not plain or any(
        t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]
    ):
        raise ValueError(f"{path}: not a plain byte-level vocabulary")
    library = Tokenizer.from_str(model)
    special = tuple(sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True))
    cut = regex.compile(PRE_TOKEN)
    texts = [library.decode([i], skip_special_tokens=False) for i in range(library.get_vocab_size())]
    texts = [t for t in texts if t and "�" not in t and t not in special and cut.fullmatch(t)]
    found = library.encode_batch(texts, add_special_tokens=False)
    whole = frozenset(t for t, e in zip(texts, found) if len(e.ids) == 1)
    return TokenTable(model, whole, special, _unassigned())


def _unassigned() -> str:
    """Character class of the code points that this Python's Unicode tables do not know: libraries differ on them."""
    ranges: list[list[int]] = []
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c)) == "Cn":
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]"


class _Sizes(dict):
    """Tokens of a pre-token: 1 for the proven ones, else merged once and remembered up to a bound."""

    def __init__(self, table: TokenTable):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(table.model)
        self.whole = dict.fromkeys(table.whole, 1)
        super().__init__(self.whole)

    def merged(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def __missing__(self, piece: str) -> int:
        n = self.merged(piece)
        if len(piece) <= LONGEST:
            if len(self) >= len(self.whole) + REMEMBERED:
                self.clear()
                self.update(self.whole)
            self[piece] = n
        return n


class Counter:
    """Token counts of texts in one worker."""

    def __init__(self, table: TokenTable):
        import re

        import regex

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.sizes = _Sizes(table)
        self.other = re.compile(f"[^{PLAIN}]").search
        self.cut_plain, self.cut = re.compile(PLAIN_PRE_TOKEN).findall, regex.compile(PRE_TOKEN).findall
        self.unsure = re.compile(table.unsure).search
        self.special = re.compile("|".join(map(re.escape, table.special))) if table.special else None

    def count(self, text: str) -> int:
        if not self.other(text):
            cut = self.cut_plain
        elif self.unsure(text):
            return self.sizes.merged(text)
        else:
            cut = self.cut
        size = self.sizes.__getitem__
        if self.special is None or not self.special.search(text):
            return sum(map(size, cut(text)))
        pieces = self.special.split(text)
        return len(pieces) - 1 + sum(sum(map(size, cut(p))) for p in pieces)


def count_tokens(
    df: DataFrame, path: str, text: str = "text", output: str = "n_tokens", limit: int | None = None
) -> DataFrame:
    """The frame with the token count of each whole text (``long``), and with a limit also ``over_limit``.

    A null or empty text has no tokens and is not over the limit. Repeated rows are counted each. Other columns do not
    pass through Python; columns named like an output are replaced. One pass, no shuffle.
    """
    spark = df.sparkSession
    python_tasks(spark)
    table = spark.sparkContext.broadcast(token_table(path))

    @F.arrow_udf("long")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Counter(table.value)
        for batch in batches:
            yield pa.array([counter.count(t.as_py()) for t in batch], pa.int64())

    result = put(df, output, counted(F.coalesce(F.col(text), F.lit(""))))
    return result if limit is None else put(result, "over_limit", F.col(output) > limit)
