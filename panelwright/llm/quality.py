"""Quality rules as a short-circuit cascade.

Each rule is one DataFrame expression that says "reject". On a bounded sample the cost of each rule is timed and its
rejections noted; the rules are then chained by rejections per second among the rows that the rules before leave over.
A rejected row evaluates no later rule. The order changes the time a run takes, never its verdicts.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import BLANKS, let, pick, put, staged, words_of

#: Rows on which costs and rejections are estimated; verdicts never depend on them.
SAMPLE_ROWS = 1_000
WINDOW = 8


def word_chars(text: Column) -> Column:
    """Code points inside words."""
    return F.length(F.translate(text, BLANKS, "")).cast("long")


def n_symbols(text: Column) -> Column:
    """Characters of ``[#*$%&|<>]``."""
    return (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long")


def n_lines(text: Column) -> Column:
    """Lines (cut at line feeds) with a word."""
    return F.size(_lines(text)).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)


def n_repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that are found twice or more in the text.

    Windows are compared by 64-bit hash. Only texts with a repeated hash sort them; the sorted starts of repeated windows
    give the words covered as the gaps between them, each cut to the window's length.
    """
    last = F.size(words) - window

    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(w, i, window)))

    def covered(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            def again(x: Column, k: Column) -> Column:
                before, after = F.get(s, k - 1)["h"], F.get(s, k + 1)["h"]
                return x["h"].eqNullSafe(before) | x["h"].eqNullSafe(after)

            return F.array_sort(F.transform(F.filter(s, again), lambda x: x["i"]))

        def length(p: Column) -> Column:
            gaps = F.transform(p, lambda x, k: F.least(F.lit(window), F.get(p, k + 1) - x))
            return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

        return let(let(placed, starts), length)

    repeated = let(hashes(words), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))
    return F.when(last >= 1, repeated).otherwise(0).cast("long")


@dataclass(frozen=True)
class Rule:
    """``reject(text, words)`` is true for rows to be turned away; null counts as false. The text is never null."""

    name: str
    reject: Callable[[Column, Column], Column]


def _symbols(text: Column, words: Column) -> Column:
    return n_symbols(text) * 10 > F.size(words)


def _word_length(text: Column, words: Column) -> Column:
    return let(word_chars(text), lambda n: (n < 2 * F.size(words)) | (n > 15 * F.size(words)))


def _repeated_lines(text: Column, words: Column) -> Column:
    return let(n_lines(text), lambda n: (n >= 4) & (n_dup_lines(text) * 2 > n))


def _no_letters(text: Column, words: Column) -> Column:
    spoken = F.filter(words, lambda w: F.rlike(w, F.lit(r"\p{L}")))
    return F.size(spoken) * 10 < F.size(words) * 6


def _shouting(text: Column, words: Column) -> Column:
    return F.size(F.filter(words, lambda w: F.endswith(w, F.lit("!")))) * 2 > F.size(words)


def _capitals(text: Column, words: Column) -> Column:
    letters, capitals = F.regexp_replace(text, r"[^\p{L}]+", ""), F.regexp_replace(text, r"[^\p{Lu}]+", "")
    return let(F.length(letters), lambda n: (n >= 40) & (F.length(capitals) * 2 > n))


def default_rules() -> list[Rule]:
    """Thresholds as in published web-corpus filters. Each rule wants a large share of the text to be at fault, so that a
    text with a few odd lines or words passes."""
    return [
        Rule("symbols", _symbols),
        Rule("word_length", _word_length),
        Rule("repeated_lines", _repeated_lines),
        Rule("no_letters", _no_letters),
        Rule("shouting", _shouting),
        Rule("capitals", _capitals),
    ]


def base_failed(words: Column, repeats: Column) -> Column:
    """Fewer than 20 words, or over 30 % of the words in repeated windows."""
    return (F.size(words) < 20) | (repeats * 100 > F.size(words) * 30)


def rule_order(sample: DataFrame, rules: Sequence[Rule]) -> list[str]:
    """Rule names by rejections per second, greedily among the sample rows not rejected yet.

    ``sample`` is small (the caller bounds it). Each rule is timed alone, after a first run that warms it up; verdicts
    come back as one bit per rule and row.
    """
    if not rules:
        return []
    rejects = [F.coalesce(r.reject(F.col("__text"), F.col("__words")), F.lit(False)) for r in rules]
    bits = sample.select(*[r.alias(f"r{i}") for i, r in enumerate(rejects)]).collect()
    cost = []
    for reject in rejects:
        took = []
        for _ in range(2):
            start = time.perf_counter()
            sample.agg(F.sum(reject.cast("int"))).collect()
            took.append(time.perf_counter() - start)
        cost.append(min(took))
    alive, left, order = set(range(len(bits))), list(range(len(rules))), []
    while left:
        best = max(left, key=lambda i: (sum(bits[k][i] for k in alive) / cost[i], -cost[i]))
        order.append(rules[best].name)
        left.remove(best)
        alive = {k for k in alive if not bits[k][best]}
    return order


def cascade(rules: Sequence[Rule], order: Sequence[str], text: Column, words: Column) -> Column:
    """Name of the first rule, in this order, that rejects the row; null if none does."""
    by_name = {r.name: r for r in rules}
    verdict = F.lit(None).cast("string")
    for name in reversed(order):
        verdict = F.when(by_name[name].reject(text, words), F.lit(name)).otherwise(verdict)
    return verdict


def judge(
    df: DataFrame, text: str = "text", rules: Sequence[Rule] | None = None, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """The frame with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``kept``.

    A row is kept if it passes the base and no rule of the cascade rejects it. A null text counts as an empty one, which
    fails the base. Repeated rows get equal verdicts. Columns named like an output are replaced. No shuffle; every text is
    read whole. The statistics are asked for, so they are computed for all rows; the cascade itself stops early.
    """
    rules = default_rules() if rules is None else list(rules)
    order = rule_order(_sample(df, text, sample_rows), rules)
    ready = _ready(df, text)
    repeats = put(ready, "n_repeat_words", n_repeat_words(F.col("__words")))
    based = put(repeats, "base_failed", base_failed(F.col("__words"), F.col("n_repeat_words")))
    rejected = F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(rules, order, F.col("__text"), F.col("__words")))
    outputs = {
        "kept": rejected.isNull(),
        "n_words": F.size("__words").cast("long"),
        "word_chars": word_chars(F.col("__text")),
        "n_symbols": n_symbols(F.col("__text")),
        "n_dup_lines": n_dup_lines(F.col("__text")),
    }
    for name, value in outputs.items():
        based = put(based, name, value)
    return based.drop("__text", "__words")


def keep_good(df: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rows that pass, with their own columns only; the full short circuit, since no statistics are asked for."""
    rules = default_rules()
    order = rule_order(_sample(df, text, sample_rows), rules)

    def rejected(t: Column, w: Column) -> Column:
        failed = base_failed(w, n_repeat_words(w))
        return F.when(F.size(w) < 20, F.lit("base")).otherwise(
            F.coalesce(cascade(rules, order, t, w), F.when(failed, F.lit("base")))
        )

    own = F.coalesce(F.col(text), F.lit(""))
    verdict = let(F.struct(own.alias("t"), words_of(own).alias("w")), lambda s: rejected(s["t"], s["w"]))
    return df.where(verdict.isNull())


def _ready(df: DataFrame, text: str) -> DataFrame:
    own = F.coalesce(F.col(text), F.lit(""))
    return df.withColumns({"__text": own, "__words": words_of(own)})


def _sample(df: DataFrame, text: str, rows: int) -> DataFrame:
    """A few whole texts, staged; only the order of the rules comes from them."""
    return _ready(staged(pick(df, text).limit(rows), "rules"), text)
