"""Benchmark questions in documents, also with other numbers, names or units, by template windows.

Numbers, units after numbers and capitalised words inside sentences become typed slots that remember their value. Windows of
templates (slot types and plain words in lower case) are joined by hash. Windows of one document and item that lie on one
diagonal are read together, and their slots compared: a value of the item must always stand for the same value of the
document and the other way round. What stays is the share of the item that is found.

Templates of hardly any plain words would fit too much. Windows of that kind, on either side, are hashed with the values of
their slots, so such stretches are found word for word. Items of a few tokens are found where they fill a line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import join_bounded, let, pick, staged

#: Marks before the value of a slot.
NUMBER, UNIT, NAME = "\x01", "\x02", "\x03"
#: Windows of fewer plain words than this are compared with the values of their slots.
MIN_PLAIN = 4
#: Items of fewer tokens than this must fill a line of the document.
MIN_TOKENS = 4
# Unit words that count as a slot after a number.
UNITS = (
    "mm cm m km in inch inches ft feet foot yd yard yards mi mile miles mg g kg lb lbs oz ounce ounces pound pounds gram grams "
    "ton tons ml l liter liters litre litres gallon gallons meter meters metre metres s sec second seconds min minute minutes h hr "
    "hour hours day days week weeks month months year years percent dollar dollars cent cents euro euros degree degrees mph kmh "
    "hz khz mhz ghz w kw v a j kj n pa kpa k c f kb mb gb tb"
).split()


def template_tokens(text: Column) -> Column:
    """Tokens of a text in order; slots are a mark followed by their value. None of a null text."""
    own = F.translate(F.coalesce(text, F.lit("")), NUMBER + UNIT + NAME, "   ")
    numbers = F.regexp_replace(own, r"(?<![\p{L}\p{N}.,])\p{N}+(?:[.,]\p{N}+)*", NUMBER + "$0 ")
    units = F.regexp_replace(numbers, f"({NUMBER}\\S+[ \\-]+)(?i:({'|'.join(sorted(UNITS, key=len, reverse=True))}))(?![\\p{{L}}\\p{{N}}])", f"$1{UNIT}$2")
    names = F.regexp_replace(units, r"(?<=[^.!?:\s][ \t]{1,2})\p{Lu}(?=\p{Ll})", NAME + "$0")  # a number got a blank of its own
    # everything but letters, digits, marks and separators inside numbers parts tokens
    parted = F.regexp_replace(F.lower(names), r"[^\p{L}\p{N}\x01-\x03.,]+|[.,](?!\p{N})|(?<!\p{N})[.,]", " ")
    return F.array_remove(F.split(parted, " "), "")


def _template(tokens: Column) -> Column:
    """Tokens with the values of slots left out."""
    return F.transform(tokens, lambda t: F.when(t < "\x04", F.substring(t, 1, 1)).otherwise(t))


def _windows(tokens: Column, width: int) -> Column:
    """64-bit hashes of all windows of ``width`` tokens: of their templates, or with values where there are few plain words."""
    least = min(MIN_PLAIN, width)

    def of(parts: Column) -> Column:
        last = F.size(parts["t"]) - width + 1
        every = F.sequence(F.lit(1), last)

        def mixed(i: Column) -> Column:
            few = F.size(F.filter(F.slice(parts["s"], i, width), lambda s: s)) > width - least
            return F.xxhash64(F.slice(F.when(few, parts["v"]).otherwise(parts["t"]), i, width))

        # a text of few slots has no such window
        some = F.size(F.filter(parts["s"], lambda s: s)) > width - least
        hashes = F.when(some, F.transform(every, mixed)).otherwise(F.transform(every, lambda i: F.xxhash64(F.slice(parts["t"], i, width))))
        return F.when(last >= 1, hashes).otherwise(F.array().cast("array<bigint>"))

    found = F.struct(
        F.transform(_template(tokens), lambda t: F.xxhash64(t)).alias("t"),
        F.transform(tokens, lambda t: F.xxhash64(t)).alias("v"),
        F.transform(tokens, lambda t: t < "\x04").alias("s"),
    )
    return let(found, of)


def leaks(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    width: int = 8,
    min_share: float = 0.5,
) -> DataFrame:
    """``doc_id, item_id, n_found, share, changed`` for each document that holds at least ``min_share`` of an item.

    ``n_found`` counts the item's tokens found in windows with consistent slots, ``changed`` says that some slot has another
    value than in the item. Items of fewer than ``width`` tokens are looked for as a whole, those of fewer than ``MIN_TOKENS``
    as a whole line. Windows with fewer than ``MIN_PLAIN`` plain words must agree in the values of their slots too. Null and
    empty texts match nothing. Rows equal in id and text give one result; rows of one id with different texts are searched apart
    and reported under their id.

    Every document is read whole, once for all widths, and each of its windows is one row of a hash join with the items'
    windows, which are broadcast only if they are few. Only matches are shuffled.
    """
    found = _found(docs, items, doc_id, item_id, text, width, min_share)
    return found.select(F.col("__id").alias("doc_id"), F.col("__item").alias("item_id"), "n_found", "share", "changed")


def without_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that hold no item; all their columns stay."""
    found = _found(docs, items, doc_id, options.pop("item_id", "item_id"), text, options.pop("width", 8), options.pop("min_share", 0.5))
    bad = staged(found.select("__row").distinct(), "leaks")
    marked = docs.withColumn("__row", _row(doc_id, text))
    return join_bounded(marked, bad, ["__row"], "left_anti").drop("__row")


def _row(doc_id: str, text: str) -> Column:
    """Names rows by id and text, so that null and repeated ids do no harm."""
    return F.xxhash64(F.col(doc_id).cast("string"), F.col(text))


def _found(docs: DataFrame, items: DataFrame, doc_id: str, item_id: str, text: str, width: int, min_share: float) -> DataFrame:
    asked = pick(items, item_id, text).select(
        F.monotonically_increasing_id().alias("__n"), F.col(item_id).alias("__item"), template_tokens(F.col(text)).alias("__its")
    )
    asked = staged(asked.where(F.size("__its") > 0), "items")
    rows = pick(docs, doc_id, text).select(_row(doc_id, text).alias("__row"), F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
    sizes = [r[0] for r in asked.select(F.least(F.size("__its"), F.lit(width))).distinct().collect()]  # width values at most
    widths = sorted(w for w in sizes if w >= min(MIN_TOKENS, width))
    lines = None
    if widths:
        own = F.filter(_of_widths(F.col("__its"), widths), lambda x: x["__w"] == F.least(F.size("__its"), F.lit(width)))
        windows = staged(asked.select("__n", F.explode(own).alias("x")).select("__n", "x.__w", F.posexplode("x.__hs").alias("__p", "__h")), "windows")
        split = rows.select("__row", F.explode(_of_widths(template_tokens(F.col("__text")), widths)).alias("x"))
        placed = split.select("__row", "x.__w", F.posexplode("x.__hs").alias("__at", "__h"))
        met = join_bounded(placed, windows, ["__w", "__h"], "inner").withColumn("__shift", F.col("__at") - F.col("__p"))
        lines = met.groupBy("__row", "__n", "__shift", "__w").agg(F.collect_set("__p").alias("__ps"))
    if len(widths) < len(sizes):
        short = _filled_lines(rows, asked.where(F.size("__its") < min(MIN_TOKENS, width)))
        lines = short if lines is None else lines.unionByName(short)
    if lines is None:
        empty = "__row long, __id string, __item string, n_found int, share double, changed boolean"
        return docs.sparkSession.createDataFrame([], empty)
    lines = staged(lines, "diagonals")
    texts = join_bounded(rows, lines.select("__row").distinct(), ["__row"], "left_semi")
    tokens = texts.select("__row", "__id", template_tokens(F.col("__text")).alias("__doc")).dropDuplicates(["__row"])
    joined = lines.join(tokens, "__row").join(asked, "__n")  # token arrays are wide: Spark goes by their bytes
    covered = F.array_distinct(F.flatten(F.transform("__ps", lambda p: F.sequence(p, p + F.col("__w") - 1))))
    joined = joined.withColumn("__cov", covered)
    slots = F.filter(
        F.transform("__cov", lambda i: F.struct(F.get("__its", i).alias("a"), F.get("__doc", i + F.col("__shift")).alias("b"))),
        lambda s: s["a"] < "\x04",
    )
    checked = joined.withColumn("__slots", F.array_distinct(slots))
    one_way = F.size(F.array_distinct(F.transform("__slots", lambda s: s["a"])))
    back = F.size(F.array_distinct(F.transform("__slots", lambda s: s["b"])))
    consistent = checked.where((F.size("__slots") == one_way) & (F.size("__slots") == back))
    other = F.exists("__slots", lambda s: s["a"] != s["b"])
    merged = consistent.groupBy("__row", "__n").agg(
        F.any_value("__id").alias("__id"),
        F.any_value("__item").alias("__item"),
        F.max(F.size("__its")).alias("__size"),
        F.size(F.array_distinct(F.flatten(F.collect_list("__cov")))).alias("n_found"),
        F.max(other).alias("changed"),
    )
    shared = merged.withColumn("share", F.col("n_found") / F.col("__size"))
    return shared.where(F.col("share") >= min_share)


def _of_widths(tokens: Column, widths: list[int]) -> Column:
    """For each width the hashes of all windows; the tokens are made once."""
    return let(tokens, lambda t: F.array(*[F.struct(F.lit(w).alias("__w"), _windows(t, w).alias("__hs")) for w in widths]))


def _filled_lines(rows: DataFrame, items: DataFrame) -> DataFrame:
    """``__row, __n, __shift, __w, __ps`` of items that are a whole line: the same tokens, values included."""
    named = staged(items.select("__n", F.size("__its").alias("__w"), F.xxhash64("__its").alias("__h")), "short-items")
    in_line = F.transform(F.split(F.coalesce("__text", F.lit("")), "\n"), lambda x: template_tokens(x))
    # token arrays of the lines, and how many tokens stand before each
    per_line = rows.select("__row", F.posexplode(in_line).alias("__l", "__its")).where(F.size("__its").between(1, MIN_TOKENS - 1))
    met = join_bounded(per_line.select("__row", "__l", F.xxhash64("__its").alias("__h")), named, ["__h"], "inner").drop("__h")
    texts = rows.join(met, "__row").select("__row", "__n", "__w", "__l", "__text").distinct()
    above = F.array_join(F.slice(F.split("__text", "\n"), F.lit(1), F.col("__l")), "\n")
    before = F.when(F.col("__l") > 0, F.size(template_tokens(above))).otherwise(0)
    every = F.sequence(F.lit(0), F.col("__w") - 1)
    placed = texts.select("__row", "__n", before.alias("__shift"), "__w", every.alias("__ps"))
    # the whole-item window starts at the first place only
    return placed.select("__row", "__n", "__shift", "__w", F.array(F.lit(0)).alias("__ps")).distinct()
