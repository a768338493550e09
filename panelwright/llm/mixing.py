"""Mixing sources to target weights by capped water-filling.

Each source gets words in proportion to its weight until it meets its cap (a number of epochs); what is left over goes to
the others by weight, until none is above its cap. Then each document is repeated as many whole times as its source's
rate says, and the fraction left is filled by a seeded random order of the source's documents, cut where the words taken
come nearest to the target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import join_bounded, put, staged, without, words_of

#: Ranges that the 60-bit random order of a source is counted in before the one range with the cut is sorted.
_RANGE_BITS = 16


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """``__key, source_size, target`` from one row ``__key, source_size`` per source.

    Sources in code point order, null last, weigh ``weights`` in turn. With sources sorted by cap per weight, those at
    their cap come first, so running sums give the water level. Windows over one row per source.
    """
    ranked = Window.orderBy(F.col("__key") == "", "__key")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.select(
        "*",
        F.get(cycle, F.pmod(F.row_number().over(ranked) - 1, F.lit(len(weights)))).alias("__w"),
        (F.col("source_size") * F.lit(float(cap))).alias("__cap"),
    )
    steps = Window.orderBy(F.col("__cap") / F.col("__w"), "__key")
    whole = steps.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = steps.rowsBetween(Window.unboundedPreceding, -1)
    total = F.least(F.sum("source_size").over(whole) * F.lit(float(share)), F.sum("__cap").over(whole))
    # the level if this source and all after it were below their caps
    left = F.sum("__w").over(whole) - F.coalesce(F.sum("__w").over(before), F.lit(0.0))
    level = (total - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))) / left
    levels = weighed.withColumn("__level", level)
    full = F.col("__cap") <= F.col("__level") * F.col("__w")
    final = F.max(F.when(~full, F.struct((-F.col("__cap") / F.col("__w")).alias("o"), F.col("__level").alias("v")))).over(whole)
    return levels.withColumn("__final", final["v"]).select(
        "__key",
        "source_size",
        F.when(full | F.col("__final").isNull(), F.col("__cap"))
        .otherwise(F.least(F.col("__cap"), F.col("__final") * F.col("__w")))
        .alias("target"),
    )


def _order(seed: int, doc_id: str, text: str) -> Column:
    """60 seeded random bits of a row; equal for equal rows only."""
    named = F.concat(
        F.lit(f"{seed}|"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col(text), F.lit(""))
    )
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 15), 16, 10).cast("long")


def mix(
    df: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 17,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The frame with ``size``, ``source_size``, ``target``, ``repeats`` and ``taken``.

    ``size`` is the number of words (0 for a null text), ``taken = repeats * size``. All rows are returned, also those that
    the mix takes no time. A null source is a source of its own. Rows equal in id and text are told apart only where the
    cut falls between them. Reruns agree: the random order hashes id and text. An empty frame gives an empty frame.
    Columns named like an output are replaced.

    Rows are counted per source and range of the order (map-side sums), so a hot source is never gathered; only the range
    that holds a source's cut is sorted.
    """
    clean = without(df, "size", "source_size", "target", "repeats", "taken")
    sized = clean.withColumns(
        {
            "__key": F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")),
            "__order": _order(seed, doc_id, text),
            "size": F.size(words_of(F.col(text))).cast("long"),
        }
    )
    narrow = staged(sized.select("__key", "__order", "size"), "mix")
    ranges = staged(
        narrow.groupBy("__key", F.shiftright("__order", 60 - _RANGE_BITS).alias("__range")).agg(F.sum("size").alias("words")),
        "mix-ranges",
    )
    sizes = ranges.groupBy("__key").agg(F.sum("words").alias("source_size"))
    goals = staged(_goals(source_targets(sizes, weights, share, cap)), "mix-goals")
    cuts = staged(goals.join(_cuts(narrow, ranges, goals), "__key", "left"), "mix-cuts")
    placed = join_bounded(sized, cuts, ["__key"])
    extra = F.when(F.col("need") <= 0, 0).when(
        F.col("cut").isNull() | (F.col("__order") < F.col("cut")), 1
    ).otherwise(0)
    if cuts.where("k > 0").limit(1).count():  # copies of one row on both sides of the cut
        copies = Window.partitionBy("__key", "__order").orderBy(F.lit(1))
        at_cut = (F.col("need") > 0) & (F.col("__order") == F.col("cut")) & (F.col("k") > 0)
        among = placed.where(at_cut).withColumn("__extra", (F.row_number().over(copies) <= F.col("k")).cast("int"))
        placed = placed.where(~F.coalesce(at_cut, F.lit(False))).withColumn("__extra", extra).unionByName(among)
    else:
        placed = placed.withColumn("__extra", extra)
    counted = put(placed, "repeats", (F.col("whole") + F.col("__extra")).cast("long"))
    return put(counted, "taken", F.col("repeats") * F.col("size")).drop("__key", "__order", "__extra", "whole", "need", "cut", "k")


def _goals(targets: DataFrame) -> DataFrame:
    """Whole repetitions of each source, and the words still needed after them."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return targets.withColumn("whole", F.floor(rate)).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))


def _cuts(narrow: DataFrame, ranges: DataFrame, goals: DataFrame) -> DataFrame:
    """``__key, cut, k``: rows before ``cut`` in the random order are taken once more, and ``k`` of those at it.

    A source without a row here is taken whole (the need covers it).
    """
    by_range = Window.partitionBy("__key").orderBy("__range")
    summed = ranges.join(goals.select("__key", "need"), "__key").withColumn("__upto", F.sum("words").over(by_range))
    edge = summed.where((F.col("need") > 0) & (F.col("__upto") >= F.col("need")) & (F.col("__upto") - F.col("words") < F.col("need")))
    edge = edge.select("__key", "__range", "need", (F.col("__upto") - F.col("words")).alias("__before"))
    inside = join_bounded(
        narrow.withColumn("__range", F.shiftright("__order", 60 - _RANGE_BITS)), edge, ["__key", "__range"], "inner"
    )
    copies = inside.groupBy("__key", "__order").agg(
        F.count("*").alias("m"), F.max("size").alias("z"), F.max("need").alias("need"), F.max("__before").alias("__before")
    )
    by_order = Window.partitionBy("__key").orderBy("__order")
    before = F.col("__before") + F.sum(F.col("m") * F.col("z")).over(by_order) - F.col("m") * F.col("z")
    wanted = F.when(F.col("z") > 0, F.floor((F.col("need") - before) / F.col("z") + 0.5)).otherwise(F.col("m"))
    fitted = copies.withColumn("k", F.greatest(F.lit(0), F.least(F.col("m"), wanted)))
    # the first row of the range that is not taken whole; none if all of it is
    short = fitted.groupBy("__key").agg(
        F.min(F.when(F.col("k") < F.col("m"), F.struct("__order", "k"))).alias("s"), F.max("__order").alias("last")
    )
    return short.select("__key", F.coalesce(F.col("s.__order"), F.col("last") + 1).alias("cut"), F.coalesce(F.col("s.k"), F.lit(0)).alias("k"))
