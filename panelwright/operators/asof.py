"""As-of joins: per key, the right row nearest in time to each left row.

Both sides are stacked and ordered once per key; a running "last right row" then gives every left row its
match, with no range condition and no candidate pairs. Several right sides share the one shuffle and sort. Large keys are
parted into ranges, each of which starts from the last right row of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions.frames import require_columns
from panelwright.functions.scalars import distance, quoted
from panelwright.operators.skew import ROWS_PER_RANGE, carried, range_cuts, with_ranges

STRATEGIES = ("backward", "forward", "nearest")
_FIRST, _LAST = -(1 << 63), (1 << 63) - 1


@dataclass(frozen=True)
class RightSide:
    """A right frame of an as-of update.

    ``drop`` names right columns left out of the result. Of right rows with equal key and time the one with
    the greatest ``tie_break`` columns wins, then the one with the greatest values.
    """

    frame: DataFrame
    time: str
    drop: Sequence[str] = ()
    tie_break: Sequence[str] = field(default_factory=tuple)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    by: str | Sequence[str],
    strategy: str = "backward",
    columns: Sequence[str] | None = None,
    suffix: str = "_right",
    tie_break: Sequence[str] = (),
    rows_per_range: int | None = ROWS_PER_RANGE,
) -> DataFrame:
    """Left columns, then ``columns`` of the matched right row (default all but ``by``); null if none.

    Names that clash with the left side take the suffix. Every left row comes back exactly once. A null key
    or time on either side matches nothing.
    """
    by = [by] if isinstance(by, str) else list(by)
    columns = [c for c in right.columns if c not in by] if columns is None else list(columns)
    side = RightSide(right, right_on, tie_break=tie_break)
    matched = _match(left, [side], [columns], left_on, by, strategy, rows_per_range)
    taken = [F.col("__m0")[c].alias(c + suffix if c in left.columns else c) for c in columns]
    return matched.select(*map(quoted, left.columns), *taken)


def asof_update(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    by: str | Sequence[str],
    strategy: str = "backward",
    drop_right_cols: Sequence[str] = (),
    tie_break: Sequence[str] = (),
    rows_per_range: int | None = ROWS_PER_RANGE,
) -> DataFrame:
    """Put the values of the matched right row into the left rows.

    Columns on both sides become coalesce(right, left); left-only columns stay; right-only columns are
    added. The right time and ``drop_right_cols`` are left out. Column order: keys, time, then the three
    groups just named, each sorted by name.
    """
    by = [by] if isinstance(by, str) else list(by)
    side = RightSide(right, right_on, drop_right_cols, tie_break)
    result = asof_update_many(left, [side], left_on, by, strategy, rows_per_range)
    given = {c for c in right.columns if c not in drop_right_cols and c != right_on}
    fixed = [*by, left_on]
    rest = [c for c in result.columns if c not in fixed]
    both = sorted(c for c in rest if c in left.columns and c in given)
    left_only = sorted(c for c in rest if c not in given)
    right_only = sorted(c for c in rest if c not in left.columns)
    return result.select(*map(quoted, [*fixed, *both, *left_only, *right_only]))


def asof_update_many(
    left: DataFrame,
    rights: Sequence[RightSide],
    left_on: str,
    by: str | Sequence[str],
    strategy: str = "backward",
    rows_per_range: int | None = ROWS_PER_RANGE,
) -> DataFrame:
    """The result of ``asof_update`` with each right side in turn, in one shuffle and sort of the left.

    Columns keep the order of ``left``; right-only columns follow.
    """
    by = [by] if isinstance(by, str) else list(by)
    kept = [[c for c in r.frame.columns if c not in (*by, left_on, r.time, *r.drop)] for r in rights]
    matched = _match(left, rights, kept, left_on, by, strategy, rows_per_range)
    values: dict[str, list[Column]] = {c: [quoted(c)] for c in left.columns}
    for i, columns in enumerate(kept):
        for c in columns:
            values.setdefault(c, []).insert(0, F.col(f"__m{i}")[c])
    return matched.select([F.coalesce(*v).alias(c) if len(v) > 1 else v[0].alias(c) for c, v in values.items()])


def _match(
    left: DataFrame,
    rights: Sequence[RightSide],
    kept: Sequence[Sequence[str]],
    left_on: str,
    by: list[str],
    strategy: str,
    rows_per_range: int | None,
) -> DataFrame:
    """Left rows plus one struct ``__m{i}`` per right side: its matched row's ``kept`` columns."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, not {strategy!r}")
    require_columns(left, [*by, left_on])
    time_type = left.schema[left_on].dataType
    rows = [_right_rows(r, cols, by, left, time_type) for r, cols in zip(rights, kept)]
    names = [f"__r{i}" for i in range(len(rows))]
    # by content: the same when a lost task is run again, and different for the rows of one time
    salt = F.xxhash64(*map(quoted, left.columns))
    no_match = quoted(left_on).isNull()
    for c in by:
        no_match = no_match | quoted(c).isNull()
    # rows that match nothing are dealt out, so that a frequent null is no large key
    piece = F.when(no_match, -1 - F.pmod(salt, F.lit(1024))).otherwise(0).cast("int")
    lefts = left.withColumns({"__t": quoted(left_on), "__h": salt, "__side": F.lit(1), "__piece": piece})
    sides = [_one_per_time(r, by).withColumnRenamed("__r", n) for r, n in zip(rows, names)]

    layout, place = None, F.struct("__t", "__h")
    if rows_per_range is not None:
        narrow = [lefts.where("__piece = 0").select(*map(quoted, by), "__t", "__h")]
        narrow += [r.select(*map(quoted, by), "__t", F.lit(_FIRST).alias("__h")) for r in rows]
        layout = range_cuts(_stack(narrow), by, place, rows_per_range)

    # "forward" is "backward" read from the end; a frame up to unboundedFollowing would be quadratic
    directions = {"backward": ("behind",), "forward": ("ahead",), "nearest": ("behind", "ahead")}[strategy]
    # a cut may part the left rows of one time: the right row then stands before them all, or after them all
    copies = {d: [s.withColumnsRenamed({n: f"{n}_{d}"}) for s, n in zip(sides, names)] for d in directions}
    placed = {
        d: [s.withColumns({"__h": F.lit(_FIRST if d == "behind" else _LAST), "__side": F.lit(0), "__piece": F.lit(0)}) for s in copies[d]]
        for d in directions
    }
    group, order = [*by, "__piece"], ["__t"]
    if layout is not None:
        lefts = with_ranges(lefts, layout, by, place)
        placed = {d: [with_ranges(s, layout, by, place) for s in placed[d]] for d in directions}
        group, order = [*group, "__g"], ["__t", "__h"]
    stacked = _stack([lefts, *(s for d in directions for s in placed[d])])
    running = (Window.unboundedPreceding, Window.currentRow)
    by_group = Window.partitionBy(*map(quoted, group))
    windows = {
        "behind": by_group.orderBy(*order, "__side").rowsBetween(*running),
        "ahead": by_group.orderBy(*[F.desc(c) for c in order], "__side").rowsBetween(*running),
    }
    picks = {f"{n}_{d}": F.last(f"{n}_{d}", ignorenulls=True).over(windows[d]) for n in names for d in directions}
    matched = stacked.withColumns(picks).where("__side = 1")

    if layout is not None:
        for d in directions:
            states = [f"{n}_{d}" for n in names]
            pick = F.max if d == "behind" else F.min
            # the struct starts with its time, and is unique per time
            closing = [s.where("__parted").groupBy(*map(quoted, by), "__g").agg(pick(c).alias(c)) for s, c in zip(placed[d], states)]
            merged = closing[0]
            for other in closing[1:]:
                merged = merged.join(other, [*by, "__g"], "full")
            opening = carried(layout, merged, by, states, backwards=d == "ahead").withColumnsRenamed({c: f"__o_{c}" for c in states})
            matched = layout.joined(matched, opening, [*by, "__g"]).withColumns(
                {c: F.when(F.col("__piece") == 0, F.coalesce(c, f"__o_{c}")) for c in states}
            )

    final = {}
    for i, n in enumerate(names):
        best = F.col(f"{n}_{directions[0]}")
        if strategy == "nearest":
            best = _nearer(best, F.col(f"{n}_ahead"), time_type)
        final[f"__m{i}"] = best
    return matched.withColumns(final)


def _right_rows(
    side: RightSide, columns: Sequence[str], by: list[str], left: DataFrame, time_type: T.DataType
) -> DataFrame:
    """``by``, ``__t``, ``__rank`` and ``__r``, a struct of the time and the wanted columns; no null keys."""
    require_columns(side.frame, [*by, side.time, *side.tie_break])
    keys = [quoted(k).cast(left.schema[k].dataType).alias(k) for k in by]
    time = quoted(side.time).cast(time_type)
    rank = F.struct(*[quoted(c).alias(f"k{i}") for i, c in enumerate(side.tie_break)], F.lit(0).alias("k"))
    row = F.struct(time.alias("__at"), *[quoted(c).alias(c) for c in columns])
    rows = side.frame.select(*keys, time.alias("__t"), rank.alias("__rank"), row.alias("__r"))
    return rows.dropna(subset=[*by, "__t"])


def _one_per_time(rows: DataFrame, by: list[str]) -> DataFrame:
    """The winning row per key and time; copies collapse before the shuffle."""
    return (
        rows.groupBy(*map(quoted, by), "__t")
        .agg(F.max(F.struct("__rank", "__r")).alias("__best"))
        .select(*map(quoted, by), "__t", F.col("__best.__r").alias("__r"))
    )


def _nearer(back: Column, ahead: Column, time_type: T.DataType) -> Column:
    """The closer match; backward wins a tie."""
    before, after = distance(back["__at"], F.col("__t"), time_type), distance(F.col("__t"), ahead["__at"], time_type)
    if before is None:
        raise TypeError(f"nearest needs a time with distances, not {time_type.simpleString()}")
    return F.when(back.isNull() | (after < before), ahead).otherwise(back)


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked
