"""Codes for vectors, one per part, from codebooks made by ball k-means.

A codebook entry and the parts that are assigned to it form a ball. Its radius is the distance of its farthest part, and
entries whose centres are nearer than twice the radius are its neighbours; no part of the ball can be nearer to another entry.
Within the ball, a part less than half as far from its centre as the nearest neighbour lies in the stable core and keeps its
entry without a distance being computed. The rest lies in rings between half the distances of successive neighbours: a part of
the k-th ring is compared with the k nearest neighbours only. All numbers are whole, so the rules are exact, ties included.

A round is one pass that assigns, written as a table with the codes beside the vectors, and one that adds up the parts of each
entry in its tasks; a row per part position and entry reaches the driver, whatever the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.scalars import quoted
from panelwright.llm.common import Replaced, join_bounded, python_tasks, without
from panelwright.llm.vectors import rounded_root, whole

#: Neighbours that a ring is compared with, by the end of the ring; parts beyond the last are compared with all.
_RINGS = (8, 32, 128)
_ROWS = 1 << 14


@dataclass(frozen=True)
class Coding:
    """``parts`` equal consecutive parts of each vector, ``entries`` per codebook (256 at most), ``rounds`` of assigning
    and averaging, components as ``floor(scale * x)``."""

    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024

    def __post_init__(self) -> None:
        if not 1 <= self.entries <= 256:
            raise ValueError("a code has one byte: 1 to 256 entries")


@dataclass
class Balls:
    """Entries of one part position with their neighbours: ``near[i]`` the entries around entry i from the nearest on,
    ``apart[i]`` the squared distances to them, ``reach[i]`` how many of them are neighbours of its ball."""

    centres: np.ndarray
    near: np.ndarray
    apart: np.ndarray
    reach: np.ndarray

    @classmethod
    def around(cls, centres: np.ndarray, radii: np.ndarray) -> Balls:
        """``radii``: a bound of each ball's radius, rounded up."""
        squares = _squares(centres, centres)
        np.fill_diagonal(squares, -1)  # an entry comes before all others, also before those at its own place
        near = np.argsort(squares, axis=1, kind="stable")
        apart = np.take_along_axis(squares, near, axis=1)[:, 1:]
        reach = (apart <= (4 * radii.astype(np.float64) ** 2)[:, None]).sum(axis=1)
        return cls(centres, near[:, 1:], apart, reach)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, exact."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point, the first of several, and its squared distance."""
    squares = _squares(points, centres)
    chosen = squares.argmin(axis=1)
    return chosen, squares[np.arange(len(points)), chosen]


def reassign(points: np.ndarray, now: np.ndarray, balls: Balls) -> tuple[np.ndarray, np.ndarray]:
    """As ``nearest``, for points that are in balls already."""
    away = points.astype(np.float64) - balls.centres[now]
    best = (away * away).sum(axis=1)
    chosen = now.copy()
    order = np.argsort(now, kind="stable")
    ends = np.cumsum(np.bincount(now, minlength=len(balls.centres)))
    for entry, (a, b) in enumerate(zip([0, *ends[:-1]], ends)):
        reach = balls.reach[entry]
        if a == b or not reach:
            continue
        members = order[a:b]
        # the ring: neighbours up to twice as far from the centre as the part is; equal ones may win by their index
        ring = np.searchsorted(balls.apart[entry, :reach], 4 * best[members], side="right")
        least = 0
        for most in (*_RINGS, reach):
            inside = members[(ring > least) & (ring <= most)]
            least = most
            if not len(inside):
                continue
            others = balls.near[entry, : min(most, reach)]
            squares = _squares(points[inside], balls.centres[others])
            low = squares.min(axis=1)
            which = np.where(squares == low[:, None], others, len(balls.centres)).min(axis=1)
            better = (low < best[inside]) | ((low == best[inside]) & (which < entry))
            chosen[inside[better]] = which[better]
            best[inside[better]] = low[better]
    return chosen, best


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """Rows of fixed width from a column of bytes."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, kind).reshape(len(column), width)


def _bytes(matrix: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in matrix], pa.binary())


def _appended(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n not in columns]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *columns.values()], [*kept, *columns])


def _numbers(vector: str, scale: int):
    """Rows with a vector, and its numbers beside them as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, numbers = whole(batch.column(vector), scale)
            yield _appended(batch.filter(pa.array(kept)), __v=_bytes(numbers.astype("<i4")))

    return run


def _coded(sent, parts: int, width: int):
    """Codes and squared distances per part; ``sent`` has the centres, and balls from the second pass on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, balls = sent.value
        for batch in batches:
            for part in (batch.slice(i, _ROWS) for i in range(0, batch.num_rows, _ROWS)):
                if any(len(v) != 4 * parts * width for v in part.column("__v").to_pylist()):
                    raise ValueError(f"vectors of several lengths: not all have {parts * width} components")
                points = _matrix(part.column("__v"), "<i4", parts * width).reshape(-1, parts, width)
                codes, errors = np.empty((part.num_rows, parts), np.uint8), np.empty((part.num_rows, parts), np.int64)
                now = _matrix(part.column("__code"), "u1", parts).astype(np.int64) if balls else None
                for p in range(parts):
                    if balls:
                        codes[:, p], errors[:, p] = reassign(points[:, p], now[:, p], balls[p])
                    else:
                        codes[:, p], errors[:, p] = nearest(points[:, p], centres[p])
                yield _appended(part, __code=_bytes(codes), __errors=_bytes(errors.astype("<i8")))

    return run


def _sums(parts: int, width: int, entries: int):
    """Count, sums and greatest squared distance of the parts of each entry met by a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        far = np.zeros((parts, entries), np.int64)
        for batch in batches:
            points = _matrix(batch.column("__v"), "<i4", parts * width).reshape(-1, parts, width)
            codes = _matrix(batch.column("__code"), "u1", parts)
            errors = _matrix(batch.column("__errors"), "<i8", parts)
            for p in range(parts):
                counts[p] += np.bincount(codes[:, p], minlength=entries)
                np.add.at(sums[p], codes[:, p], points[:, p])
                np.maximum.at(far[p], codes[:, p], errors[:, p])
        p, e = np.nonzero(counts)
        columns = [pa.array(x, pa.int32()) for x in (p, e)] + [pa.array(x[p, e], pa.int64()) for x in (counts, far)]
        columns.append(pa.array(sums[p, e].tolist(), pa.list_(pa.int64())))
        yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", "far", "sums"])

    return run


def _averaged(coded: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres moved to the rounded-down averages of their parts, and a bound of each ball's radius about its new centre."""
    parts, entries, width = centres.shape
    met = coded.select("__v", "__code", "__errors").mapInArrow(
        _sums(parts, width, entries), "part int, entry int, n long, far long, sums array<long>"
    )
    sums = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)]
    rows = met.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.max("far").alias("far"), *sums).collect()  # parts x entries at most
    moved, radii = centres.copy(), np.zeros((parts, entries), np.int64)
    for r in rows:
        moved[r.part, r.entry] = [r[f"s{i}"] // r.n for i in range(width)]
        step = int(((moved[r.part, r.entry] - centres[r.part, r.entry]) ** 2).sum())
        radii[r.part, r.entry] = rounded_root(r.far) + rounded_root(step)
    return moved, radii


def compress(df: DataFrame, coding: Coding = Coding(), vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """The rows that hold a vector, with ``code`` (one byte per part) and ``error`` (squared distances, summed over the
    parts), and the codebooks: whole numbers by part, entry and position.

    Rows whose vector is null or holds null or non-finite components are left out. Codebooks start as the parts of the vectors
    with the least ids; fewer vectors give as many entries. Of repeated ids the lesser vector comes first, null ids
    come last. An empty table has empty codebooks. Vectors of several lengths fail, as do lengths that the parts do not
    divide. Extra columns stay; those named like an output are replaced.
    """
    spark = df.sparkSession
    python_tasks(spark)
    rows = without(df, "code", "error", "__v", "__code", "__errors")
    schema = rows.withColumn("__v", F.lit(b"").cast("binary")).schema
    state = Replaced(spark, "codes")
    numbered = state.put(rows.mapInArrow(_numbers(vector, coding.scale), schema))
    id_ = quoted(vec_id)
    # the bytes compare unlike the numbers, so that ties of ids are ordered by the vector itself
    first = numbered.orderBy(id_.asc_nulls_last(), quoted(vector)).limit(coding.entries).select("__v").collect()
    start = [np.frombuffer(r[0], "<i4").astype(np.int64) for r in first]
    length = len(start[0]) if start else 0
    if length % coding.parts or any(len(s) != length for s in start):
        raise ValueError(f"vectors of {sorted({len(s) for s in start})} components cannot be cut into {coding.parts} equal parts")
    width = length // coding.parts
    centres = np.stack(start).reshape(-1, coding.parts, width).transpose(1, 0, 2) if start else np.zeros((coding.parts, 0, 0), np.int64)
    schema.add("__code", "binary").add("__errors", "binary")
    coded, balls = numbered, None
    for round_ in range(coding.rounds + 1 if start else 0):
        sent = spark.sparkContext.broadcast((centres, balls))  # parts x entries squared numbers at most, whatever the input
        coded = state.put(coded.mapInArrow(_coded(sent, coding.parts, width), schema))
        if round_ < coding.rounds:
            centres, radii = _averaged(coded, centres)
            balls = [Balls.around(centres[p], radii[p]) for p in range(coding.parts)]
    if not start:
        coded = numbered.withColumn("__code", F.lit(b"")).withColumn("__errors", F.lit(b""))

    @F.arrow_udf("long")
    def total(errors: pa.Array) -> pa.Array:
        return pa.array(_matrix(errors, "<i8", coding.parts).sum(axis=1), pa.int64())

    return coded.withColumn("code", F.col("__code")).withColumn("error", total("__errors")).drop("__v", "__code", "__errors"), centres


def label_errors(coded: DataFrame, label: str = "label") -> DataFrame:
    """With ``label_error``, the errors of each label's rows together; null labels count as one label.

    Added up in the tasks first, so a label of many rows is not gathered. The sums are joined back, broadcast only if few.
    """
    key = F.struct(quoted(label).isNull().alias("none"), F.coalesce(quoted(label).cast("string"), F.lit("")).alias("label"))
    marked = without(coded, "label_error").withColumn("__label", key)
    sums = marked.groupBy("__label").agg(F.sum("error").alias("label_error"))
    return join_bounded(marked, sums, ["__label"]).drop("__label")


def codebooks_digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all entries' components in decimal by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.reshape(-1).tolist())).encode()).hexdigest()
