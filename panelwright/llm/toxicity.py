"""Severity of toxic texts by cumulative-link ordinal regression on sparse word features.

One weight vector is shared by all grades; ordered thresholds part its score into grades:
``P(grade <= k) = sigmoid(threshold_k - score)``. The outcome is the expected grade. Labels say only whether a text is toxic, so
grades are made from them: 0 is not toxic, and toxic texts are graded in equal parts by how many of their words speak for
toxicity.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import pick, put, python_tasks

#: Features are words hashed to this many bits.
BITS = 18
#: Most labelled rows a model is fitted on; a seeded choice of rows.
TRAIN_ROWS = 4_000
GRADES = 4
#: Lengths of word beginnings that are features; inflected and compound words share them.
PREFIXES = (3, 4, 5, 6, 7)
_EDGES = ".,;:!?\"'()[]{}<>*#%&$|~`_-+=/\\‘’“”«»…"
_REMEMBERED = 300_000


@dataclass(frozen=True)
class OrdinalModel:
    """Weights by feature and increasing thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, scores: np.ndarray) -> np.ndarray:
        """``P(grade > k)`` for each threshold, one row per score."""
        return _sigmoid(scores[:, None] - self.thresholds[None, :])

    def expected(self, scores: np.ndarray) -> np.ndarray:
        return self.above(scores).sum(axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class _Features(dict):
    """Word to its features, remembered up to a bound: the word itself and its beginnings; none for punctuation alone."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        from xxhash import xxh3_64_intdigest

        if len(self) >= _REMEMBERED:
            self.clear()
        plain = word.strip(_EDGES)
        names = [plain, *("^" + plain[:n] for n in PREFIXES if len(plain) > n)] if plain else []
        value = self[word] = tuple(xxh3_64_intdigest(x.encode()) >> (64 - BITS) for x in names)
        return value


def features(text: str | None, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a whole text, and a value for each: the logarithm of how often it occurs in a hundred words.

    None of a null or empty text.
    """
    words = Counter((text or "").lower().split())
    found = list(map(known.__getitem__, words))
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    counts = np.repeat(np.fromiter(words.values(), np.float64, len(words)), sizes)
    flat = np.fromiter(chain.from_iterable(found), np.int64, len(counts))
    ids, place = np.unique(flat, return_inverse=True)
    rates = np.bincount(place, counts, minlength=len(ids)) / max(1, sum(words.values()))
    return ids, np.log1p(100 * rates)


def fit(ids: np.ndarray, values: np.ndarray, rows: np.ndarray, grades: np.ndarray, steps: int = 200, rate: float = 0.1, ridge: float = 2e-4, least: int = 3) -> OrdinalModel:
    """Fit by full-batch gradient steps with moments (Adam).

    ``ids, rows`` are the nonzero features of the rows, ``grades`` from 0. Features in fewer than ``least`` rows get no weight.
    Without rows, or without toxic ones, every score is 0 and the thresholds are out of reach.
    """
    levels = GRADES - 1
    weights = np.zeros(1 << BITS)
    if not len(grades) or not grades.any():
        return OrdinalModel(weights.astype(np.float32), np.full(levels, 40.0))
    n = len(grades)
    frequent = np.bincount(ids, minlength=1 << BITS) >= least
    used = frequent[ids]
    ids, values, rows = ids[used], values[used], rows[used]
    share = np.array([(grades > k).mean() for k in range(levels)]).clip(1e-4, 1 - 1e-4)
    first = -np.log(share / (1 - share))
    # thresholds are a first one and positive gaps, so they stay in order
    shape = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    slope = [np.zeros_like(weights), np.zeros_like(shape)]
    square = [np.zeros_like(weights), np.zeros_like(shape)]
    for step in range(1, steps + 1):
        thresholds = np.cumsum(np.concatenate([shape[:1], np.exp(shape[1:])]))
        score = np.bincount(rows, weights[ids] * values, minlength=n)
        upto = _sigmoid(thresholds[None, :] - score[:, None])
        edges = np.concatenate([np.zeros((n, 1)), upto, np.ones((n, 1))], axis=1)
        at = np.arange(n)
        chance = np.maximum(edges[at, grades + 1] - edges[at, grades], 1e-9)
        bend = np.concatenate([np.zeros((n, 1)), upto * (1 - upto), np.zeros((n, 1))], axis=1)
        by_score = (bend[at, grades + 1] - bend[at, grades]) / chance / n
        by_level = np.stack(
            [-((grades == k) * bend[:, k + 1] - (grades == k + 1) * bend[:, k + 1]) / chance for k in range(levels)], axis=1
        ).sum(axis=0) / n
        by_shape = np.cumsum(by_level[::-1])[::-1]
        by_shape[1:] *= np.exp(shape[1:])
        by_weight = np.bincount(ids, by_score[rows] * values, minlength=1 << BITS) + ridge * weights
        for k, (value, gradient) in enumerate(((weights, by_weight), (shape, by_shape))):
            slope[k] = 0.9 * slope[k] + 0.1 * gradient
            square[k] = 0.99 * square[k] + 0.01 * gradient**2
            value -= rate * (slope[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    thresholds = np.cumsum(np.concatenate([shape[:1], np.exp(shape[1:])]))
    return OrdinalModel(weights.astype(np.float32), thresholds)


def graded(ids: np.ndarray, values: np.ndarray, rows: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Grades of labelled rows: 0, or 1 and up in equal parts of the toxic rows.

    A feature speaks for toxicity if it is at least four times as frequent among toxic rows, and in five of them or more.
    Toxic rows are ranked by the sum of the values of such features.
    """
    n, bins = len(toxic), 1 << BITS
    bad = np.bincount(ids, toxic[rows], minlength=bins)
    good = np.bincount(ids, 1.0 - toxic[rows], minlength=bins)
    odds = ((bad + 0.5) / (toxic.sum() + 1)) / ((good + 0.5) / ((1 - toxic).sum() + 1))
    marks = (odds >= 4) & (bad >= 5)
    weight = np.bincount(rows, values * marks[ids], minlength=n)
    grades = np.zeros(n, np.int64)
    which = np.flatnonzero(toxic)
    order = which[np.lexsort((which, weight[which]))]
    grades[order] = 1 + np.arange(len(order)) * (GRADES - 1) // max(1, len(order))
    return grades


def train(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = TRAIN_ROWS) -> OrdinalModel:
    """Fit on at most ``rows`` labelled rows, chosen by a hash of their id; rows without a label, or a text, are no examples.

    Features are made in tasks; only they come to the driver, bounded by ``rows``.
    """
    python_tasks(df.sparkSession)
    known = pick(labels, doc_id, label).where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    chosen = known.dropDuplicates([doc_id]).orderBy(F.xxhash64(doc_id), doc_id).limit(rows)
    examples = pick(df, doc_id, text).where(F.col(text).isNotNull()).join(F.broadcast(chosen), doc_id)
    named = examples.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"), (F.col(label) > 0).cast("int").alias("toxic"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Features()
        for batch in batches:
            pairs = [features(t, found) for t in batch.column("text").to_pylist()]
            lists = [pa.array([p[k] for p in pairs], pa.list_(kind)) for k, kind in ((0, pa.int32()), (1, pa.float32()))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("toxic"), *lists], ["id", "toxic", "f", "c"])

    made = named.mapInArrow(run, "id long, toxic int, f array<int>, c array<float>").toArrow().sort_by([("id", "ascending"), ("toxic", "ascending")])
    lists = made.column("f").combine_chunks()
    toxic = made.column("toxic").to_numpy().astype(float)
    sizes = np.array([len(x) for x in lists], np.int64) if made.num_rows else np.empty(0, np.int64)
    ids = np.asarray(lists.flatten(), np.int64)
    values = np.asarray(made.column("c").combine_chunks().flatten(), np.float64)
    where = np.repeat(np.arange(len(sizes)), sizes)
    return fit(ids, values, where, graded(ids, values, where, toxic))


def score(df: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """The frame with ``severity`` (expected grade, 0 to 3), ``p_toxic`` (chance of a grade above 0) and ``toxic`` (even or more).

    A null or empty text has no features and the score 0. Other columns do not pass through Python; columns named like an
    output are replaced. One pass, no shuffle; the model is of fixed size.
    """
    python_tasks(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<severity:double,p_toxic:double>")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, own = _Features(), sent.value
        for batch in batches:
            found = (features(t.as_py(), known) for t in batch)
            sums = np.array([own.weights[ids] @ values for ids, values in found])
            above = own.above(sums.reshape(-1))
            arrays = [pa.array(above.sum(axis=1)), pa.array(above[:, 0])]
            yield pa.StructArray.from_arrays(arrays, ["severity", "p_toxic"])

    made = put(df, "__scored", scored(F.col(text)))
    for name in ("severity", "p_toxic"):
        made = put(made, name, F.round(F.col(f"__scored.{name}"), 6))
    return put(made, "toxic", F.col("p_toxic") >= 0.5).drop("__scored")
