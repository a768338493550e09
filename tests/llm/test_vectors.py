"""Hard negatives and vector codes, against plain Python, and on odd rows."""

import math

import numpy as np
import pytest

from panelwright.llm import ball_kmeans, hard_negatives
from panelwright.llm.ball_kmeans import Coding
from panelwright.llm.hard_negatives import Mining

SCHEMA = "vec_id long, label int, embedding array<float>"


def whole_rows(rows, scale):
    kept = [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    return [(i, l, [math.floor(scale * float(np.float32(x))) for x in v]) for i, l, v in kept]


def by_id(i):
    return (i is None, i or 0)


def brute_mine(rows, job):
    rows = [r for r in whole_rows(rows, job.scale) if r[1] is not None]
    found = []
    for k, (i, l, v) in enumerate(rows):
        if i is None or i % job.every:
            continue
        score = [sum(a * b for a, b in zip(v, w)) for _, _, w in rows]
        order = sorted((j for j in range(len(rows)) if j != k), key=lambda j: (-score[j], by_id(rows[j][0])))
        for p in [j for j in order if rows[j][1] == l][: job.positives]:
            fits = [j for j in order if rows[j][1] != l and job.least * score[p] <= 100 * score[j] <= job.most * score[p]]
            for rank, n in enumerate(fits[: job.negatives], 1):
                found.append((i, rows[p][0], rank, rows[n][0], score[p], score[n]))
    return sorted(found, key=repr)


def random_rows(n=400, width=12, seed=1, spread=True):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (6, width))
    rows = []
    for i in range(n):
        label = int(rng.integers(0, 6))
        v = centres[label] + rng.normal(0, 0.7, width)
        v *= rng.lognormal(0, 1) if spread else 1 / np.linalg.norm(v)
        rows.append((i, label, [float(x) for x in v.astype(np.float32)]))
    return rows


ODD = [
    (1000, None, [0.5] * 12), (1050, 1, None), (1100, 2, [float("nan")] + [0.1] * 11), (1150, 2, [float("inf")] * 12), (1200, 3, [None] + [0.2] * 11),
    (None, 1, [0.9] * 12), (None, 2, [0.8] * 12), (2000, 1, [0.0] * 12), (2050, 2, [-0.5] * 12), (2100, 1, [0.9] * 12), (2100, 1, [0.9] * 12),
    (2101, 1, [0.9] * 12), (2102, 2, [0.7] * 12), (2103, 3, [0.7] * 12), (2150, 2, [0.3] * 12), (2150, 3, [0.3] * 12),
]


def mined(spark, rows, job):
    return sorted((tuple(r) for r in hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), job).collect()), key=repr)


@pytest.mark.parametrize("spread", [True, False])
def test_mining_against_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(hard_negatives, "_BUCKET", 64)
    monkeypatch.setattr(hard_negatives, "_ANCHORS", 5)
    job = Mining(every=7 if spread else 50)
    rows = random_rows(spread=spread) + ODD
    want = brute_mine(rows, job)
    assert len(want) > 50 and mined(spark, rows, job) == want


def test_mining_of_equal_vectors(spark, monkeypatch):
    """A third of all rows have one vector, over several buckets; ties go to the least ids."""
    monkeypatch.setattr(hard_negatives, "_BUCKET", 16)
    rows = random_rows(120) + [(500 + i, i % 3, [1.0] * 12) for i in range(60)] + [(700 + i, 4, [0.9] * 12) for i in range(5)]
    job = Mining(every=10)
    assert mined(spark, rows, job) == brute_mine(rows, job)


def test_mining_of_large_components(spark):
    """Scores beyond what floating point holds, and ranges whose hundredfold is beyond it, to the last unit."""
    big = [(i, l, [1000.0 * x for x in v]) for i, l, v in random_rows(200, spread=False)]
    wide = [(i, l, [3e5 * x for x in v]) for i, l, v in random_rows(200, seed=3, spread=False)]
    edge = []
    for k in range(8):
        a, p = [(1 << 23) + 2 * k + 1, 1], [(1 << 23) + 77777 * k + 13, 5 * k]
        score = a[0] * p[0] + a[1] * p[1]
        ends = [95 * score // 100 + d for d in (0, 1)] + [-(-50 * score // 100) - d for d in (0, 1)]
        negatives = [(100 * k + 10 + j, 100 + k, [*divmod(t, a[0])]) for j, t in enumerate(ends)]
        edge.append([(i, l, [x / 256 for x in v]) for i, l, v in [(100 * k, k, a), (100 * k + 1, k, p), *negatives]])
    for rows in (big, wide, *edge):
        want = brute_mine(rows, job := Mining(every=10 if len(rows) > 50 else 100))
        assert want and mined(spark, rows, job) == want
    with pytest.raises(Exception, match="cannot be computed exactly"):
        mined(spark, [(50, 1, [1e8]), (51, 1, [1e8])], Mining())


def test_mining_of_nothing(spark):
    assert mined(spark, [], Mining()) == []
    assert mined(spark, [(50, 1, [1.0])], Mining()) == []
    assert mined(spark, [(1, 1, [1.0]), (2, 2, [1.0])], Mining()) == []
    extra = spark.createDataFrame([(50, 1, [1.0], "x", 1), (51, 1, [1.0], "y", 2), (52, 2, [0.9], "z", 3)], SCHEMA + ", RANK string, `anchor_id` int")
    assert [tuple(r) for r in hard_negatives.mine(extra).collect()] == [(50, 51, 1, 52, 65536, 58880)]
    with pytest.raises(Exception, match="several lengths"):
        mined(spark, [(50, 1, [1.0]), (51, 1, [1.0, 2.0])], Mining())


def test_pruning_keeps_all_rows_that_reach_the_threshold():
    rng = np.random.default_rng(2)
    pruned = 0
    for seed in range(30):
        n, width = 80, int(rng.integers(1, 9))
        vectors = rng.integers(-60, 60, (n, width))
        rows = hard_negatives.Rows(np.arange(n), np.ones(n, bool), np.zeros(n, int), vectors)
        bucket = hard_negatives.Bucket(rows)
        anchors = rng.integers(-60, 60, (20, width)).astype(float)
        scores = anchors @ vectors.T
        limits = np.quantile(scores, rng.uniform(0.5, 1), axis=1)
        reached = np.zeros(scores.shape, bool)
        for some, found, exact in hard_negatives.candidates(anchors, limits, bucket):
            assert (exact == scores[np.ix_(some, found)]).all()
            reached[np.ix_(some, found)] = True
        assert not (~reached & (scores >= limits[:, None])).any()
        pruned += (~reached).sum()
    assert pruned > 1000


# --- codes ------------------------------------------------------------------------------------------


def brute_codes(rows, coding):
    rows = sorted(whole_rows(rows, coding.scale), key=lambda r: (by_id(r[0]), [r2 for r2 in r[2]]))
    width = len(rows[0][2]) // coding.parts
    x = np.array([r[2] for r in rows]).reshape(len(rows), coding.parts, width)
    books = [x[: coding.entries, p].copy() for p in range(coding.parts)]

    def nearest(p):
        squares = ((x[:, p][:, None] - books[p][None]) ** 2).sum(axis=2)
        return squares.argmin(axis=1), squares.min(axis=1)

    for _ in range(coding.rounds):
        for p in range(coding.parts):
            code = nearest(p)[0]
            for e in np.unique(code):
                members = x[code == e, p]
                books[p][e] = members.sum(axis=0) // len(members)
    codes, errors = zip(*(nearest(p) for p in range(coding.parts)))
    out = [(r[0], bytes(int(c[k]) for c in codes), int(sum(e[k] for e in errors))) for k, r in enumerate(rows)]
    return sorted(out, key=repr), np.stack(books)


@pytest.mark.parametrize("coding", [Coding(entries=16), Coding(entries=40, parts=2, rounds=6), Coding(entries=256, parts=3)])
def test_codes_against_brute_force(spark, coding):
    rows = random_rows(600, seed=4) + ODD + [(3000 + i, 1, [0.25] * 12) for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    coded, books = ball_kmeans.compress(df, coding)
    want, want_books = brute_codes(rows, coding)
    assert (books == want_books).all()
    assert sorted(((r.vec_id, bytes(r.code), r.error) for r in coded.collect()), key=repr) == want


def test_cores_and_rings_change_nothing():
    rng = np.random.default_rng(8)
    stable = 0
    for _ in range(20):
        centres = rng.integers(-20, 20, (30, 3))
        centres[rng.integers(0, 30, 4)] = centres[0]  # entries at one place
        points = np.concatenate([c + rng.integers(-3, 4, (40, 3)) for c in centres])
        now, best = ball_kmeans.nearest(points, centres)
        radii = np.zeros(30, np.int64)
        np.maximum.at(radii, now, np.ceil(np.sqrt(best)).astype(int))
        moved = centres + rng.integers(-1, 2, centres.shape)
        balls = ball_kmeans.Balls.around(moved, radii + 2)
        code, error = ball_kmeans.reassign(points, now, balls)
        want, want_error = ball_kmeans.nearest(points, moved)
        assert (code == want).all() and (error == want_error).all()
        stable += (balls.reach < 29).sum()
    assert stable > 100  # some entries have fewer neighbours than there are entries


def test_codes_of_few_or_no_vectors(spark):
    coded, books = ball_kmeans.compress(spark.createDataFrame([], SCHEMA + ", CODE string, extra int"))
    assert coded.columns == ["vec_id", "label", "embedding", "extra", "code", "error"] and coded.count() == 0 and books.size == 0
    rows = [(2, None, [1.0] * 4, 1), (1, None, [0.5] * 4, 2), (7, 3, None, 3), (8, 3, [None] * 4, 4)]
    coded, _ = ball_kmeans.compress(spark.createDataFrame(rows, SCHEMA + ", error int"))
    found = ball_kmeans.label_errors(coded).orderBy("vec_id").collect()
    assert [(r.vec_id, bytes(r.code), r.error, r.label_error) for r in found] == [(1, b"\0\0\0\0", 0, 0), (2, b"\1\1\1\1", 0, 0)]
    for bad in ([(1, 1, [1.0] * 4), (2, 1, [1.0] * 8)], [(1, 1, [1.0] * 5)]):
        with pytest.raises(Exception, match="components|lengths"):
            ball_kmeans.compress(spark.createDataFrame(bad, SCHEMA))[0].collect()


def test_label_errors_take_nulls_together(spark):
    coded = spark.createDataFrame([(1, None, 5), (2, None, 6), (3, 1, 7), (4, 1, 8)], "vec_id long, label int, error long")
    assert {r.vec_id: r.label_error for r in ball_kmeans.label_errors(coded).collect()} == {1: 11, 2: 11, 3: 15, 4: 15}
