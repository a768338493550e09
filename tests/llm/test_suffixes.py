"""Repeated byte strings, against plain Python: whole tables, many small buckets, hot prefixes, and odd rows."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelwright.llm import suffixes


def brute(rows, length):
    """Per row: maximal removed runs and the bytes that are left."""
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, t in data:
        if i is not None:
            for a in range(len(t) - length + 1):
                k = t[a : a + length]
                first[k] = min(first.get(k, i), i)
    found = []
    for i, t in data:
        gone = np.zeros(len(t) + 1, bool)
        for a in range(len(t) - length + 1) if i is not None else ():
            if first[t[a : a + length]] < i:
                gone[a : a + length] = True
        edge = np.flatnonzero(np.diff(gone.astype(int), prepend=0))
        spans = [(int(a), int(b)) for a, b in zip(edge[::2], edge[1::2])]
        kept = bytes(x for x, g in zip(t, gone) if not g)
        found.append((i, t, spans, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=repr)


def run(spark, rows, length=50):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = suffixes.without_repeats(df, length).collect()
    return sorted(((r.doc_id, (r.text or "").encode(), [tuple(s) for s in r.spans], hashlib.sha256(r.kept).hexdigest()) for r in out), key=repr)


def corpus(seed=3, n=60):
    rng = np.random.default_rng(seed)
    words = ["über", "das", "haus", "of", "the", "and", "cat", "a", "longerwordhere", "x" * 70, "日本語"]
    passages = [" ".join(rng.choice(words, 30)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [" ".join(rng.choice(words, rng.integers(0, 60))) for _ in range(3)]
        for _ in range(rng.integers(0, 3)):
            parts.insert(int(rng.integers(0, len(parts))), str(rng.choice(passages)))
        rows.append((int(i), "\n".join(parts)))
    rows += [(200 + i, rows[i][1]) for i in range(8)] + [(300 + i, rows[i][1][7:-9] + "!") for i in range(8)]
    return rows


ODD = [
    (1, None), (2, ""), (3, "short"), (4, "-" * 300), (5, "-" * 120 + "tail"), (6, "ab" * 200), (7, "ba" * 90), (8, "z" * 50), (9, "z" * 49),
    (10, "z" * 51), (None, "z" * 80), (None, "-" * 300), (11, "é" * 60), (12, "\x00" * 90), (13, "\x00" * 70 + "q"), (14, "same id " * 20),
    (14, "same id " * 20), (14, "other text of the same id " * 5), (15, "other text of the same id " * 4), (-5, "negative ids come first " * 4),
    (16, "negative ids come first " * 4),
]


@pytest.mark.parametrize("length", [16, 50])
def test_against_brute_force(spark, length):
    rows = corpus() + ODD
    assert run(spark, rows, length) == brute(rows, length)


@pytest.mark.parametrize("bucket", [300, 3000])
def test_strings_across_bucket_boundaries(spark, monkeypatch, bucket):
    """Buckets of a few suffixes: nearly every string lies at a boundary, and hot prefixes fill several buckets."""
    monkeypatch.setattr(suffixes, "_BUCKET", bucket)
    rows = corpus(5) + ODD + [(1000 + i, "every document starts with this hot line of text, no matter what " + str(i * 7919)) for i in range(80)]
    assert run(spark, rows) == brute(rows, 50)


def test_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "_BLOCK", 256)
    rows = corpus(9, 20) + ODD
    assert run(spark, rows) == brute(rows, 50)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, SPANS int, kept string, extra int")
    got = suffixes.without_repeats(empty)
    assert got.columns == ["doc_id", "text", "extra", "spans", "kept"] and got.count() == 0
    rows = [(1, "t" * 60, 7, "k", None), (2, "t" * 60, None, None, 3)]
    got = suffixes.without_repeats(spark.createDataFrame(rows, empty.schema)).orderBy("doc_id").collect()
    assert [(r.extra, r.kept) for r in got] == [(None, b"t" * 60), (3, b"")]


def test_a_prefix_of_equal_splitters_is_spread():
    cuts = np.array([[1, 0, 0], [5, 5, 5], [5, 5, 5], [5, 5, 5], [9, 0, 0]], np.uint64)
    lead = np.array([[5, 5, 5]] * 60 + [[0, 9, 9], [1, 0, 0], [5, 5, 4], [5, 5, 6], [9, 9, 9]], np.uint64)
    got = suffixes.bucket_of(lead, cuts, np.arange(65))
    assert set(got[:60].tolist()) == {2, 3, 4} and got[60:].tolist() == [0, 1, 1, 4, 5]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=24, max_size=24), min_size=1, max_size=60), st.integers(1, 3))
def test_multikey_order(rows, alphabet):
    rows = [bytes(b % (alphabet + 1) for b in r) for r in rows]
    found = np.frombuffer(b"".join(rows), ">u8").reshape(-1, 3).astype(np.uint64)
    order = suffixes.multikey_order(found)
    assert [rows[i] for i in order] == sorted(rows)
    common = suffixes.common_bytes(found[order[1:]], found[order[:-1]])
    for k, n in enumerate(common.tolist()):
        a, b = rows[order[k]], rows[order[k + 1]]
        assert a[:n] == b[:n] and (n == 24 or a[n] != b[n])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab ", max_size=120), min_size=1, max_size=5))
def test_every_string_has_one_suffix_and_equal_strings_the_same_token(texts):
    data = "".join(texts).encode()
    ends = np.cumsum([len(t) for t in texts])
    found = suffixes.choose(np.frombuffer(data, np.uint8), ends, 20)
    covered, offset = [], {}
    for start, strings, token in zip(found.start.tolist(), found.strings.tolist(), found.token.tolist()):
        for a in range(start, start + strings):
            covered.append(a)
            assert 0 <= token - a <= 12
            assert offset.setdefault(data[a : a + 20], token - a) == token - a
    assert covered == [a for b, e in zip(np.append(0, ends[:-1]), ends) for a in range(b, e - 19)]
