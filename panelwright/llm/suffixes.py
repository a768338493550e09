"""Byte strings that repeat across documents, by sorted suffixes in range-partitioned buckets.

Matches have a least length, so only suffixes that start at chosen places need to be sorted: every string of that length names one
of its eight-byte tokens, the one with the least hash (the first of several), by its own bytes alone. Equal strings name the same token
at the same offset, and successive strings of a text mostly share it. What is sorted is thus one suffix per named token, with the few
bytes before it that its strings cover; each string of a text belongs to just one suffix.

A sample of suffixes gives splitters by their three leading tokens, and suffixes are dealt into buckets between them; a prefix that
holds several splitters is spread over all their buckets. Each bucket sorts its suffixes by multikey quicksort, eight bytes a character,
and the bytes before them the same way, from the token backwards. In both orders strings of any length that are equal stand together, so
equal strings are found by two ranks, and no bytes are hashed. Strings that a splitter does not tell from those of the next bucket are
compared across boundaries: each bucket sends the least document it has for such a string, once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.scalars import quoted
from panelwright.llm.common import pick, python_tasks, staged, without
from panelwright.session import Staging

TOKEN = 8
#: Leading tokens of a splitter.
_LEAD = 3
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text taken at once in a task, and behind one bucket on average.
_BLOCK, _BUCKET = 4 << 20, 7 << 20
#: Most buckets (beyond, they grow), least bytes of documents from which splitters are drawn, sampled suffixes per bucket and in all.
_MOST_BUCKETS, _SAMPLE, _PER_BUCKET, _MOST_SAMPLED = 1 << 20, 32 << 20, 64, 1 << 22
#: Bytes of text for each chosen suffix of 50-byte strings, about.
_APART = 22
_SLICE = 1 << 14


# --- chosen suffixes, in tasks ----------------------------------------------------------------------


def tokens(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, the first byte highest."""
    n = len(data) - TOKEN + 1
    found = np.empty(n, np.uint64)
    raw = data.tobytes()
    for i in range(min(TOKEN, n)):
        part = np.frombuffer(raw, ">u8", count=(n - i + TOKEN - 1) // TOKEN, offset=i)
        found[i::TOKEN] = part
    return found


@dataclass
class Suffixes:
    """Named tokens of a stretch of text: ``start`` of the first string that names each, ``strings`` that do, place of the
    token, and the text's number."""

    start: np.ndarray
    strings: np.ndarray
    token: np.ndarray
    text: np.ndarray


def choose(data: np.ndarray, ends: np.ndarray, length: int) -> Suffixes:
    """Suffixes of texts that lie one after the other in ``data``; no string reaches over the end of its text."""
    width = length - TOKEN + 1
    n = len(data) - length + 1
    if n <= 0:
        return Suffixes(*(np.empty(0, np.int64) for _ in range(4)))
    # hash above, place below: the least is the first of the least hashes
    least = tokens(data)
    least *= _ODD
    least &= np.uint64(0xFFFFFFFF00000000)
    least |= np.arange(len(least), dtype=np.uint32)
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    named = least.astype(np.uint32)  # the place
    del least
    valid = np.zeros(n + 1, np.int8)
    begins = np.append(0, ends[:-1])
    whole = ends - begins >= length
    np.add.at(valid, begins[whole], 1)
    np.add.at(valid, ends[whole] - length + 1, -1)
    valid = np.cumsum(valid[:-1], dtype=np.int8).view(bool)
    fresh = valid.copy()
    fresh[1:] &= ~valid[:-1] | (named[1:] != named[:-1])
    start = np.flatnonzero(fresh)
    # a run ends before the next fresh start, or with the text's last string
    last = np.searchsorted(ends, start, side="right")
    stop = np.minimum(np.append(start[1:], n), ends[last] - length + 1)
    return Suffixes(start, stop - start, named[start].astype(np.int64), last)


def _lead(data: np.ndarray, found: Suffixes, length: int) -> np.ndarray:
    """The leading tokens of each suffix; zeros stand after the end of its last string."""
    end = found.start + found.strings + length - 1
    return _characters(data, found.token, end, _LEAD, 1)


def _characters(data: np.ndarray, first: np.ndarray, limit: np.ndarray, count: int, step: int) -> np.ndarray:
    """Characters of eight bytes from ``first`` on, forwards up to ``limit`` or backwards (``step`` -1) down to it; zeros beyond."""
    found = np.empty((len(first), count), np.uint64)
    along = np.arange(count * TOKEN)
    for a in range(0, len(first), _SLICE):
        at = first[a : a + _SLICE, None] + step * along
        inside = at < limit[a : a + _SLICE, None] if step > 0 else at >= limit[a : a + _SLICE, None]
        taken = np.where(inside, data[np.clip(at, 0, len(data) - 1)], 0).astype(np.uint8)
        found[a : a + _SLICE] = np.ascontiguousarray(taken).view(">u8")
    return found


def bucket_of(lead: np.ndarray, splitters: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Bucket b holds what is not less than splitter b - 1 and less than splitter b; equal splitters share theirs by salt."""
    if not len(splitters):
        return np.zeros(len(lead), np.int64)
    low = np.searchsorted(splitters[:, 0], lead[:, 0], side="left")
    high = np.searchsorted(splitters[:, 0], lead[:, 0], side="right")
    close = np.flatnonzero(low < high)
    if len(close):  # as bytes, which compare in the order of the numbers
        key, cuts = (np.ascontiguousarray(x.astype(">u8")).view(f"V{_LEAD * TOKEN}").ravel() for x in (lead[close], splitters))
        rank = np.unique(np.concatenate([cuts, key]), return_inverse=True)[1]
        cut_rank, key_rank = rank[: len(cuts)], rank[len(cuts) :]
        a, b = np.searchsorted(cut_rank, key_rank, side="left"), np.searchsorted(cut_rank, key_rank, side="right")
        several = np.maximum(b - a, 1)
        high[close] = b - salt[close].astype(np.uint64) % several.astype(np.uint64)
    return high.astype(np.int64)


def _pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Stretches of about ``_BLOCK`` bytes: the bytes, where each piece of a text ends, ids, keys, and the place of its first byte
    in its text. Longer texts come in pieces that overlap by all but one byte of a string."""
    held, size = [], 0

    def out():
        data, ids, keys, at = zip(*held)
        sizes = np.array([len(d) for d in data], np.int64)
        return np.frombuffer(b"".join(data), np.uint8), np.cumsum(sizes), np.array(ids, np.int64), np.array(keys, np.int64), np.array(at, np.int64)

    for batch in batches:
        for id_, key, text in zip(batch.column("id").to_pylist(), batch.column("key").to_pylist(), batch.column("text")):
            text = text.as_py()
            for at in range(0, max(len(text) - length + 1, 0), _BLOCK):
                piece = text[at : at + _BLOCK + length - 1]
                held.append((piece, id_, key, at))
                size += len(piece)
                if size >= _BLOCK:
                    yield out()
                    held, size = [], 0
    if held:
        yield out()


def _sampled(length: int, every: int):
    """Leading tokens of one suffix in ``every`` of the given texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, ends, *_ in _pieces(batches, length):
            found = choose(data, ends, length)
            lead = _lead(data, found, length)[::every]
            yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in lead.T.copy()], [f"t{i}" for i in range(_LEAD)])

    return run


def _dealt(sent, length: int):
    """The suffixes of each bucket in a stretch of text as one packed row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitters = sent.value
        for data, ends, ids, keys, at in _pieces(batches, length):
            found = choose(data, ends, length)
            begin = at - np.append(0, ends[:-1])  # place in the text less place in the stretch
            bucket = bucket_of(_lead(data, found, length), splitters, keys[found.text] + found.token)
            order = np.argsort(bucket, kind="stable")
            met, first = np.unique(bucket[order], return_index=True)
            rows = []
            for members in np.split(order, first[1:]):
                some = Suffixes(*(x[members] for x in (found.start, found.strings, found.token, found.text)))
                rows.append(_packed(data, some, ids, keys, begin, length))
            for a in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays([pa.array(met[a : a + 64], pa.int32()), pa.array(rows[a : a + 64], pa.binary())], ["bucket", "packed"])

    return run


def _packed(data: np.ndarray, some: Suffixes, ids: np.ndarray, keys: np.ndarray, begin: np.ndarray, length: int) -> bytes:
    """Suffixes with the bytes of their strings, in the order of the texts, compressed."""
    import zstandard

    sizes = some.strings + length - 1
    ends = np.cumsum(sizes)
    text = data[np.repeat(some.start - (ends - sizes), sizes) + np.arange(int(ends[-1]))]
    texts, counts = np.unique(some.text, return_counts=True)
    places = some.start + begin[some.text]
    parts = [np.array([len(texts), len(sizes)], "<i8"), ids[texts], keys[texts], counts.astype("<i8")]
    parts += [np.diff(places, prepend=0).astype("<i8"), some.strings.astype("u1"), (some.token - some.start).astype("u1"), text]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(p).tobytes() for p in parts))


@dataclass
class Bucket:
    """Suffixes of a bucket: the bytes of their strings one after the other, where each begins and ends there, its token there, its
    strings, its document and key, and the place of its first byte in the document."""

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    token: np.ndarray
    strings: np.ndarray
    doc: np.ndarray
    key: np.ndarray
    place: np.ndarray

    @classmethod
    def read(cls, rows: list[bytes], length: int) -> Bucket:
        import zstandard

        texts, columns = [], []
        inflate = zstandard.ZstdDecompressor()
        for k, row in enumerate(rows):
            raw, rows[k] = inflate.decompress(row), None
            m, n = np.frombuffer(raw, "<i8", 2)
            parts, at = [], 16
            for kind, count in (("<i8", m), ("<i8", m), ("<i8", m), ("<i8", n), ("u1", n), ("u1", n)):
                parts.append(np.frombuffer(raw, kind, int(count), at))
                at += int(count) * np.dtype(kind).itemsize
            ids, keys, counts, steps, strings, token = parts
            texts.append(np.frombuffer(raw, np.uint8, offset=at))
            columns.append((np.repeat(ids, counts), np.repeat(keys, counts), np.cumsum(steps), strings.astype(np.int64), token.astype(np.int64)))
        doc, key, place, strings, token = (np.concatenate(c) for c in zip(*columns))
        sizes = strings + length - 1
        end = np.cumsum(sizes)
        return cls(np.concatenate(texts), end - sizes, end, end - sizes + token, strings, doc, key, place)


# --- sorting ----------------------------------------------------------------------------------------


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Order of rows of characters by multikey quicksort: rows are sorted by one character, and only groups of several rows that
    are equal so far are sorted by the next, all groups of a level at once."""
    order = np.argsort(rows[:, 0], kind="stable")
    equal = rows[order[1:], 0] == rows[order[:-1], 0]
    for c in range(1, rows.shape[1]):
        tied = np.flatnonzero(np.append(equal, False) | np.append(False, equal))
        if not len(tied):
            break
        group = np.cumsum(np.append(False, ~equal))[tied]
        members = order[tied]
        order[tied] = members[np.lexsort((rows[members, c], group))]
        values = rows[order[tied], c]
        same = (values[1:] == values[:-1]) & (group[1:] == group[:-1])
        equal = np.zeros(len(order) - 1, bool)
        equal[tied[:-1][same]] = True
    return order


def common_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bytes that rows of characters have in common."""
    differ = a ^ b
    where = (differ != 0).argmax(axis=1)
    first = differ[np.arange(len(differ)), where]
    zeros = sum((first < np.uint64(1 << (8 * (TOKEN - i)))).astype(np.int64) for i in range(1, TOKEN))
    return np.where((differ != 0).any(axis=1), where * TOKEN + zeros, rows_bytes(a))


def rows_bytes(rows: np.ndarray) -> int:
    return rows.shape[1] * TOKEN


def _ranked(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, bytes in common with the row before in it, and the most bytes each row has in common with another."""
    order = multikey_order(rows)
    common = np.zeros(len(order), np.int64)
    for a in range(1, len(order), _SLICE):
        b = min(a + _SLICE, len(order))
        common[a:b] = common_bytes(rows[order[a:b]], rows[order[a - 1 : b - 1]])
    most = np.empty(len(order), np.int64)
    most[order] = np.maximum(common, np.append(common[1:], 0))
    return order, common, most


def compare(bucket: Bucket, length: int, bounds: tuple[np.ndarray | None, np.ndarray | None], hot: np.ndarray | None):
    """Stretches of documents covered by strings that a lesser document has in this bucket, and strings to be compared across
    boundaries, those of their least document only.

    ``bounds``: the splitters on either side. ``hot``: those of them that are several splitters at once.
    """
    n, width = len(bucket.begin), length - TOKEN + 1
    right_rows = _characters(bucket.data, bucket.token, bucket.end, -(-length // TOKEN), 1)
    right, right_common, right_most = _ranked(right_rows)
    # bytes by which a suffix and a splitter agree: shorter prefixes may go on behind the boundary
    shared = np.zeros(n, np.int64)
    for bound in bounds:
        if bound is not None:
            lead = right_rows[:, :_LEAD]
            agree = common_bytes(lead, np.broadcast_to(bound, lead.shape))
            shared = np.maximum(shared, agree)
            if hot is not None and any((bound == h).all() for h in hot):
                shared[agree == _LEAD * TOKEN] = length
    del right_rows
    most_before = bucket.token - bucket.begin  # bytes before the token in the first string, fewer in each later one
    least_before = most_before - bucket.strings + 1
    open_ = np.flatnonzero(np.maximum(right_most, shared) >= np.maximum(length - most_before, TOKEN))
    left_rows = _characters(bucket.data, bucket.token[open_] - 1, bucket.begin[open_], -(-(width - 1) // TOKEN) or 1, -1)
    left, left_common, left_most = _ranked(left_rows)
    del left_rows
    place_right = np.empty(n, np.int64)
    place_right[right] = np.arange(n)
    at_right = place_right[open_]
    lo, hi = np.full(len(open_), width, np.int64), np.full(len(open_), -1, np.int64)
    right_most, shared = right_most[open_], shared[open_]
    most_before, least_before, doc = most_before[open_], least_before[open_], bucket.doc[open_]
    rank = np.empty(len(open_), np.int64)
    edge_rows, edge_before = [], []
    for before in range(width):
        after = length - before
        within = (least_before <= before) & (before <= most_before)
        edge = within & (shared >= after)
        some = np.flatnonzero(edge | within & (right_most >= after) & (left_most >= before))
        if not len(some):
            continue
        rank[left] = np.cumsum(left_common < before)
        key = np.cumsum(right_common < after)[at_right[some]] * (len(open_) + 1) + rank[some]
        order = np.argsort(key, kind="stable")
        some, key = some[order], key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        least = np.repeat(np.minimum.reduceat(doc[some], first), np.diff(np.append(first, len(some))))
        later = some[doc[some] > least]
        lo[later] = np.minimum(lo[later], before)
        hi[later] = np.maximum(hi[later], before)
        own = some[(doc[some] == least) & edge[some]]
        edge_rows.append(open_[own])
        edge_before.append(np.full(len(own), before))
    found = np.flatnonzero(hi >= 0)
    rows = open_[found]
    # strings of one token overlap, so what they cover is one stretch
    token = bucket.place[rows] + bucket.token[rows] - bucket.begin[rows]
    spans = bucket.doc[rows], bucket.key[rows], token - hi[found], token - lo[found] + length
    rows, before = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (edge_rows, edge_before))
    start = bucket.token[rows] - before
    return spans, (rows, start, bucket.place[rows] + start - bucket.begin[rows])


_STRETCH = "id long, key long, start long, end long, string binary"


def _compared(sent, length: int):
    def run(table: pa.Table) -> pa.Table:
        splitters = sent.value
        b = table.column("bucket")[0].as_py()
        bucket = Bucket.read(table.column("packed").to_pylist(), length)
        sides = (splitters[b - 1] if b > 0 else None, splitters[b] if b < len(splitters) else None)
        same = (splitters[1:] == splitters[:-1]).all(axis=1) if len(splitters) > 1 else np.empty(0, bool)
        spans, (rows, at, start) = compare(bucket, length, sides, splitters[1:][same] if same.any() else None)
        strings = [bucket.data[a : a + length].tobytes() for a in at.tolist()]
        n = len(spans[0])
        columns = [np.concatenate(c) for c in zip(spans, (bucket.doc[rows], bucket.key[rows], start, start + length))]
        kinds = [pa.array(c, pa.int64()) for c in columns] + [pa.array([None] * n + strings, pa.binary())]
        return pa.table(dict(zip(("id", "key", "start", "end", "string"), kinds)))

    return run


# --- on Spark ---------------------------------------------------------------------------------------


def _splitters(texts: DataFrame, length: int, total: int) -> np.ndarray:
    """Leading tokens that cut the sampled suffixes into equal parts, ascending; 24 bytes for each of ``_MOST_SAMPLED`` suffixes at most."""
    buckets = min(-(-total // _BUCKET), _MOST_BUCKETS)
    if buckets < 2:
        return np.empty((0, _LEAD), np.uint64)
    wanted = min(buckets * _PER_BUCKET, _MOST_SAMPLED)
    read = min(total, max(_SAMPLE, wanted * _APART))
    sample = texts.where(F.pmod(F.xxhash64("key", F.lit(7)), F.lit(total // read)) == 0)
    every = max(1, read // _APART // wanted)
    rows = sample.mapInArrow(_sampled(length, every), ", ".join(f"t{i} long" for i in range(_LEAD)))
    met = rows.toArrow()
    lead = np.stack([met.column(i).to_numpy().view(np.uint64) for i in range(_LEAD)], axis=1) if met.num_rows else np.empty((0, _LEAD), np.uint64)
    if len(lead) < buckets:
        return np.empty((0, _LEAD), np.uint64)
    lead = lead[np.lexsort(lead.T[::-1])]
    return lead[np.arange(1, buckets) * len(lead) // buckets]


def repeated_stretches(df: DataFrame, scratch: Staging, length: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, key, start, end``: stretches of texts (as bytes of UTF-8) covered by strings of ``length`` bytes that also start in a
    document with a lesser id. ``key`` is a hash of the text, for rows that share an id. Stretches may overlap."""
    if not 2 * TOKEN <= length <= 128:
        raise ValueError("lengths from 16 to 128 bytes")
    python_tasks(df.sparkSession)
    rows = pick(df, doc_id, text).toDF("id", "text").select(F.col("id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    rows = rows.where(F.col("id").isNotNull() & (F.octet_length("text") >= length)).withColumn("key", F.xxhash64("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    sent = df.sparkSession.sparkContext.broadcast(_splitters(rows, length, total))
    dealt = rows.select("id", "key", "text").mapInArrow(_dealt(sent, length), "bucket int, packed binary")
    met = scratch.put(dealt.groupBy("bucket").applyInArrow(_compared(sent, length), _STRETCH))
    # across boundaries: a row for each string and bucket, from the least document that has it there
    edges = met.where("string is not null")
    least = edges.groupBy("string").agg(F.min("id").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    behind = edges.join(least, "string").where("id > least")
    return met.where("string is null").drop("string").unionByName(behind.select("id", "key", "start", "end"))


def _cut(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[list[dict], bytes]:
    """The maximal runs that stretches make up, and the text without them."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.append(True, starts[1:] > ends[:-1])
    first, last = starts[fresh], ends[np.append(np.flatnonzero(fresh)[1:] - 1, len(ends) - 1)]
    kept = b"".join(text[a:b] for a, b in zip([0, *last.tolist()], [*first.tolist(), len(text)]))
    return [{"start": a, "end": b} for a, b in zip(first.tolist(), last.tolist())], kept


def without_repeats(df: DataFrame, length: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The frame with ``spans`` (start and end of the maximal runs of removed bytes) and ``kept`` (the bytes that are left).

    A byte is removed if a string of ``length`` bytes covers it that also starts in a document with a lesser id. Strings are judged on
    the input, in UTF-8; they may overlap and never cross documents. A null text counts as empty. A row with a null id keeps
    all and takes nothing from others. Rows of one id take nothing from one another, equal or not. All rows and columns stay;
    columns named like an output are replaced. Texts of any length are taken whole, in pieces.

    Bytes move twice: the chosen suffixes once, compressed, and the texts once to meet what is removed from them.
    """
    spark = df.sparkSession
    python_tasks(spark)
    cut_type = "struct<spans:array<struct<start:long,end:long>>,kept:binary>"

    @F.arrow_udf(cut_type)
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct([("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])
        for texts, found in batches:
            rows = []
            for t, f in zip(texts, found):
                if not f.is_valid:
                    rows.append(None)
                    continue
                stretches = f.values
                spans, kept = _cut(t.as_py(), stretches.field("start").to_numpy(), stretches.field("end").to_numpy())
                rows.append({"spans": spans, "kept": kept})
            yield pa.array(rows, kind)

    with Staging(spark) as scratch:
        found = repeated_stretches(df, scratch, length, doc_id, text)
        per_text = found.groupBy(F.col("id").alias("__id"), F.col("key").alias("__key")).agg(F.collect_list(F.struct("start", "end")).alias("__found"))
        per_text = staged(per_text, "stretches")  # outlives the scratch folder
        data = F.coalesce(quoted(text).cast("binary"), F.lit(b""))
        marked = without(df, "spans", "kept").withColumns({"__id": quoted(doc_id).cast("long"), "__key": F.xxhash64(quoted(text).cast("binary"))})
        joined = marked.join(per_text, ["__id", "__key"], "left")
        hit = F.col("__found").isNotNull()
        made = joined.withColumn("__cut", cut(F.when(hit, data), F.col("__found")))
        spans = F.coalesce(F.col("__cut.spans"), F.array().cast("array<struct<start:long,end:long>>"))
        result = made.withColumns({"spans": spans, "kept": F.coalesce(F.col("__cut.kept"), data)})
        return result.drop("__id", "__key", "__found", "__cut")
