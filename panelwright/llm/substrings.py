"""Repeated passages across documents, by content-defined chunks.

A gear hash rolls over the bytes of a text; a chunk ends after a word where the hash has a given pattern. Chunk ends
depend on a few bytes before them only, so an insertion moves no chunk but its own. Groups of successive chunks that hold some
words are deduplicated by digest: the document with the least id keeps a group, and runs of overlapping groups that others
repeat are removed if they are long enough. So chunks count only next to the neighbours they have in another document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import join_bounded, pick, put, python_tasks, staged

#: Bytes the gear hash looks back.
_LOOK = 16
#: One random 32-bit number per byte value.
_GEAR = np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint32)


@dataclass(frozen=True)
class Cut:
    """``every``: words of a chunk on average. ``longest``: words after which a chunk ends anyway.

    ``min_words``: least run of repeated chunks that counts as a passage. A repeated passage loses the chunks that its ends
    cut through, about ``2 * every + 3`` words, so most passages of 50 words are found by runs of 20.
    ``together``: words of successive chunks that must stand in one other document as they are.
    """

    every: int = 4
    longest: int = 64
    min_words: int = 20
    together: int = 10


def gear_hash(data: bytes) -> np.ndarray:
    """The rolling gear hash after each byte: ``h = 2 h + gear[byte]``, over the last 16 bytes.

    Shifted sums of doubling width give all positions at once.
    """
    h = _GEAR[np.frombuffer(data, np.uint8)]
    width = 1
    while width < _LOOK:
        moved = h[:-width] << np.uint32(width)
        h = h.copy()
        h[width:] += moved
        width *= 2
    return h


def chunk_ends(words: list[bytes], cut: Cut) -> np.ndarray:
    """Number of words before each chunk's end. The text's words alone count, joined by one blank."""
    if not words:
        return np.empty(0, np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    last = np.cumsum(sizes + 1) - 2
    hashes = gear_hash(b" ".join(words))[last]
    # the upper half of the hash holds the whole look-back
    hit = (hashes >> np.uint32(_LOOK)) % np.uint32(cut.every) == 0
    hit[-1] = True
    ends = np.flatnonzero(hit) + 1
    gaps = np.diff(ends, prepend=0)
    if gaps.max() <= cut.longest:
        return ends
    parts = [np.append(np.arange(e - g + cut.longest, e, cut.longest), e) for e, g in zip(ends, gaps)]
    return np.concatenate(parts)


def chunk_groups(ends: np.ndarray, together: int) -> list[tuple[int, int]]:
    """Words before and after each group: the shortest runs of chunks with ``together`` words from each chunk on and up to each chunk.

    With pairs of neighbours that have as many words each, they cover every chunk and every border within a run of that many words.
    """
    return list(zip(*(x.tolist() for x in _group_bounds(ends, together))))


def _group_bounds(ends: np.ndarray, together: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``chunk_groups``, in two arrays."""
    n = len(ends)
    starts = np.append(0, ends[:-1]) if n else ends
    last = np.searchsorted(ends, starts + together)
    first = np.searchsorted(starts, ends - together, side="right") - 1
    long = ends - starts >= together
    pair = np.flatnonzero(long[:-1] & long[1:])
    begin = np.concatenate([starts[last < n], starts[first[first >= 0]], starts[pair]])
    end = np.concatenate([ends[last[last < n]], ends[first >= 0], ends[pair + 1]])
    both = np.unique(begin.astype(np.int64) << 32 | end)
    return both >> 32, both & 0xFFFFFFFF


def _groups(cut: Cut, places: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                digests, docs, keys, at = [], [], [], []
                for doc, key, text in zip(part.column("doc_id").to_pylist(), part.column("key").to_pylist(), part.column("text")):
                    words = (text.as_py() or b"").split()
                    begin, end = _group_bounds(chunk_ends(words, cut), min(cut.together, cut.min_words))
                    joined = b" ".join(words)
                    # where each word begins
                    place = np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words)))
                    place = np.append(0, place)
                    bounds = zip(place[begin].tolist(), (place[end] - 1).tolist())
                    digests += [xxh3_64_intdigest(joined[a:b]) for a, b in bounds]
                    docs.append(np.full(len(begin), doc, np.int64))
                    keys.append(np.full(len(begin), key, np.int64))
                    at.append(np.stack([begin, end]).astype(np.int32))
                columns = [np.array(digests, np.uint64).view(np.int64), np.concatenate(docs)]
                names = ["digest", "doc"]
                if places:
                    columns += [np.concatenate(keys), *np.concatenate(at, axis=1)]
                    names += ["key", "word", "after"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return run


def repeated_passages(df: DataFrame, cut: Cut = Cut(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_key, first_word, n_words, source_id``: passages that a document with a lesser id has as well.

    Words are ``[^\\x20\\x09-\\x0D]+``, counted from 0; white space between them does not matter. ``source_id`` is the least
    id that has a group of the passage's chunks. Passages within one document do not count. Null and empty texts have none. Rows
    whose id is null are left alone and give nothing, since they come before and after no other. Rows of one id take nothing from
    one another; ``text_key``, a hash of the text, tells them apart, and equal ones have one result.

    Whole texts are cut twice. Digests are aggregated to their least and greatest document before they are shuffled; the
    join back is split where a digest is hot.
    """
    python_tasks(df.sparkSession)
    texts = pick(df, doc_id, text).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    texts = texts.where("doc_id is not null").withColumn("key", F.xxhash64("text"))
    seen = texts.mapInArrow(_groups(cut, False), "digest long, doc long")
    firsts = seen.groupBy("digest").agg(F.min("doc").alias("source"), F.max("doc").alias("last")).where("source < last")
    firsts = staged(firsts.select("digest", "source"), "chunks")
    placed = texts.mapInArrow(_groups(cut, True), "digest long, doc long, key long, word int, after int")
    again = placed.join(firsts, "digest").where("doc > source").select("doc", "key", "word", "after", "source")
    in_order = Window.partitionBy("doc", "key").orderBy("word", "after")
    so_far = F.max("after").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    # groups that only touch have no group over their border, so nothing says that they belong together
    begins = again.withColumn("new", F.when(F.col("word") < so_far, 0).otherwise(1))
    runs = begins.withColumn("run", F.sum("new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    found = runs.groupBy("doc", "key", "run").agg(
        F.min("word").alias("first_word"), (F.max("after") - F.min("word")).alias("n_words"), F.min("source").alias("source_id")
    )
    kept = found.where(F.col("n_words") >= cut.min_words)
    return kept.select(F.col("doc").alias("doc_id"), F.col("key").alias("text_key"), "first_word", "n_words", "source_id")


def _removed(text: bytes, spans: list[dict]) -> bytes:
    """The text without some runs of words and the white space after them."""
    import re

    starts = [m.start() for m in re.finditer(rb"[^\x20\x09-\x0D]+", text)] + [len(text)]
    kept, at = [], 0
    for first, n in sorted((s["first_word"], s["n_words"]) for s in spans):
        kept.append(text[at : starts[first]])
        at = starts[first + n]
    return b"".join([*kept, text[at:]])


def without_repeats(df: DataFrame, cut: Cut = Cut(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The frame with repeated passages cut out of its texts; all columns and rows stay, a text may become empty."""
    python_tasks(df.sparkSession)
    found = repeated_passages(df, cut, doc_id, text)
    per_text = found.groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    spans = staged(per_text.agg(F.collect_list(F.struct("first_word", "n_words")).alias("__spans")), "spans")

    @F.arrow_udf("binary")
    def removed(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, found in batches:
            yield pa.array([_removed(t, s) if s else t for t, s in zip(texts.to_pylist(), found.to_pylist())], pa.binary())

    marked = df.withColumns({"__id": F.col(doc_id).cast("long"), "__key": F.xxhash64(F.col(text).cast("binary"))})
    joined = join_bounded(marked, spans, ["__id", "__key"])
    touched = F.col("__spans").isNotNull()
    changed = joined.where(touched).withColumn("__new", removed(F.col(text).cast("binary"), F.col("__spans")).cast("string"))
    kept = joined.where(~touched).withColumn("__new", F.col(text))
    return put(kept.unionByName(changed), text, F.col("__new")).select(*df.columns)
