"""Exact Jaccard self-join of word n-gram sets by a pigeonhole over segments of the token universe.

The universe of shingle hashes is cut into segments, as many as the size band of a set asks for. Two sets that are similar
enough differ in few shingles, so most of their segments agree: with ``m`` segments and at most ``h`` differing shingles at
least ``m - h`` are equal. Each set is indexed under its segments; each segment content is one signature.

* **Size bands.** A set is indexed in its own band and the band below, which together hold all partners it can have.
* **Segment subsets, allocated by cost.** Signatures are counted over all sets. A set whose unshared segments already
  exceed its ``h`` has no partner at all and goes. Of the others only the ``h + 1`` cheapest (rarest) segments stay: two
  similar sets share one of those. So empty segments and much copied passages drop out by themselves.
* **One-deletion neighbourhoods.** Small sets have segments of little selectivity. They get half as many, each also indexed
  with any one shingle left out, and two segments count as agreeing if they differ in one shingle at most.
* **Verification.** Candidates are compared as whole sets.

Sets that are equal are one node from the start. Candidates of a signature are first compared with its hub, the set with the
most shared signatures; groups of near copies collapse there, and only sets of different groups are compared further.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.llm.common import join_bounded, pick, python_tasks, staged, words_of
from panelwright.llm.components import components

#: Segments beyond the least number, as a share: more of them tell apart better, and make more rows.
SPARE = 0.15
#: Largest set that is indexed with one-deletion neighbourhoods; such a set gives about as many rows as it has shingles.
DELETION_SIZE = 24
#: Sets of a block in the comparison of groups.
BLOCK = 500
#: Distinct words a worker remembers the hash of.
_REMEMBERED = 300_000
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


@dataclass(frozen=True)
class Likeness:
    """Words of a shingle, and the least ``intersection / union`` as a fraction."""

    words: int = 4
    over: int = 85
    under: int = 100

    def differing(self, sizes: int) -> int:
        """Most shingles in which two similar sets of this total size differ."""
        return sizes * (self.under - self.over) // (self.under + self.over)

    def largest_partner(self, size: int) -> int:
        return size * self.under // self.over


@dataclass(frozen=True)
class Place:
    """How a set is indexed in one band: ``segments``, the most differing shingles, deletions or not."""

    band: int
    segments: int
    differing: int
    deletions: bool

    @property
    def needed(self) -> int:
        """Least number of agreeing segments."""
        return self.segments - (self.differing // 2 if self.deletions else self.differing)


@lru_cache(maxsize=8)
def _starts(like: Likeness, upto: int) -> list[int]:
    """First size of each band; a partner of a set is in its band or a neighbouring one."""
    starts = [1]
    while starts[-1] <= upto:
        starts.append(like.largest_partner(starts[-1]) + 1)
    return starts


def places(like: Likeness, size: int) -> list[Place]:
    """A set's own band, and the one below if it can have partners there."""
    starts = _starts(like, 1 << max(10, size.bit_length()))
    own = int(np.searchsorted(starts, size, side="right")) - 1
    found = []
    for band in (own, own - 1):
        if band < 0:
            continue
        last = starts[band + 1] - 1
        if band < own and size * like.over > last * like.under:
            continue
        most = like.differing(last + like.largest_partner(last))
        mine = like.differing(size + (like.largest_partner(size) if band == own else last))
        if last <= DELETION_SIZE:
            found.append(Place(band, most // 2 + 1, mine, True))
        else:
            found.append(Place(band, most + 1 + int((most + 1) * SPARE), mine, False))
    return found


# --- sets, in tasks ---------------------------------------------------------------------------------


class _Words(dict):
    """Word to 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= _REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, width: int, words: dict) -> np.ndarray:
    """Sorted distinct shingle hashes of a text in UTF-8.

    A-Z are lowered and words cut at ASCII white space. With fewer words than ``width`` the whole sequence is the one
    shingle; without a word there is none.
    """
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    span = min(width, len(found))
    n = len(found) - span + 1
    mixed = np.full(n, span, np.uint64)
    for i in range(span):
        mixed = _mixed(mixed * _ODD[i % 4] + ids[i : i + n])
    return np.unique(mixed)


def _digests(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    if not len(tokens):
        return 0, 0
    a = _mixed(tokens ^ _ODD[1]).sum(dtype=np.uint64)
    b = _mixed(tokens ^ _ODD[2]).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def signatures(tokens: np.ndarray, place: Place) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a set in one place, and the segment of each.

    The content of a segment is named by the sum of its scrambled shingles, so leaving one out is a subtraction.
    """
    m = np.uint64(place.segments)
    segment = ((tokens >> np.uint64(32)) * m >> np.uint64(32)).astype(np.int64)
    values = _mixed(tokens ^ _ODD[3])
    sums = np.zeros(place.segments, np.uint64)
    np.add.at(sums, segment, values)
    at = np.arange(place.segments)
    if place.deletions:
        sums, at = np.concatenate([sums, sums[segment] - values]), np.concatenate([at, segment])
    salt = _mixed(at.astype(np.uint64) * _ODD[0] + np.uint64(place.band))
    return _mixed(sums + salt).view(np.int64), at


def _profiles(like: Likeness):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                tokens = shingle_set(text.as_py() or b"", like.words, words)
                rows.append((len(tokens), *_digests(tokens)))
            n, d1, d2 = zip(*rows) if rows else ((), (), ())
            columns = [pa.array(x, pa.int64()) for x in (n, d1, d2)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n", "d1", "d2"])

    return run


def _signed(like: Likeness):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = _Words(), set()
        for batch in batches:
            for chunk in range(0, batch.num_rows, 256):
                sigs, nodes, tags = [], [], []
                for text in batch.column("text").slice(chunk, 256):
                    tokens = shingle_set(text.as_py() or b"", like.words, words)
                    node = _digests(tokens)[0]
                    if not len(tokens) or node in seen:
                        continue
                    if len(seen) >= _REMEMBERED:
                        seen.clear()  # copies met later make rows once more
                    seen.add(node)
                    for space, place in enumerate(places(like, len(tokens))):
                        sig, at = signatures(tokens, place)
                        sigs.append(sig)
                        nodes.append(np.full(len(sig), node, np.int64))
                        tags.append((at * 2 if place.deletions else np.zeros(len(sig), np.int64)) + space)
                if sigs:
                    arrays = [pa.array(np.concatenate(x)) for x in (sigs, nodes)]
                    arrays.append(pa.array(np.concatenate(tags).astype(np.int32)))
                    yield pa.RecordBatch.from_arrays(arrays, ["sig", "node", "tag"])

    return run


def _tokens(like: Likeness):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            sets = [shingle_set(t.as_py() or b"", like.words, words) for t in batch.column("text")]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = pa.array(np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64))
            nodes = pa.array([_digests(x)[0] for x in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([nodes, pa.ListArray.from_arrays(pa.array(ends), flat)], ["node", "tokens"])

    return run


# --- the join -------------------------------------------------------------------------------------


def set_components(
    df: DataFrame, like: Likeness = Likeness(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row.

    ``component_id`` is the least id reachable by links, itself included. A text that is null or has no word has an empty
    set and is linked with nothing: its component is its own id. Rows of one id are one document. A row with a null id
    takes the component of the rows with an equal set, or null if these all have null ids; it makes no links.

    Ids must be integers. Three passes over the texts; only signatures (two longs and a tag each) are shuffled for all of
    them. Sets are named by 64 bits of their digest while links are searched, and by 128 where copies are told.
    """
    python_tasks(df.sparkSession)
    texts = pick(df, doc_id, text).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    profile = staged(texts.mapInArrow(_profiles(like), "doc_id long, n long, d1 long, d2 long"), "sets")
    filled = profile.where("n > 0")
    own = staged(filled.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep")), "copies")
    by_id = filled.where("doc_id is not null").groupBy("doc_id").agg(F.min("d1").alias("a"), F.max("d1").alias("z"))
    split = by_id.where("a < z").select("doc_id", "a").join(filled.select("doc_id", F.col("d1").alias("b")), "doc_id")
    links = linked_pairs(texts, own.where("rep is not null"), like)
    labels = components(links.unionByName(split.select("a", "b")))
    named = own.join(labels, F.col("d1") == F.col("node"), "left").withColumn("label", F.coalesce("label", "d1"))
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    by_set = staged(named.join(least, "label").select("d1", "d2", "n", "component_id"), "named")
    joined = profile.join(by_set, ["d1", "d2", "n"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def linked_pairs(texts: DataFrame, own: DataFrame, like: Likeness) -> DataFrame:
    """``a, b``: verified links between sets, enough of them to connect all sets that links connect.

    ``own`` has one row ``d1, n, rep`` per set, ``rep`` the id of a row that has it.
    """
    rows = texts.mapInArrow(_signed(like), "sig long, node long, tag int")
    by_sig = Window.partitionBy("sig")
    counted = rows.withColumns({"n": F.count("*").over(by_sig), "lo": F.min("node").over(by_sig), "hi": F.max("node").over(by_sig)})
    shared = staged(counted.where("lo < hi").drop("lo", "hi"), "shared").dropDuplicates(["sig", "node", "tag"])
    sizes = own.select(F.col("d1").alias("node"), F.col("n").alias("size"), "rep").dropDuplicates(["node"])
    index = staged(_allocated(shared, sizes.drop("rep"), like), "index")
    wanted = staged(index.select("node").distinct().join(sizes, "node"), "wanted")
    rows = join_bounded(texts, wanted.select(F.col("rep").alias("doc_id")).distinct(), ["doc_id"], "left_semi")
    tokens = rows.mapInArrow(_tokens(like), "node long, tokens array<long>").dropDuplicates(["node"])
    sets = staged(tokens.join(wanted.select("node"), "node"), "tokens")

    near_hub = staged(_hub_pairs(index), "hubs")
    links = staged(_verified(near_hub, sets, like), "links")
    groups = components(links).withColumnRenamed("label", "group")
    families = components(near_hub).withColumnRenamed("label", "family")
    placed = wanted.select("node").join(families, "node").join(groups, "node", "left")
    placed = staged(placed.withColumn("group", F.coalesce("group", "node")), "grouped")
    return links.unionByName(staged(_across(placed, sets, like), "links"))


def _allocated(shared: DataFrame, sizes: DataFrame, like: Likeness) -> DataFrame:
    """``sig, node, weight``: the cheapest segments each set needs; sets that can have no partner are gone.

    ``shared`` has only signatures that two sets or more have. With ``c`` of ``m`` segments shared, ``m - c`` are useless
    and already the cheapest, so ``differing + 1 - (m - c)`` of the shared ones are wanted, rarest first.
    """
    plan = T.ArrayType(
        T.StructType([T.StructField(n, T.IntegerType()) for n in ("segments", "differing", "needed", "deletions")])
    )

    @F.udf(plan)
    def placed(size):  # noqa: ANN001, ANN202
        return [(p.segments, p.differing, p.needed, int(p.deletions)) for p in places(like, size)]

    plans = sizes.select("size").distinct().withColumn("p", placed("size"))  # one call per distinct size
    known = shared.join(sizes.join(plans, "size"), "node").withColumn("space", F.col("tag") % 2)
    known = known.withColumn("p", F.get("p", F.col("space")))
    own = Window.partitionBy("node", "space")
    segments = F.when(F.col("p.deletions") == 1, F.size(F.collect_set("tag").over(own))).otherwise(F.count("*").over(own))
    ranked = known.withColumn("c", segments).withColumn("rank", F.row_number().over(own.orderBy("n", "sig")))
    budget = F.col("p.differing") + 1 - (F.col("p.segments") - F.col("c"))
    fits = F.when(F.col("p.deletions") == 1, F.col("c") >= F.col("p.needed")).otherwise(F.col("rank") <= budget)
    kept = ranked.where(fits).select("sig", "node").distinct()
    again = kept.withColumn("n", F.count("*").over(Window.partitionBy("sig"))).where("n > 1")
    return again.withColumn("weight", F.sum("n").over(Window.partitionBy("node"))).select("sig", "node", "weight")


def _hub_pairs(index: DataFrame) -> DataFrame:
    """``a, b``: each set with the hub of each of its signatures."""
    hubs = index.groupBy("sig").agg(F.max(F.struct("weight", "node")).alias("hub"))
    met = index.join(hubs, "sig").select("node", F.col("hub.node").alias("other")).where("node <> other")
    return met.select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    either = F.size("ta") + F.size("tb") - F.col("both")
    met = pairs.join(left, "a").join(right, "b").withColumn("both", both)
    return met.where(F.col("both") * like.under >= either * like.over).select("a", "b")


def _across(placed: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """``a, b``: links between groups of one family, at least one for each two groups that have any.

    Sets that share a signature are in one family. Its largest group is set aside; members of the others are compared with
    all members that are not of their own group. Both sides are dealt into blocks of about ``BLOCK`` sets, and each task
    compares two blocks: no pair becomes a row, and no family is gathered.
    """
    shares = placed.groupBy("family", "group").agg(F.count("*").alias("k"))
    tops = shares.groupBy("family").agg(
        F.max(F.struct("k", "group")).alias("top"), F.sum("k").alias("total"), F.count("*").alias("groups")
    )
    mixed = tops.where("groups > 1").select(
        "family",
        F.col("top.group").alias("top"),
        F.ceil(F.col("total") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("total") - F.col("top.k")) / BLOCK).cast("int").alias("seeking"),
    )
    members = placed.join(mixed, "family").join(sets, "node")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    mine = F.pmod(F.xxhash64("node", F.lit(1)), F.col("seeking")).cast("int")

    def side(rows: DataFrame, seeks: bool) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.col("blocks" if seeks else "seeking") - 1))
        seeker, other = (mine.alias("s"), every.alias("o")) if seeks else (every.alias("s"), block.alias("o"))
        return rows.select("family", seeker, other, F.lit(seeks).alias("seeks"), "node", "group", "tokens")

    dealt = side(members, False).unionByName(side(members.where("group <> top"), True))
    return dealt.groupBy("family", "s", "o").applyInArrow(_compared(like), "a long, b long").distinct()


def _compared(like: Likeness):
    def run(table: pa.Table) -> pa.Table:
        seeks = table.column("seeks").to_numpy()
        nodes, groups = (table.column(c).to_numpy() for c in ("node", "group"))
        tokens = [np.asarray(x.values) for x in table.column("tokens")]
        sizes = np.array([len(t) for t in tokens])
        others = np.flatnonzero(~seeks)
        flat = np.concatenate([tokens[k] for k in others]) if len(others) else np.empty(0, np.int64)
        owner = np.repeat(np.arange(len(others)), sizes[others])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        found: dict[tuple[int, int], None] = {}
        for k in np.flatnonzero(seeks):
            first, last = (np.searchsorted(flat, tokens[k], side) for side in ("left", "right"))
            n = last - first
            at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=len(others))
            alike = both * like.under >= (sizes[k] + sizes[others] - both) * like.over
            met = {}
            for j in others[alike & (groups[others] != groups[k])].tolist():
                met.setdefault(groups[j], j)  # one link to each group is enough
            for j in met.values():
                found[(max(nodes[k], nodes[j]), min(nodes[k], nodes[j]))] = None
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def one_of_each(df: DataFrame, like: Likeness = Likeness(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The frame with one row of each component, the one with its least id; all columns stay.

    Rows with an empty set are kept. Of rows that repeat the kept id, or of rows without any id and of one text (case aside),
    one is kept.
    """
    found = staged(set_components(df, like, doc_id, text), "components")
    stay = found.where("n_shingles = 0 or doc_id = component_id or component_id is null")
    gone = found.where("n_shingles > 0 and doc_id <> component_id").select("doc_id").distinct()
    gone = gone.join(stay.select("doc_id").distinct(), "doc_id", "left_anti")
    key = F.col(doc_id).cast("long")
    marked = df.withColumn("__id", key)
    kept = join_bounded(marked, gone.withColumnRenamed("doc_id", "__id"), ["__id"], "left_anti")
    repeated = found.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    if repeated.limit(1).count() == 0:
        return kept.drop("__id")
    return _without_repeats(kept, repeated, text, like)


def _without_repeats(kept: DataFrame, repeated: DataFrame, text: str, like: Likeness) -> DataFrame:
    """Of rows of one id, or without id and of one text, a single one; rows without words all stay."""
    ids = repeated.select(F.coalesce("doc_id", F.lit(-1)).alias("__k"), F.col("doc_id").isNull().alias("__n"))
    keyed = kept.withColumn("__k", F.coalesce("__id", F.lit(-1))).withColumn("__n", F.col("__id").isNull())
    alone = join_bounded(keyed, ids, ["__k", "__n"], "left_anti")
    several = join_bounded(keyed, ids, ["__k", "__n"], "left_semi")
    wordless = F.size(words_of(F.col(text))) == 0
    named = F.when(F.col("__n"), F.xxhash64(F.lower(text))).otherwise(F.lit(0))
    merged = several.where(~wordless).withColumn("__t", named).dropDuplicates(["__k", "__n", "__t"]).drop("__t")
    return alone.unionByName(several.where(wordless)).unionByName(merged).drop("__id", "__k", "__n")
