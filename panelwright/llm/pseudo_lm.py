"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every token is predicted from the tokens around it, two on either side, and a document's score is the sum of the conditional
log-probabilities. The network is small: position-wise embeddings of the neighbours are added and squashed, and the token is
predicted in two steps, its class and its place in the class. The vocabulary is counted over all documents. It names the most
frequent words; any other word is predicted as one id for all of them, and then spelled: a byte at a time, each by the byte
before it, from counts over all such words. So all words have a probability, and these add up to one.

Training is data-parallel: in each round every task starts from the same weights, learns from its share of all documents, and
the weights are averaged by the tokens behind them, in two levels of groups of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import pick, put, python_tasks, staged

#: Neighbours on each side, numbers per embedding, classes and ids in a class.
SIDE, WIDTH, CLASSES, PER_CLASS = 2, 16, 32, 32
#: Ids that are predicted: the named words and, last, one for all others. As neighbours these are told apart by hash.
IDS = CLASSES * PER_CLASS
NAMED = IDS - 1
SHARED = 256
_EDGE = IDS + SHARED  # stands before and after a document
#: Rounds of training; each takes another residue of every document's positions, so that together they take all of them once.
ROUNDS = 2
#: Positions of a step, at first and at most; positions scored at once; texts encoded at once.
_LEAST_BATCH, _BATCH, _SCORE_BATCH, _TEXTS = 256, 4096, 4096, 512
_PIECES, _SALTS = 16, 32
_END = 256  # of a word, in spelling
_PLACES = np.random.default_rng(97).integers(1, 1 << 32, 64, dtype=np.uint32) | np.uint32(1)


@dataclass
class Net:
    """All weights in one vector, seen as matrices."""

    flat: np.ndarray

    SHAPES = (("e", (2 * SIDE, IDS + SHARED + 1, WIDTH)), ("b", (WIDTH,)), ("a", (WIDTH, CLASSES)), ("c", (CLASSES,)), ("u", (CLASSES, WIDTH, PER_CLASS)), ("v", (CLASSES, PER_CLASS)))

    def __post_init__(self) -> None:
        at = 0
        for name, shape in self.SHAPES:
            size = int(np.prod(shape))
            setattr(self, name, self.flat[at : at + size].reshape(shape))
            at += size

    @classmethod
    def size(cls) -> int:
        return sum(int(np.prod(shape)) for _, shape in cls.SHAPES)

    @classmethod
    def start(cls, counts: np.ndarray | None = None, seed: int = 5) -> Net:
        """Small random weights; the biases give each id its share of the counts."""
        net = cls(np.zeros(cls.size(), np.float32))
        if counts is not None:
            shares = (counts + 1.0).reshape(CLASSES, PER_CLASS)
            net.c[:], net.v[:] = np.log(shares.sum(axis=1) / shares.sum()), np.log(shares)
        rng = np.random.default_rng(seed)
        for name in ("e", "a", "u"):
            value = getattr(net, name)
            value[:] = rng.normal(0, 0.1, value.shape)
        return net


def _softmax(x: np.ndarray) -> np.ndarray:
    """Overwrites ``x``."""
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=1, keepdims=True)
    return x


def _log_share(x: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The entry at ``place`` of each row's log-softmax; overwrites ``x``."""
    x -= x.max(axis=1, keepdims=True)
    found = x[np.arange(len(x)), place]
    np.exp(x, out=x)
    return found - np.log(x.sum(axis=1))


def _by_class(cls: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Rows in order of their class, and each class with where its rows begin and end in that order."""
    ends = np.cumsum(np.bincount(cls, minlength=CLASSES)).tolist()
    return np.argsort(cls.astype(np.uint8), kind="stable"), [(k, a, b) for k, (a, b) in enumerate(zip([0, *ends], ends)) if a < b]


def _place_scores(net: Net, h: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Scores of the places in each row's class, for rows in order of their class."""
    scores = np.empty((len(h), PER_CLASS), h.dtype)
    for k, a, b in spans:
        np.matmul(h[a:b], net.u[k], out=scores[a:b])
        scores[a:b] += net.v[k]
    return scores


def _hidden(net: Net, around: np.ndarray) -> np.ndarray:
    total = net.b + net.e[0].take(around[0], axis=0)
    for k in range(1, 2 * SIDE):
        total += net.e[k].take(around[k], axis=0)
    return np.tanh(total, out=total)


def log_probabilities(net: Net, around: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``log p(target | neighbours)``; ``around`` has one row per relative position."""
    h = _hidden(net, around)
    cls, place = np.divmod(target, PER_CLASS)
    result = _log_share(h @ net.a + net.c, cls)
    order, spans = _by_class(cls)
    result[order] += _log_share(_place_scores(net, h[order], spans), place[order])
    return result


def gradient(net: Net, around: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gradient of the mean negative log-probability, as one vector."""
    n = len(target)
    grad = Net(np.zeros_like(net.flat))
    h = _hidden(net, around)
    cls, place = np.divmod(target, PER_CLASS)
    up = _softmax(h @ net.a + net.c)
    up[np.arange(n), cls] -= 1
    up /= n
    grad.a[:], grad.c[:] = h.T @ up, up.sum(axis=0)
    back = up @ net.a.T
    order, spans = _by_class(cls)
    sorted_h, sorted_back = h[order], np.empty_like(h)
    own = _softmax(_place_scores(net, sorted_h, spans))
    own[np.arange(n), place[order]] -= 1
    own /= n
    for k, a, b in spans:
        np.matmul(sorted_h[a:b].T, own[a:b], out=grad.u[k])
        own[a:b].sum(axis=0, out=grad.v[k])
        np.matmul(own[a:b], net.u[k].T, out=sorted_back[a:b])
    back[order] += sorted_back
    back *= 1 - h * h
    grad.b[:] = back.sum(axis=0)
    for k in range(2 * SIDE):
        order = np.argsort(around[k].astype(np.uint16), kind="stable")  # short numbers are sorted by counting
        ids = around[k].take(order)
        first = np.append(0, np.flatnonzero(ids[1:] != ids[:-1]) + 1)
        grad.e[k][ids[first]] = np.add.reduceat(back.take(order, axis=0), first, axis=0)
    return grad.flat


class Learner:
    """Gradient steps with moments (Adam)."""

    def __init__(self, net: Net, rate: float):
        self.net, self.rate, self.steps = net, rate, 0
        self.slope, self.square, self.room = np.zeros_like(net.flat), np.zeros_like(net.flat), np.empty_like(net.flat)

    def step(self, around: np.ndarray, target: np.ndarray) -> None:
        g = gradient(self.net, around, target)
        self.steps += 1
        self.slope *= 0.9
        self.slope += np.multiply(g, 0.1, out=self.room)
        self.square *= 0.999
        np.multiply(g, g, out=g)
        self.square += np.multiply(g, 0.001, out=g)
        size = self.rate * float(np.sqrt(1 - 0.999**self.steps)) / (1 - 0.9**self.steps)  # a NumPy number would widen the vectors
        np.sqrt(self.square, out=g)
        g += 1e-8
        np.divide(self.slope, g, out=g)
        g *= size
        self.net.flat -= g


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of several whole texts one after the other, A-Z lowered, and the number of each text."""
    if not pa.types.is_string(texts.type):
        texts = pc.cast(texts, options=pc.CastOptions(pa.string(), allow_invalid_utf8=True))
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words, sizes = lists.flatten(), np.diff(lists.offsets.to_numpy())
    filled = pc.greater(pc.binary_length(words), 0)
    row = np.repeat(np.arange(len(sizes)), sizes)[filled.to_numpy(zero_copy_only=False)]
    return words.filter(filled), np.bincount(row, minlength=len(sizes))


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all words, and where each word begins and ends; no word is empty."""
    offsets = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4)
    data = np.frombuffer(words.buffers()[2], np.uint8, int(offsets[-1])) if len(words) and words.buffers()[2] else np.empty(0, np.uint8)
    return data, offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)


def spelled(words: pa.Array, table: np.ndarray) -> np.ndarray:
    """Sum of ``table[byte, next byte]`` of each word, from and to its ends."""
    if not len(words):
        return np.empty(0)
    data, begin, end = _letters(words)
    base = int(begin[0])
    data, begin, end = data[base:], begin - base, end - base
    before = np.empty(len(data), np.int64)
    before[1:] = data[:-1]
    before[begin] = _END
    return np.add.reduceat(table[before, data], begin) + table[data[end - 1], _END]


class Ids:
    """Ids of words as neighbours: named words have their own, others share some by a hash of their bytes."""

    def __init__(self, named: list[bytes]):
        self.named = pa.array([w.decode(errors="replace") for w in named], pa.string())

    def of(self, words: pa.Array) -> np.ndarray:
        if not len(words):
            return np.empty(0, np.uint16)
        found = pc.index_in(words, value_set=self.named).fill_null(-1).to_numpy(zero_copy_only=False)
        data, begin, end = _letters(words)
        base = int(begin[0])
        place = np.arange(int(end[-1]) - base) - np.repeat(begin - base, end - begin)
        h = np.add.reduceat((data[base:].astype(np.uint32) + np.uint32(1)) * _PLACES[place & 63], begin - base)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        return np.where(found >= 0, found, IDS + (h >> np.uint32(8)) % np.uint32(SHARED)).astype(np.uint16)


def encode(texts: pa.Array, ids: Ids) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.DictionaryArray]:
    """The ids of several whole texts with edges around each, the positions of their words, the words of each, and all of them."""
    words, counts = split(texts)
    words = words.dictionary_encode()
    total = int(counts.sum())
    stream = np.full(total + 2 * SIDE * len(counts), _EDGE, np.uint16)
    positions = np.arange(total) + np.repeat(SIDE + 2 * SIDE * np.arange(len(counts)), counts)
    stream[positions] = ids.of(words.dictionary)[words.indices.to_numpy()]
    return stream, positions, counts, words


def _targets(stream: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """What is predicted: named words by their ids, all others by one."""
    return np.minimum(stream[positions], IDS - 1).astype(np.int64)


def _of_round(positions: np.ndarray, counts: np.ndarray, round_: int, rounds: int) -> np.ndarray:
    """The positions whose place in their own document leaves ``round_`` by ``rounds``."""
    place = np.arange(len(positions)) - np.repeat(np.cumsum(counts) - counts, counts)
    return positions[place % rounds == round_]


def _around(stream: np.ndarray, positions: np.ndarray) -> np.ndarray:
    return np.stack([stream[positions + k] for k in (*range(-SIDE, 0), *range(1, SIDE + 1))])


@dataclass
class Vocabulary:
    """``named``: the words with an id of their own. ``counts``: how often each id occurs. ``spelling``: log-probability of a byte
    after a byte, over all other words, with the ends of words as a 257th; the first row is divided by what named words would take."""

    named: list[bytes]
    counts: np.ndarray
    spelling: np.ndarray


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and their counts in every few texts; adding up goes on map-side in Spark."""
    for batch in batches:
        for a in range(0, batch.num_rows, 8 * _TEXTS):
            met = split(batch.column("text").slice(a, 8 * _TEXTS))[0].value_counts()
            yield pa.RecordBatch.from_arrays([met.field("values"), met.field("counts").cast(pa.int64())], ["word", "n"])


def _count_letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of successive bytes, ends of words included, by the words' counts."""
    total = np.zeros((257, 257))
    for batch in batches:
        if not batch.num_rows:
            continue
        words, n = batch.column("word"), batch.column("n").to_numpy().astype(float)
        data, begin, end = _letters(words)
        base = int(begin[0])
        data, begin, end = data[base:].astype(np.int64), begin - base, end - base
        before = np.append(0, data[:-1])
        before[begin] = _END
        weight = np.repeat(n, end - begin)
        total += np.bincount(before * 257 + data[: len(before)], weight, 257 * 257).reshape(257, 257)
        total[:, _END] += np.bincount(data[end - 1], n, 257)
    pair = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int32()), pa.array(total.reshape(-1)[pair].astype(np.int64))], ["pair", "n"])


def spelling(pairs: np.ndarray, named: list[bytes]) -> np.ndarray:
    """Log-probabilities of the next byte; every byte may follow every other. The named words are left out of the distribution."""
    table = np.log((pairs + 0.05) / (pairs + 0.05).sum(axis=1, keepdims=True))
    if named:
        taken = np.exp(spelled(pa.array([w.decode(errors="replace") for w in named], pa.string()), table)).sum()
        table[_END] -= np.log1p(-min(taken, 0.999999))
    return table


def vocabulary(df: DataFrame, text: str = "text") -> Vocabulary:
    """Counted over all documents, A-Z lowered. The most frequent words, by count and then by word, are named, ``NAMED`` at most."""
    met = _texts(df, text).mapInArrow(_count_words, "word string, n long")
    counted = staged(met.groupBy("word").agg(F.sum("n").alias("n")), "words")
    total = counted.agg(F.sum("n")).first()[0] or 0
    rows = counted.orderBy(F.desc("n"), "word").limit(NAMED).collect()
    counts = np.zeros(IDS)
    counts[: len(rows)] = [r.n for r in rows]
    counts[NAMED] = total - counts[:NAMED].sum()
    frequent = df.sparkSession.createDataFrame([(r.word,) for r in rows], "word string")
    others = counted.join(F.broadcast(frequent), "word", "left_anti")
    pairs = np.zeros(257 * 257)
    for r in others.mapInArrow(_count_letters, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():  # 257 x 257 at most
        pairs[r.pair] = r.n
    named = [r.word.encode() for r in rows]
    return Vocabulary(named, counts, spelling(pairs.reshape(257, 257), named))


def _texts(df: DataFrame, text: str) -> DataFrame:
    return pick(df, text).select(F.col(text).cast("string").alias("text"))


def _learn(sent, round_: int, rate: float, rounds: int = ROUNDS):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        flat, named = sent.value
        net, ids, seen = Net(flat.copy()), Ids(named), 0
        learner = Learner(net, rate)
        kept: list[tuple[np.ndarray, np.ndarray]] = []

        def learn(least: int) -> int:
            around, target = np.concatenate([k[0] for k in kept], axis=1), np.concatenate([k[1] for k in kept])
            order = np.random.default_rng(len(target)).permutation(len(target))
            at = 0
            while len(order) - at >= least:
                size = max(_LEAST_BATCH, min(_BATCH, (seen + at) // 32))  # large steps once much is seen
                part = order[at : at + size]
                learner.step(around[:, part], target[part])
                at += len(part)
            stop = at
            kept[:] = [(around[:, order[stop:]], target[order[stop:]])]
            return stop

        for batch in batches:
            for a in range(0, batch.num_rows, _TEXTS):
                stream, positions, counts, _ = encode(batch.column("text").slice(a, _TEXTS), ids)
                chosen = _of_round(positions, counts, round_, rounds)
                if len(chosen):
                    kept.append((_around(stream, chosen), _targets(stream, chosen)))
                if sum(len(k[1]) for k in kept) >= 32 * _BATCH:
                    seen += learn(_BATCH)
        if kept and len(np.concatenate([k[1] for k in kept])):
            seen += learn(1)
        if seen:
            pieces = np.array_split(net.flat.astype(np.float64) * seen, _PIECES)
            task = TaskContext.get().partitionId()
            columns = [pa.array(range(_PIECES), pa.int32()), pa.array([task] * _PIECES, pa.int32()), pa.array([seen] * _PIECES, pa.int64()), pa.array([p.tolist() for p in pieces], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["piece", "task", "n", "w"])

    return run


_SUMS = "piece int, task int, n long, w array<double>"


def _summed(table: pa.Table) -> pa.Table:
    """One row for several of one piece, added in the order of their tasks."""
    table = table.sort_by("task")
    w = np.sum([np.asarray(x.values) for x in table.column("w")], axis=0)
    n = sum(table.column("n").to_pylist())
    return pa.table({"piece": table.column("piece").slice(0, 1), "task": table.column("task").slice(0, 1), "n": pa.array([n], pa.int64()), "w": pa.array([w.tolist()], pa.list_(pa.float64()))})


def train(df: DataFrame, text: str = "text", rounds: int = ROUNDS, rate: float = 0.01) -> tuple[np.ndarray, Vocabulary]:
    """Weights and vocabulary learnt from all positions of all documents; the start weights if there are no words."""
    spark = df.sparkSession
    python_tasks(spark)
    words = vocabulary(df, text)
    flat = Net.start(words.counts).flat
    texts = _texts(df, text)
    for round_ in range(rounds):
        sent = spark.sparkContext.broadcast((flat, words.named))
        learnt = texts.mapInArrow(_learn(sent, round_, rate / (1 + round_), rounds), _SUMS)
        partial = learnt.withColumn("salt", F.col("task") % _SALTS).groupBy("piece", "salt").applyInArrow(lambda t: _summed(t.drop_columns("salt")), _SUMS)
        sums = sorted(partial.groupBy("piece").applyInArrow(_summed, _SUMS).collect())  # the network once, whatever the input
        if sums:
            flat = np.concatenate([np.array(r["w"]) / r["n"] for r in sums]).astype(np.float32)
    return flat, words


def score(df: DataFrame, model: tuple[np.ndarray, Vocabulary], text: str = "text") -> DataFrame:
    """The frame with ``n_words``, ``log_prob`` (summed over all words) and ``mean_log_prob``.

    A null or empty text has no words, a sum of 0 and a null mean. A word without an id of its own counts with the probability
    that any such word stands there, times that of its spelling; so does a word that training has never met. Repeated
    rows get equal scores. Columns named like an output are replaced. One pass, no shuffle.

    The weights depend a little on how training was partitioned, since each task learns from its own share before the shares
    are averaged: on the test tables scores move by a few hundredths of themselves between one task and many.
    """
    python_tasks(df.sparkSession)
    flat, words = model
    sent = df.sparkSession.sparkContext.broadcast((flat, words.named, words.spelling))

    @F.arrow_udf("struct<n:long,p:double>")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        flat, named, table = sent.value
        net, ids = Net(flat), Ids(named)
        for batch in batches:
            sizes, sums = [], []
            for a in range(0, len(batch), _TEXTS):
                stream, positions, counts, words = encode(batch.slice(a, _TEXTS), ids)
                found = np.empty(len(positions))
                for b in range(0, len(positions), _SCORE_BATCH):
                    part = positions[b : b + _SCORE_BATCH]
                    found[b : b + _SCORE_BATCH] = log_probabilities(net, _around(stream, part), _targets(stream, part))
                letters = spelled(words.dictionary, table)[words.indices.to_numpy()]
                found += np.where(stream[positions] < IDS, 0, letters)
                sizes.append(counts)
                sums.append(np.bincount(np.repeat(np.arange(len(counts)), counts), found, len(counts)))
            arrays = [pa.array(np.concatenate(x) if x else [], k) for x, k in ((sizes, pa.int64()), (sums, pa.float64()))]
            yield pa.StructArray.from_arrays(arrays, ["n", "p"])

    made = put(df, "__scored", scored(F.col(text).cast("string")))
    total = F.col("__scored.p")
    made = put(made, "n_words", F.col("__scored.n"))
    made = put(made, "log_prob", F.round(total, 4))
    mean = F.when(F.col("n_words") > 0, F.round(total / F.col("n_words"), 6))
    return put(made, "mean_log_prob", mean).drop("__scored")
