"""Token counts, quality rules, pseudo-likelihood and toxicity against plain Python, and on odd rows."""

import itertools
import math
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from panelwright.llm import pseudo_lm, quality, tokens, toxicity

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, N_Tokens int, `kept` string, severity string, log_prob string"
ODD = [
    (1, None, 7, "x", None, None),
    (None, "", None, None, "y", None),
    (2, " \t\n\x0b\x0c\r ", 1, "x", None, "z"),
    (2, "the same row", 1, None, None, None),
    (2, "the same row", 1, None, None, None),
    (3, "long " * 30_000 + "x" * 5_000, 1, None, None, None),
    (4, "a <|endoftext|>  b<|endoftext|><|endoftext|> 's don't՘ ² \x1c \x85 日本語\n\n x", 0, "", "", ""),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_token_counts_equal_the_library(spark, docs, odd):
    library = Tokenizer.from_file(PATH)
    for frame in (docs.select("doc_id", "text"), odd.select("doc_id", "text")):
        for _, text, n, over in tokens.count_tokens(frame, PATH, limit=512).collect():
            assert n == len(library.encode(text or "", add_special_tokens=False).ids)
            assert over == (n > 512)


def test_token_pattern_for_plain_texts_equals_the_full_one():
    other = re.compile(f"[^{tokens.PLAIN}]").search
    library = Tokenizer.from_file(PATH).pre_tokenizer
    plain = [c for c in map(chr, range(0x250)) if not other(c)]
    text = "".join(f"a{c}b1{c}2!{c}! {c}\n {c}{c} _{c}" for c in plain)
    spans = [span for _, span in library.pre_tokenize_str(text)]
    assert spans == [m.span() for m in re.finditer(tokens.PLAIN_PRE_TOKEN, text)]


def test_whole_tokens_are_proven_and_other_vocabularies_refused():
    table = tokens.token_table(PATH)
    library = Tokenizer.from_file(PATH)
    assert len(table.whole) > 40_000
    assert all(len(library.encode(w, add_special_tokens=False).ids) == 1 for w in list(table.whole)[::97])
    with pytest.raises(ValueError):
        tokens.token_table(public_tokenizers.path("word_bpe_49k.json"))


def statistics(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_quality_statistics(docs, odd):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for frame in (docs, odd):
        for row in quality.judge(frame).select("text", *names, "kept").collect():
            assert tuple(row[n] for n in names) == statistics(row.text)
            assert not (row.kept and row.base_failed)


def test_quality_order_changes_no_verdict(docs):
    from pyspark.sql import functions as F

    from panelwright.llm.common import words_of

    ready = docs.withColumns({"__text": F.coalesce("text", F.lit("")), "__words": words_of(F.col("text"))})
    rules = quality.default_rules()
    names = [r.name for r in rules]
    made = [quality.cascade(rules, order, F.col("__text"), F.col("__words")).isNull() for order in (names, names[::-1])]
    assert ready.where(made[0] != made[1]).count() == 0
    assert sorted(quality.rule_order(ready.limit(50), rules)) == sorted(names)


def test_quality_keeps_the_same_rows_as_it_judges(docs):
    judged = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == judged


def test_quality_keeps_good_and_drops_bad(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality.judge(docs).join(labels, "doc_id").select("quality", "kept", "base_failed").collect()
    assert all(r.kept for r in rows if r.quality == 1 and not r.base_failed)
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(bad) <= 0.1 * len(bad)


def test_empty_tables(empty, spark):
    assert tokens.count_tokens(empty, PATH).collect() == []
    assert quality.judge(empty).collect() == []
    assert quality.keep_good(empty).collect() == []
    assert pseudo_lm.score(empty, pseudo_lm.train(empty)).collect() == []
    model = toxicity.train(empty, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(empty, model).collect() == []


def test_output_names_replace_clashing_columns(odd):
    counted = tokens.count_tokens(odd, PATH)
    assert [c.lower() for c in counted.columns].count("n_tokens") == 1
    assert dict(quality.judge(odd).dtypes)["kept"] == "boolean"


def test_lm_gradient():
    rng = np.random.default_rng(0)
    net = pseudo_lm.Net(pseudo_lm.Net.start().flat.astype(float))
    around, target = rng.integers(0, pseudo_lm.IDS + 1, (4, 50)), rng.integers(0, pseudo_lm.IDS, 50)
    gradient = pseudo_lm.gradient(net, around, target)
    for i in np.flatnonzero(gradient)[::200]:
        ends = []
        for step in (1e-5, -1e-5):
            flat = net.flat.copy()
            flat[i] += step
            ends.append(-pseudo_lm.log_probabilities(pseudo_lm.Net(flat), around, target).mean())
        assert abs((ends[0] - ends[1]) / 2e-5 - gradient[i]) < 1e-6


def test_lm_probabilities_sum_to_one():
    net, n = pseudo_lm.Net.start(), pseudo_lm.IDS
    around = np.repeat(np.array([[1], [2], [3], [4]]), n, axis=1)
    assert abs(np.exp(pseudo_lm.log_probabilities(net, around, np.arange(n))).sum() - 1) < 1e-4


def test_lm_prefers_the_order_it_has_seen(spark, odd):
    rng = np.random.default_rng(1)
    words = ["red", "green", "blue", "white", "black", "grey", "pink", "brown"]

    def text(start, n):
        return " ".join(words[(start + k) % len(words)] for k in range(n))

    seen = spark.createDataFrame([(text(int(rng.integers(8)), 200),) for _ in range(800)], "text string")
    model = pseudo_lm.train(seen, rate=0.05)
    mixed = " ".join(rng.permutation(text(3, 200).split()))
    good, bad = pseudo_lm.score(spark.createDataFrame([(text(3, 200),), (mixed,)], "text string"), model).collect()
    assert good.mean_log_prob > bad.mean_log_prob + 0.3
    rows = pseudo_lm.score(odd, model).collect()
    assert rows[0].n_words == 0 and rows[0].log_prob == 0 and rows[0].mean_log_prob is None
    assert rows[3].log_prob == rows[4].log_prob < 0 and rows[5].n_words == 30_001


def test_lm_learns_from_every_position_of_every_document(monkeypatch):
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: SimpleNamespace(partitionId=lambda: 0))
    texts = [" ".join(f"w{k}" for k in range(n)) for n in (*range(12), 1, 1, 1, 700)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array([t.encode() for t in texts])})
    sent = SimpleNamespace(value=(pseudo_lm.Net.start().flat, [b"w0", b"w1"]))
    learnt = [next(iter(pseudo_lm._learn(sent, k, 0.01)(iter([batch])))).column("n")[0].as_py() for k in range(pseudo_lm.ROUNDS)]
    assert sum(learnt) == sum(len(t.split()) for t in texts)


def test_lm_rounds_take_each_position_once():
    counts = np.array([1, 0, 1, 7, 2])
    positions = np.arange(11) + 100
    parts = [pseudo_lm._of_round(positions, counts, k, 3) for k in range(3)]
    assert sorted(np.concatenate(parts)) == positions.tolist()
    assert parts[0].tolist() == [100, 101, 102, 105, 108, 109]


def test_lm_spelled_words_are_one_distribution():
    """All words of up to six letters of a small alphabet, named ones aside, and what longer ones take."""
    pairs = np.zeros((257, 257))
    for word, n in ((b"ab", 5), (b"ba", 3), (b"aab", 2), (b"b", 4)):
        for x, y in zip([256, *word], [*word, 256]):
            pairs[x, y] += n
    table = np.log(np.maximum(pairs, 1e-300) / np.maximum(pairs.sum(axis=1, keepdims=True), 1e-300))
    words = ["".join(w) for n in range(1, 13) for w in itertools.product("ab", repeat=n)]
    found = np.exp(pseudo_lm.spelled(pa.array(words), table))
    assert abs(found.sum() - 1) < 0.02
    plain = [math.exp(sum(table[x, y] for x, y in zip([256, *w.encode()], [*w.encode(), 256]))) for w in words]
    assert np.allclose(found, plain)
    named = pseudo_lm.spelling(pairs, [b"ab", b"b"])
    rest = np.exp(pseudo_lm.spelled(pa.array([w for w in words if w not in ("ab", "b")]), named)).sum()
    free = np.exp(pseudo_lm.spelled(pa.array(words), pseudo_lm.spelling(pairs, []))).sum()
    taken = np.exp(pseudo_lm.spelled(pa.array(["ab", "b"]), pseudo_lm.spelling(pairs, []))).sum()
    assert abs(rest - (free - taken) / (1 - taken)) < 1e-9


def plain_log_prob(text, flat, words):
    """A document's score word by word."""
    net, named = pseudo_lm.Net(flat.astype(float)), {w.decode(): i for i, w in enumerate(words.named)}
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    ids = pseudo_lm.Ids(words.named)
    near = [pseudo_lm._EDGE] * 2 + [int(ids.of(pa.array([w]))[0]) for w in found] + [pseudo_lm._EDGE] * 2
    total = 0.0
    for k, word in enumerate(found):
        h = np.tanh(net.b + sum(net.e[j][near[k + p]] for j, p in enumerate((0, 1, 3, 4))))
        target = named.get(word, pseudo_lm.IDS - 1)
        cls, place = divmod(target, pseudo_lm.PER_CLASS)
        for scores, at in ((h @ net.a + net.c, cls), (h @ net.u[cls] + net.v[cls], place)):
            total += scores[at] - math.log(np.exp(scores).sum())
        if word not in named:
            data = word.encode()
            total += sum(words.spelling[x, y] for x, y in zip([256, *data], [*data, 256]))
    return len(found), total


def test_lm_scores_against_plain_python(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    flat, words = pseudo_lm.train(docs)
    extra = spark.createDataFrame([("Never seen wörds \u000b at all 日本",), ("the THE the",), (" ",)], "text string")
    rows = pseudo_lm.score(docs.limit(10).unionByName(extra), (flat, words)).collect()
    assert len(rows) == 13
    for r in rows:
        n, total = plain_log_prob(r.text or "", flat, words)
        assert r.n_words == n and abs(r.log_prob - total) < 1e-3 * max(1, n)


def test_lm_words_are_counted_as_plain_python_does(spark, odd):
    words = pseudo_lm.vocabulary(odd)
    plain = Counter(w for r in odd.collect() for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")))
    order = sorted(plain, key=lambda w: (-plain[w], w.encode()))[: pseudo_lm.NAMED]
    assert [w.decode() for w in words.named] == order
    assert words.counts[: len(order)].tolist() == [plain[w] for w in order] and words.counts.sum() == sum(plain.values())


def test_lm_ids_depend_on_the_word_alone():
    words = ["a", "Straße", "日本", "x" * 70, "\u0001", "b"]
    ids = pseudo_lm.Ids([b"b"])
    together = ids.of(pa.array(words))
    assert together.tolist() == [int(ids.of(pa.array([w]))[0]) for w in words] == ids.of(pa.array(["zz", *words])[1:]).tolist()
    assert together[-1] == 0 and all(pseudo_lm.IDS <= i < pseudo_lm.IDS + pseudo_lm.SHARED for i in together[:-1])


def test_lm_scores_move_little_with_the_partitioning(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").cache()
    found = []
    for n in (1, 4):
        model = pseudo_lm.train(docs.repartition(n, "doc_id"))
        found.append({r.doc_id: r.log_prob for r in pseudo_lm.score(docs, model).collect()})
    moved = [abs(found[0][i] - p) / max(1, abs(p)) for i, p in found[1].items()]
    assert np.mean(moved) < 0.05


def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.train(docs, labels.where("doc_id % 3 <> 0"))
    assert (np.diff(model.thresholds) > 0).all()
    rows = toxicity.score(docs, model).drop("toxic").join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    bad, good = ([r.severity for r in rows if r.toxic == k] for k in (1, 0))
    better = np.mean([x > y for x in bad for y in good])
    assert better > 0.85
    assert np.mean([x >= 0.5 for x in good]) < 0.1


def test_toxicity_on_odd_rows(odd, spark):
    labels = spark.createDataFrame([(2, 1), (2, 1), (3, 0), (None, 1), (4, None), (99, 1)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    rows = toxicity.score(odd, model).collect()
    assert rows[0].severity == rows[1].severity == rows[2].severity
    assert rows[3].severity == rows[4].severity
    assert all(0 <= r.severity <= 3 for r in rows)
