"""Joins between documents, mixing, decontamination, passages, archives and pages, against plain Python and on odd rows."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelwright.llm import decontaminate, html, jaccard, mixing, substrings, warc
from panelwright.llm.components import components
from panelwright.session import shared_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, size string, TAKEN int, component_id string"
LONG = " ".join(f"w{i % 5000}" for i in range(20_000))
ODD = [
    (1, None, None, None, 1, None),
    (2, "", "a", "x", None, None),
    (None, "some words that have no id at all", "a", None, None, "x"),
    (None, "some words that have no id at all", None, None, None, None),
    (3, "a row that is there twice and has ten words", "b", None, None, None),
    (3, "a row that is there twice and has ten words", "b", None, None, None),
    (4, LONG, "b", None, None, None),
    (5, LONG + " more", "c", None, None, None),
    (6, " \t\r\n", "c", None, None, None),
    (7, "two words", "c", None, None, None),
    (8, "TWO\twords", "", None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- near copies ------------------------------------------------------------------------------------


def shingles(text, k):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute_components(texts, like):
    up = {i: i for i in texts}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    sets = {i: shingles(t, like.words) for i, t in texts.items()}
    for a, b in itertools.combinations(sorted(texts), 2):
        both = len(sets[a] & sets[b])
        if both and like.under * both >= like.over * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return {i: (len(sets[i]), find(i)) for i in texts}


def near_copies(seed, n=140):
    """Texts of all sizes: originals, exact copies, copies of copies with some words changed, and a shared passage."""
    rng = np.random.default_rng(seed)
    vocabulary = np.array([f"v{i}" for i in range(400)])
    passage = " ".join(rng.choice(vocabulary, 40))
    texts = []
    for _ in range(n):
        roll = rng.random()
        if texts and roll < 0.6:
            words = texts[rng.integers(len(texts))].split()
            for _ in range(int(rng.integers(0, 1 + max(1, len(words) // 25)))):
                if words:
                    words[rng.integers(len(words))] = str(rng.choice(vocabulary))
            texts.append(" ".join(words))
        else:
            own = " ".join(rng.choice(vocabulary, int(np.exp(rng.uniform(0, 6)))))
            texts.append(own + " " + passage if roll > 0.9 else own)
    return dict(enumerate(texts))


@pytest.mark.parametrize("like", [jaccard.Likeness(4, 85, 100), jaccard.Likeness(5, 4, 5)], ids=str)
def test_components_equal_brute_force(spark, like):
    texts = near_copies(3)
    rows = jaccard.set_components(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), like).collect()
    want = brute_components(texts, like)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert len({c for _, c in want.values()}) < len(texts)


def test_components_of_odd_rows(odd, empty):
    rows = jaccard.set_components(odd).collect()
    by_id = defaultdict(set)
    for r in rows:
        by_id[r.doc_id].add((r.n_shingles, r.component_id))
    assert by_id[1] == {(0, 1)} and by_id[2] == {(0, 2)} and by_id[6] == {(0, 6)}
    assert by_id[7] == by_id[8] == {(1, 7)}
    assert by_id[3] == {(7, 3)} and by_id[None] == {(5, None)}
    assert by_id[4] == {(5000, 4)} and by_id[5] == {(5001, 4)}
    assert len(rows) == len(ODD)
    assert jaccard.set_components(empty).collect() == []


def test_one_of_each(odd, empty):
    rows = jaccard.one_of_each(odd)
    assert rows.columns == odd.columns
    assert Counter(r.doc_id for r in rows.collect()) == {1: 1, 2: 1, None: 1, 3: 1, 4: 1, 6: 1, 7: 1}
    assert jaccard.one_of_each(empty).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 400), st.integers(0, 40))
def test_similar_sets_share_what_the_index_needs(seed, size, changes):
    """The pigeonhole: two similar sets agree in the segments that the index counts on."""
    rng = np.random.default_rng(seed)
    like = jaccard.Likeness(4, 85, 100)
    a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
    keep = rng.permutation(a)[min(changes, len(a) - 1) :]
    b = np.unique(np.concatenate([keep, rng.integers(0, 1 << 63, rng.integers(0, 3)).astype(np.uint64)]))
    both = len(np.intersect1d(a, b))
    if like.under * both < like.over * (len(a) + len(b) - both):
        return
    found = 0
    for p in jaccard.places(like, len(a)):
        for q in jaccard.places(like, len(b)):
            if p.band == q.band:
                assert p.segments == q.segments
                x, y = (jaccard.signatures(s, w) for s, w in ((a, p), (b, q)))
                common = len({i for s, i in zip(*x) if s in set(y[0].tolist())})
                found += common >= max(1, p.segments - p.differing if not p.deletions else p.needed)
    assert found


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 200), (300, 301), (301, 300)]
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(51)}, **{100 + i: 100 for i in range(40)}, 300: 300, 301: 300}


# --- mixing -----------------------------------------------------------------------------------------


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        target = {s: cap * sizes[s] if s in full else left * weight[s] / open_ for s in names}
        over = {s for s in names if s not in full and target[s] > cap * sizes[s]}
        if not over:
            return target
        full |= over


def check_mix(rows):
    sizes = Counter()
    taken = Counter()
    for r in rows:
        assert r.size == len(WORD.findall(r.text or "")) and r.taken <= 2 * r.size and r.taken == r.repeats * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    want = brute_targets(sizes)
    largest = Counter()
    for r in rows:
        largest[r.source] = max(largest[r.source], r.size)
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6 for s in want)


def test_mix(spark, odd, empty):
    rng = np.random.default_rng(4)
    made = [(int(i), " ".join(["w"] * int(rng.integers(0, 60))), [None, "a", "b", "c", "d"][min(4, int(rng.exponential(1)))]) for i in range(600)]
    frame = spark.createDataFrame(made, "doc_id long, text string, source string")
    rows = mixing.mix(frame).collect()
    check_mix(rows)
    assert Counter(rows) == Counter(mixing.mix(frame.repartition(7)).collect())
    assert Counter(mixing.mix(frame, seed=5).collect()) != Counter(rows)
    assert len(mixing.mix(odd).collect()) == len(ODD) and mixing.mix(empty).collect() == []


def test_mix_of_equal_rows(spark):
    frame = spark.createDataFrame([(1, "five words are in here", "a")] * 40 + [(2, "x " * 400, "b")], "doc_id long, text string, source string")
    check_mix(mixing.mix(frame).collect())


# --- benchmark leaks --------------------------------------------------------------------------------

ITEM = "If Alice Smith has 12 apples and buys 3.5 kg more, then how many apples does Alice own after 12 days?"


def test_leaks_with_other_slots(spark):
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "tiny one"), (5, "1 2 3 4 5 6 7 8 9 10 11 12")], "item_id long, text string")
    texts = {
        1: f"before it {ITEM} after it",
        2: "so if Bob Jones has 15 apples and buys 7 lb more, then how many apples does Bob own after 15 days? yes",
        3: "so if Bob Jones has 15 apples and buys 7 lb more, then how many apples does Carl own after 18 days? yes",
        4: "numbers 8 2 6 4 5 1 7 8 9 10 11 12 13",
        5: None,
        6: "",
        7: "if someone has apples and buys more then nothing of this is in the benchmark at all",
    }
    docs = spark.createDataFrame([*texts.items(), (None, texts[1]), (1, texts[1])], "doc_id long, text string")
    found = decontaminate.leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id, r.changed) for r in found} == {(1, 1, False), (2, 1, True), (None, 1, False)}
    kept = decontaminate.without_leaks(docs, items)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7]


def test_leaks_equal_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    windows = defaultdict(set)
    for r in items.collect():
        w = r.text.lower().split()
        for i in range(len(w) - 7):
            windows[tuple(w[i : i + 8])].add(r.item_id)
    want = set()
    for r in docs.collect():
        w = (r.text or "").lower().split()
        want |= {(r.doc_id, k) for i in range(len(w) - 7) for k in windows.get(tuple(w[i : i + 8]), ())}
    assert want and {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()} == want


def test_leaks_of_odd_and_empty_tables(odd, empty, spark):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(odd, items).collect() == []
    assert decontaminate.leaks(empty, items).collect() == []
    assert decontaminate.without_leaks(odd, none).count() == len(ODD)


# --- repeated passages ------------------------------------------------------------------------------


def passages(seed, plain=60, sharing=12):
    rng = np.random.default_rng(seed)

    def words(n):
        return [f"{rng.integers(10**9):x}" for _ in range(n)]

    passage = words(55)
    docs = {i: words(int(rng.integers(20, 200))) for i in range(plain)}
    for i in range(plain, plain + sharing):
        own = words(int(rng.integers(20, 200)))
        at = int(rng.integers(0, len(own)))
        docs[i] = own[:at] + passage + own[at:]
    return {i: " ".join(w) for i, w in docs.items()}, " ".join(passage)


def test_shared_passages_are_found_and_clean_texts_left(spark):
    texts, passage = passages(1)
    frame = spark.createDataFrame([(i, t, len(t)) for i, t in texts.items()], "doc_id long, text string, n int")
    found = substrings.repeated_passages(frame).collect()
    assert {r.doc_id for r in found} == set(range(61, 72)) and {r.source_id for r in found} == {60}
    assert all(20 <= r.n_words <= 55 for r in found)
    cut = {r.doc_id: r.text for r in substrings.without_repeats(frame).collect()}
    assert all(cut[i] == texts[i] for i in range(61))
    for r in found:
        words = texts[r.doc_id].split()
        gone = words[r.first_word : r.first_word + r.n_words]
        assert " ".join(gone) in passage
        assert cut[r.doc_id].split() == words[: r.first_word] + words[r.first_word + r.n_words :]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("abcdefgh", min_size=1, max_size=9), min_size=60, max_size=150), st.integers(0, 40), st.text("xyz", min_size=1, max_size=5))
def test_insertions_move_only_near_chunks(words, at, new):
    cut = substrings.Cut()

    def chunks(w):
        ends = substrings.chunk_ends([x.encode() for x in w], cut)
        return [tuple(w[a:b]) for a, b in zip([0, *ends[:-1]], ends)]

    before, after = chunks(words), chunks(words[:at] + [new] + words[at:])
    assert [w for c in after for w in c] == words[:at] + [new] + words[at:]
    ends = np.cumsum([len(c) for c in before])
    far = [c for c, e in zip(before, ends) if e - len(c) >= at + 17]  # chunks after the first end behind the look-back
    if any(e >= at + 17 and e - len(c) < at + 17 for c, e in zip(before, ends)):
        assert max(map(len, after)) >= cut.longest or Counter(far) <= Counter(after)


def test_chunks_from_unrelated_places_make_no_passage(spark):
    rng = np.random.default_rng(7)
    cut = substrings.Cut()
    words = [f"{rng.integers(10**9):x}" for _ in range(400)]
    ends = substrings.chunk_ends([w.encode() for w in words], cut)
    chunks = [words[a:b] for a, b in zip([0, *ends[:-1]], ends)]
    cutting = [c for c in chunks if len(c) > 1 and len(c[-1]) >= 8 and len(c[-2]) >= 7]  # the look-back ends inside of them
    short = [c for c in cutting if len(c) < cut.together // 2]
    apart = [" ".join(cutting[0] + c) for c in short]
    rows = [*enumerate(apart), (1000, " ".join(w for c in cutting[:1] + short for w in c))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(short) > 10 and substrings.repeated_passages(frame).where("doc_id = 1000").collect() == []


def test_one_word_repeated_in_one_document_is_no_passage(spark):
    words = [f"w{k}" for k in range(200)]
    cutting = next(w for w in words if len(substrings.chunk_ends([w.encode()] * 40, substrings.Cut())) > 30)
    frame = spark.createDataFrame([(1, f"{cutting} " * 8), (2, f"{cutting} " * 60)], "doc_id long, text string")
    assert substrings.repeated_passages(frame).collect() == []


@given(st.lists(st.integers(1, 30), max_size=40))
def test_groups_cover_every_chunk_of_long_runs(sizes):
    ends = np.cumsum(sizes, dtype=np.int64)
    groups = substrings.chunk_groups(ends, 12)
    assert all(b - a >= 12 for a, b in groups)
    if sum(sizes) >= 12:
        assert {w for a, b in groups for w in range(a, b)} == set(range(sum(sizes)))
        assert all(any(a < e < b for a, b in groups) for e in ends[:-1].tolist())


def test_gear_hash_is_the_rolling_one():
    data = bytes(np.random.default_rng(2).integers(0, 256, 200, dtype=np.uint8))
    want, h = [], 0
    for i in range(len(data)):
        h = sum(int(substrings._GEAR[data[i - k]]) << k for k in range(min(i + 1, 16))) & 0xFFFFFFFF
        want.append(h)
    assert substrings.gear_hash(data).tolist() == want


def test_passages_of_odd_and_empty_tables(odd, empty):
    found = substrings.repeated_passages(odd).collect()
    assert {(r.doc_id, r.source_id) for r in found} == {(5, 4)}
    cut = {(r.doc_id, r.text) for r in substrings.without_repeats(odd).collect()}
    assert {t for i, t in cut if i != 5} == {t for i, t, *_ in ODD if i != 5}
    assert substrings.without_repeats(empty).collect() == []


def test_rows_of_one_id_share_passages_with_other_ids_only(spark):
    passage, other = (" ".join(f"{k}{i * i}" for i in range(60)) for k in "ab")
    rows = [(1, passage + " one"), (1, passage + " one"), (1, "x " + other), (2, "before " + passage + " after"), (2, other), (2, other), (None, passage)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.source_id) for r in substrings.repeated_passages(frame).collect()}
    assert found == {(2, 1)}
    cut = sorted(((r.doc_id or 0, len(r.text.split())) for r in substrings.without_repeats(frame).collect()))
    assert [n for i, n in cut if i < 2] == [60, 61, 61, 61] and len(cut) == 7
    assert all(n < 30 for i, n in cut if i == 2)


def test_few_passages_of_fifty_words_are_lost(spark):
    rng = np.random.default_rng(6)
    rows, planted = [], []
    for k in range(150):
        passage = [f"{rng.integers(10**6):x}" for _ in range(51)]
        for i in (k, 1000 + k):
            own = [f"{rng.integers(10**6):x}" for _ in range(40)]
            rows.append((i, " ".join(own[:17] + passage + own[17:])))
        planted.append(1000 + k)
    found = {r.doc_id for r in substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found <= set(planted) and len(found) >= 149


# --- archives ---------------------------------------------------------------------------------------

BIG = "<p>" + "ä" * 600 + "</p>"
PAGES = [
    (1, "http://a", BIG), (2, "http://b\r\nX: y", BIG), (3, None, BIG), (3, "http://c", BIG), (4, "", "short"), (5, "http://d", "short"),
    (6, "http://e", None), (None, "http://f", BIG), (7, "http://g", "\r\n\r\nWARC/1.1\r\n\r\n" * 100), (8, "http://h", "z" * 2_000_000),
    (None, "u", "only null ids " * 100), (None, "v", "only null ids " * 100),
]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    base = shared_path(spark, "warc-test")
    index = warc.normalise(warc.write_archives(pages, f"{base}/a"), f"{base}/b")
    rows = warc.read_records(index).collect()
    last = {BIG: 3}
    want = Counter()
    for page, _, text in PAGES:
        data = (text or "").encode()
        back = text in last and page != last[text]
        want[(page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if back else "response", last[text] if back else None, None if back else data)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) or (None if r.record_type == "revisit" else b"")) for r in rows) == want
    assert {r.url for r in rows if r.page_id in (2, 4)} == {"http://b%0D%0AX: y", ""}
    for archive in {r.archive for r in index.collect()}:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(archive)
        with system.open_input_file(path) as f:
            whole = f.read()
        for line in warc.sidecar(archive):
            member = zlib.decompressobj(31)
            text = member.decompress(whole[line["offset"] : line["offset"] + line["length"]])
            assert member.eof and not member.unused_data and text.startswith(b"WARC/1.1\r\n")
        assert len(list(warc.records(warc.inflated([whole])))) == len(warc.sidecar(archive))


def test_cut_archive_fails_and_empty_table(spark):
    data = warc.record(1, "u", b"abc", 3, "00" * 20, None, "d")
    with pytest.raises(ValueError):
        list(warc.records([data[:-6]]))
    assert warc.archived(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


# --- pages ------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def trees():
    return html.train()


def test_layouts_held_out(trees):
    made = html.Layouts(seed=77)
    doms = [html.parse(made.page()) for _ in range(200)]
    x, parent, depth = html.describe(doms)
    labels = np.concatenate([html._labels(d) for d in doms])
    kept = html.decode(trees.log_odds(x), parent, depth)
    size = np.concatenate([np.bincount([r[0] for r in d.runs], [len(r[1]) for r in d.runs], len(d.kind)) if d.runs else np.zeros(len(d.kind)) for d in doms])
    assert (size * kept * labels).sum() > 0.95 * (size * labels).sum()
    assert (size * kept * labels).sum() > 0.95 * (size * kept).sum()


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 9))
def test_decoding_is_the_best_closed_set(seed, n):
    rng = np.random.default_rng(seed)
    parent = np.array([0] + [int(rng.integers(0, k)) for k in range(1, n)])
    depth = np.zeros(n, int)
    for k in range(1, n):
        depth[k] = depth[parent[k]] + 1
    odds = rng.normal(0, 1, n)
    kept = html.decode(odds, parent, depth)
    assert all(kept[parent[k]] or parent[k] == 0 for k in range(1, n) if kept[k])
    best = max(sum(odds[k] for k in s) for r in range(n) for s in itertools.combinations(range(1, n), r) if all(parent[k] == 0 or parent[k] in s for k in s))
    assert abs(sum(odds[k] for k in range(1, n) if kept[k]) - best) < 1e-9


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>My site</h1><nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav></header>
<div class="cookie-banner">We use cookies to make this site better for you. Please accept them all.</div>
<main><article><h1>A  title</h1><p>First &amp; best paragraph of the
 article, with some words in it. It has <b>bo</b>ld text.<p>Second one<br>goes on for a while as well, and ends here.
<div class="ad">Buy our very good things now, they are cheap.</div></article></main>
<aside class="sidebar"><h3>Popular</h3><ul><li><a href="/c">One more</a></li></ul></aside>
<section id="comments"><div class="comment"><p>I liked this article very much, thank you for it.</p></div></section>
<form action="/s"><label>Search here</label><input></form><footer>&copy; 2020 My site. All rights reserved.</footer></body></html>"""


def test_page(spark, trees):
    rows = [(1, PAGE), (2, None), (3, ""), (4, "<"), (5, "<p>" * 3000 + "deep"), (6, PAGE), (None, "<!-- never closed")]
    frame = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "'x' AS TEXT")
    found = {(r.page_id, r.text) for r in html.extract(frame, trees=trees).select("page_id", "text").collect()}
    text = "A title First & best paragraph of the article, with some words in it. It has bold text. Second one goes on for a while as well, and ends here."
    assert (1, text) in found and (6, text) in found
    assert {(2, ""), (3, ""), (None, "")} <= found
    assert html.extract(frame.limit(0), trees=trees).collect() == []


def test_pages_of_the_table(spark, trees):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")

    def article(page):
        inner = page[page.index("<article>") + 9 : page.index("</article>")]
        from html import unescape

        return " ".join(unescape(re.sub(r"</?(p|h1|br)>", " ", re.sub(r"</?b>", "", inner))).split())

    rows = html.extract(pages, trees=trees).collect()
    assert sum(r.text == article(r.html) for r in rows) >= 0.98 * len(rows)
