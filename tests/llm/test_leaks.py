"""Items that windows of templates alone do not find, against plain Python."""

import random
import re
from collections import defaultdict

from panelwright.llm import decontaminate

ITEMS = [
    (1, "What is 12 * 14?"),
    (2, "Convert 12 km 5 m 3 cm to 8 mm and 9 kg 4 g"),
    (3, "The"),
    (4, "tiny one"),
    (5, "If Anna has 3 apples and buys 4 lb more, how many apples does Anna own after 3 days?"),
    (6, "1 2 3 4 5 6 7 8 9 10 11 12"),
    (7, "Which of the two is the larger number"),
]


def found(spark, texts, items=ITEMS, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    frame = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.leaks(docs, frame, **options).collect()
    kept = {r.doc_id for r in decontaminate.without_leaks(docs, frame, **options).collect()}
    assert kept == set(range(len(texts))) - {r.doc_id for r in rows}
    return {(r.doc_id, r.item_id, r.changed) for r in rows}


def test_items_of_hardly_any_plain_words_are_found_word_for_word(spark):
    texts = [
        "so then, what is 12 * 14? I asked",
        "so then, what is 13 * 14? I asked",
        "please Convert 12 km 5 m 3 cm to 8 mm and 9 kg 4 g now",
        "please convert 13 km 6 m 2 cm to 7 mm and 8 kg 5 g now",
        "counting 1 2 3 4 5 6 7 8 9 10 11 12 13",
        "counting 2 3 4 5 6 7 8 9 10 11 12 13 14 and 1 3 5 7 9 11 2 4 6 8 10 12",
        None,
        "",
    ]
    # the sixth has nearly all of item 6, in its order
    assert found(spark, texts) == {(0, 1, False), (2, 2, False), (4, 6, False), (5, 6, False)}


def test_short_items_fill_a_line(spark):
    texts = ["The house on the hill", "the", "first line\nThe\nlast", "a tiny one here", "so\n tiny  one \nso", "tiny\none", "which of the two is the larger number?"]
    assert found(spark, texts) == {(1, 3, False), (2, 3, False), (4, 4, False), (6, 7, False)}


def test_other_values_are_found_where_plain_words_stand_around(spark):
    texts = [
        "well: if Bob has 8 apples and buys 9 kg more, how many apples does Bob own after 8 days? yes",
        "well: if Bob has 8 apples and buys 9 kg more, how many apples does Carl own after 7 days? yes",
    ]
    assert found(spark, texts, min_share=0.9) == {(0, 5, True)}


def tokens_of(text):
    """As the operator cuts them, written with a scanner."""
    out, last_number, end = [], False, 0
    for m in re.finditer(r"\d+(?:[.,]\d+)*|[^\W\d_]+", text):
        word, low = m[0], m[0].lower()
        start = text[: m.start()]
        if word[0].isdigit():
            out.append(("#", low))
            last_number, end = True, m.end()
            continue
        if last_number and low in decontaminate.UNITS and re.fullmatch(r"[ -]*", text[end : m.start()]):
            out.append(("u", low))
        elif word[0].isupper() and word[1:2].islower() and re.search(r"[^.!?:\s][ \t]{1,2}$", start):
            out.append(("n", low))
        else:
            out.append(("", low))
        last_number, end = False, m.end()
    return out


def brute(texts, items, width=8, min_share=0.5):
    got = set()
    for i, text in enumerate(texts):
        doc = tokens_of(text or "")
        for n, item in items:
            its = tokens_of(item)
            w = min(width, len(its))
            least = min(decontaminate.MIN_PLAIN, w)
            shifts = defaultdict(set)
            for p in range(len(its) - w + 1):
                a = its[p : p + w]
                few = sum(k == "" for k, _ in a) < least
                for at in range(len(doc) - w + 1):
                    b = doc[at : at + w]
                    same = a == b if few else [k or t for k, t in a] == [k or t for k, t in b]
                    if same:
                        shifts[at - p] |= set(range(p, p + w))
            cover, changed = set(), False
            for shift, places in shifts.items():
                slots = {(its[p], doc[p + shift]) for p in places if its[p][0]}
                if len({a for a, _ in slots}) == len(slots) == len({b for _, b in slots}):
                    cover |= places
                    changed |= any(a != b for a, b in slots)
            if its and len(cover) / len(its) >= min_share:
                got.add((i, n, changed))
    return got


def test_against_brute_force_with_slots(spark):
    rng = random.Random(4)
    words, names, units = "apple pear box holds many then costs each about how".split(), ["Anna", "Bob", "Carl"], ["km", "kg", "cm"]

    def part():
        k = rng.random()
        if k < 0.25:
            return str(rng.randint(1, 4)) + (f" {rng.choice(units)}" if rng.random() < 0.5 else "")
        return rng.choice(names) if k < 0.4 else rng.choice(words)

    items = [(n, " ".join(["so", *(part() for _ in range(rng.randint(4, 16)))])) for n in range(12)]
    texts = []
    for _ in range(60):
        text = " ".join(part() for _ in range(rng.randint(0, 10)))
        item = rng.choice(items)[1]
        if rng.random() < 0.4:
            a, b = rng.sample("1234", 2)
            item = item.replace(a, "\0").replace(b, a).replace("\0", b)
        if rng.random() < 0.3:
            item = item.replace("Anna", "Dora")
        texts.append(f"well {text} , {item} and {part()}")
    want = brute(texts, items)
    assert len(want) > 40 and any(c for *_, c in want)
    assert found(spark, texts, items) == want
