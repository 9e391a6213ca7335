"""Template decontamination against a plain reading of its rules, document by document."""

import itertools
import os
import random
import re

import pytest

from helpers import table
from tidemark.llm import decontaminate
from tidemark.llm.decontaminate import COMMON, ENOUGH, LITERALS, UNITS, WINDOW, WORDS_A_SLOT

SF = "/root/testdata/sf0.01"
given_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")
PARTS = re.compile(r"(\d+(?:[.,:/]\d+)*)|([^\W\d_]+(?:['’\-][^\W\d_]+)*)|(°[CFcf](?!\w)|[%€$£])|([.!?:\"“”„«»‘’'\n])")


def tokens(text):
    """(code, filling, may be a name, opens a sentence) of each token; fillings are words with their kind."""
    out, opens, before = [], True, None
    for m in PARTS.finditer(text or ""):
        number, word, sign, stop = m.groups()
        if stop:
            opens = True
            continue
        low = m.group().lower()
        if number:
            kind = "number"
        elif before == "number" and low in UNITS:
            kind = "unit"
        else:
            own = m.group()
            capital = own[0].isupper() and (own != own.upper() or len(own) == 1)
            kind = "capital" if capital else "word"
        out.append([kind, low, opens])
        opens, before = False, kind
    certain = [k == "capital" and not o for k, _, o in out]
    read = []
    for i, (kind, low, opened) in enumerate(out):
        common = low in COMMON
        beside = i > 0 and certain[i - 1] or i + 1 < len(out) and certain[i + 1]
        name = certain[i] and (not common or beside)
        either = kind == "capital" and opened and not common
        if name and read and read[-1][4]:
            continue  # the rest of a name
        if kind in ("number", "unit"):
            read.append((f"<{kind}>", (kind, low), False, opened, False))
        elif name:
            read.append(("<name>", ("name", low), False, opened, True))
        else:
            read.append((low, ("name", low) if either else None, either, opened, False))
    return read


def readings(text, size):
    """(place, codes, fillings, whole) of each window in each reading."""
    read = tokens(text)
    for at in range(len(read) - size + 1):
        window = read[at : at + size]
        whole = window[0][3] and (at + size == len(read) or read[at + size][3])
        for names in itertools.product(*[(False, True) if t[2] else (None,) for t in window]):
            codes = tuple("<name>" if n else t[0] for t, n in zip(window, names, strict=True))
            fillings = tuple(None if n is False else t[1] for t, n in zip(window, names, strict=True))
            yield at, codes, fillings, whole


def holds(text, item):
    """How many windows of the item count in the text, if they are enough."""
    n = len(tokens(item))
    size = min(WINDOW, n)
    if not n:
        return 0
    alignments = {}
    own = list(readings(item, size))
    by_codes = {}
    for at, codes, fillings, _ in own:
        by_codes.setdefault(codes, []).append((at, fillings))
    for at, codes, fillings, whole in readings(text, size):
        for item_at, item_fillings in by_codes.get(codes, []):
            equal = fillings == item_fillings
            words = sum(f is None for f in item_fillings)
            if words >= LITERALS or equal and (whole or n > WINDOW):
                slots = {item_at + i: pair for i, pair in enumerate(zip(item_fillings, fillings, strict=True)) if pair[0]}
                alignments.setdefault(at - item_at, {}).setdefault(item_at, []).append((equal, slots))
    places = set()
    for windows in alignments.values():
        best = {at: max(found, key=lambda f: (f[0], -len(f[1]))) for at, found in windows.items()}
        places |= {at for at, (equal, _) in best.items() if equal}
        run = []
        for at in range(n + 1):
            if at in best and not best[at][0]:
                run.append(at)
                continue
            slots = {place: pair for a in run for place, pair in best[a][1].items()}
            became = {}
            for a, b in slots.values():
                became.setdefault(a, []).append(b)
            many = len(run) + size - 1 - len(slots) >= WORDS_A_SLOT * len(slots)
            if all(len(set(v)) == 1 or many and len(v) == 2 and k[0] == "number" for k, v in became.items()):
                places |= set(run)
            run = []
    need = min(ENOUGH, -(-(n - size + 1) // 2))
    return len(places) if len(places) >= need else 0


def found(spark, docs, items):
    rows = decontaminate.decontaminate(docs, items).collect()
    return {(r.doc_id, i) for r in rows for i in r.item_ids}


TWELVE = "Tom has 12 apples and 12 pears and 12 plums in the box and he sells some of them to his friends each day."
SHOP = "The shop sells 12 apples and then 12 pears and later 12 plums, but in the end 12 nuts remain."
BASES = [
    SHOP,
    TWELVE,
    "If Anna buys 12 apples for 30 euros and then Anna sells 12 of them, how many euros are left for the trip?",
    "Paris",
    "Yes, it is",
    "Who wrote the play Hamlet?",
    "Anna has 12 apples. Bob has 5 more. Anna eats 3. Bob eats 2. How many are left?",
    "A farmer puts 2 red apples and 2 green pears into the big basket and then walks slowly home with Anna and Bob over the long bridge.",
    "12 13 14 15 16 17 18 19 20 21 22",
    "It was 20 °C in l'Aquila and 30 % of the well-known 3.5 km road was at 12:30 free of snow, O'Neil said.",
]


def variants(rng, text):
    """The text with numbers, names or words changed at random, inside other words."""
    change = rng.choice([0, 0.2, 0.6, 1])
    numbers = {}
    def number(m):
        if rng.random() > change:
            return m.group()
        fresh = rng.choice(["7", "8", "999", "55"])
        return fresh if rng.random() < 0.3 else numbers.setdefault(m.group(), fresh)
    out = re.sub(r"\d+", number, text)
    for name, other in (("Anna", "Clara"), ("Bob", "Ben"), ("Tom", "Max"), ("euros", "dollars"), ("apples", "nuts")):
        if rng.random() < 0.3:
            out = out.replace(name, other, rng.choice([1, 9]))
    if rng.random() < 0.2:
        out = out.lower()
    return rng.choice(["", "Q: ", "He said ", "Well. ", "5 Anna "]) + out + rng.choice(["", " after it", " That is it.", "\n\n"])


@pytest.mark.parametrize("seed", [1, 2])
def test_templates_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = [variants(rng, rng.choice(BASES)) for _ in range(150)] + [f"{variants(rng, a)} {variants(rng, b)}" for a, b in itertools.permutations(BASES, 2)]
    items = spark.createDataFrame(list(enumerate(BASES)), "item_id long, text string")
    want = {(d, i) for d, t in enumerate(texts) for i, item in enumerate(BASES) if holds(t, item)}
    assert found(spark, table(spark, list(enumerate(texts))), items) == want
    assert len(want) > 100


@given_tables
def test_given_documents_equal_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    rows = items.collect()
    starts = {r.item_id: {codes for _, codes, _, _ in readings(r.text, min(WINDOW, len(tokens(r.text))))} for r in rows}
    want = set()
    for doc_id, text in texts:
        windows = {size: {codes for _, codes, _, _ in readings(text, size)} for size in {min(WINDOW, len(tokens(r.text))) for r in rows}}
        want |= {(doc_id, r.item_id) for r in rows if any(starts[r.item_id] & w for w in windows.values()) and holds(text, r.text)}
    assert found(spark, docs, items) == want


@pytest.mark.parametrize(
    "item,text,hit",
    [
        ("Paris", "I love Paris in May", False),
        ("Paris", "Where? Paris. Of course", True),
        ("Yes, it is", "He said yes, it is raining", False),
        (SHOP, SHOP.replace("12 apples", "7 apples").replace("12 pears", "8 pears").replace("12 plums", "999 plums"), False),
        (SHOP, SHOP.replace("12", "7"), True),
        (TWELVE, TWELVE.replace("12 apples", "7 apples").replace("12 pears", "8 pears"), True),  # its end is copied word for word
    ],
)
def test_consistency_and_short_items(spark, item, text, hit):
    items = spark.createDataFrame([(5, item)], "item_id long, text string")
    assert found(spark, table(spark, [(1, text)]), items) == ({(1, 5)} if hit else set())


def test_long_texts_are_read_as_short_ones(monkeypatch):
    texts = [variants(random.Random(i), b) for i, b in enumerate(BASES)]
    whole = decontaminate.templates(texts)
    monkeypatch.setattr(decontaminate, "PIECE", 5)
    for a, b in zip(whole, decontaminate.templates(texts), strict=True):
        assert a.tolist() == b.tolist()


def test_unrelated_texts_stay(spark):
    rng = random.Random(0)
    words = [w for b in BASES for w in b.lower().split()]
    texts = [" ".join(rng.choices(words, k=200)) for _ in range(300)]
    items = spark.createDataFrame([(i, b) for i, b in enumerate(BASES) if len(b) > 20], "item_id long, text string")
    assert not found(spark, table(spark, list(enumerate(texts))), items)
