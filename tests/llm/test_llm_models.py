"""Learned operators: gradients, held-out accuracy, exact neighbours; pseudonyms and templates."""

import os
import random
import re
import tracemalloc

import numpy as np
import pytest
from helpers import table

from tidemark.llm import decontaminate, language, pseudonyms, quality_votes

SF = "/root/testdata/sf0.01"
given_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def test_gradients_are_those_of_the_loss():
    network = language.Network(["a", "b"], hidden=3)
    rng = np.random.default_rng(0)
    for layer in network.layers:
        layer.weights = {k: v.astype(np.float64) for k, v in layer.weights.items()}
    network.out, network.bias = network.out.astype(np.float64), network.bias.astype(np.float64)
    rows, labels = rng.integers(97, 105, (4, 6)).astype(np.uint8), np.array([0, 1, 1, 0])
    weight = np.ones(rows.shape)
    _, found = network.gradients(rows, labels, weight)
    for array, gradient in zip(network.arrays(), found, strict=True):
        for at in [tuple(rng.integers(0, s) for s in array.shape) for _ in range(3)] + [np.unravel_index(np.abs(gradient).argmax(), array.shape)]:
            old, losses = array[at], []
            for change in (1e-3, -1e-3):
                array[at] = old + change
                losses.append(network.gradients(rows, labels, weight)[0])
            array[at] = old
            assert abs((losses[0] - losses[1]) / 2e-3 - gradient[at]) < 1e-4


@given_tables
def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.predict(docs, language.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) > 0.97 * len(got) and all(0 <= r.score <= 1 for r in got)


def test_no_letters_is_undetermined(spark):
    docs = table(spark, [(1, "12 34 !!"), (2, None), (3, ""), (4, "ab"), (5, "\u00b2 \u00bd \u2460 _"), (6, "7 \u00e9")])
    network = language.Network(["en"])
    assert {r.doc_id: r.lang_pred for r in language.predict(docs, network).collect()} == {1: "und", 2: "und", 3: "und", 4: "en", 5: "und", 6: "en"}


def test_large_scores_do_not_overflow():
    network = language.Network(["a", "b"], hidden=3)
    network.out[:] = 0
    network.bias[:] = [1000, 990]
    found = network.position_probabilities(np.full((1, language.LENGTH), 97, np.uint8))
    assert np.allclose(found[..., 0], 1, atol=1e-3)


def test_a_rare_language_is_learned(spark):
    rows = [(i, f"the cat and the dog number {i} went home", "en", "s") for i in range(400)]
    rows += [(1000 + i, f"zażółć gęślą jaźń {i} i wróć", "pl", "s") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert language.fit(docs, most_documents=20).names == ["en", "pl"]


def test_prediction_equals_position_by_position():
    """One text at a time, one position at a time, by the formulas of the gates."""
    network = language.Network(["a", "b", "c"], hidden=4)
    texts = [b"", b"1 2", "h\u00e9llo W\u00f6rld".encode() * 9, b"x" * 200]
    got = network.documents(texts)
    for text, found in zip(texts, got, strict=True):
        rows, total, letters = language.windows(text), np.zeros(3), 0
        for row in rows:
            each = network.position_probabilities(row[None])[:, 0]
            for byte, p in zip(row, each, strict=True):
                if byte >= 128 or chr(byte).isalpha():
                    total, letters = total + p, letters + 1
        assert np.allclose(found, total / max(1, letters), atol=1e-6)


@given_tables
def test_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_votes.score(docs, quality_votes.fit(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) > 0.95 * len(got)


def test_votes_are_of_the_nearest():
    texts = [w.encode() for w in ["aa bb", "AA!! BB!!", "12 34", "a b c d", "A!! B!! C", "x.y.z", "aaa", "||| |||"]]
    rows, labels = quality_votes.features(texts), np.array([1, 0, 1, 1, 0, 1, 1, 0])
    votes = quality_votes.Votes(rows, labels, neighbours=3, dimensions=5)
    unit = lambda v: v / max(1e-9, np.linalg.norm(v))
    for text, score in zip(texts, votes.scores(texts), strict=True):
        own = unit(quality_votes.features([text])[0] * votes.weight @ votes.directions)
        near = np.array([own @ v for v in votes.vectors])
        chosen = near >= np.sort(near)[-3] - 1e-6
        share = np.where(chosen, np.maximum(near, 0) ** 8 + 1e-12, 0)
        assert abs(score - (share * labels).sum() / share.sum()) < 1e-5


def test_labelled_vectors_are_small_and_held_once():
    rows = quality_votes.features([b"", b"one short text", b"Other words, and 12 numbers." * 40])
    sent = [quality_votes.packed(row) for row in rows]
    assert np.array_equal(quality_votes.unpacked(sent), rows.astype(np.float16).astype(np.float32))
    assert len(sent[0]) == 0 and max(map(len, sent)) < rows[0].nbytes / 20
    many = np.random.default_rng(0).random((1500, quality_votes.SIZE), np.float32)
    tracemalloc.start()
    quality_votes.Votes(many, np.arange(1500) % 2)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < many.nbytes * 0.75


@given_tables
def test_letters_out_of_order_lose_score(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    votes, rng = quality_votes.fit(docs, labels), random.Random(0)
    rows = docs.join(labels.where("quality = 1"), "doc_id").orderBy("doc_id").limit(100).collect()
    texts = [r.text for r in rows if len(r.text) > 500]

    def shuffled(text):
        places = [i for i, c in enumerate(text) if c.islower()]
        letters = iter(rng.sample([text[i] for i in places], len(places)))
        return "".join(next(letters) if c.islower() else c for c in text)

    as_they_are, out_of_order, same = (
        votes.judge([t.encode() for t in made]) for made in (texts, map(shuffled, texts), [re.sub("[a-z]", "x", t) for t in texts])
    )
    assert (out_of_order < as_they_are).mean() > 0.95 and (same < as_they_are).mean() > 0.95
    assert as_they_are.mean() > 0.95


def test_pseudonyms_keep_formats_and_links(spark):
    valid = {
        "card": ["4111111111111111", "4111 1111 1111 1111", "378282246310005", "3782 822463 10005", "4111-1111-1111-1111", "60110 00990 139424"],
        "ssn": ["123-45-6789"],
        "iban": ["DE89370400440532013000", "GB82WEST12345698765432", "DE89 3704 0044 0532 0130 00", "GB82-WEST-1234-5698-7654-32"],
        "phone": ["+1 (017) 555-7713", "(212) 555-1234", "212-555-1234", "212.555.1234", "+4930123456", "+49 30 1234 56"],
        "ip": ["97.51.17.173"], "date": ["1999-12-31", "31/12/1999", "12/31/1999", "29.02.2000", "1/2/2020", "2020-1-5"],
        "email": ["und.34@mail7.example.com", "x" * 90 + "@a.example.com"],
        "secret": ['"' + "24be64439e3e49cf" * 3 + '"', '"' + "24be64439e3e49cf" * 9 + '"'],
    }
    lead = {"secret": "token = "}
    rows = [(k, v) for k, vs in valid.items() for v in vs]
    docs = table(spark, [(i, f"see {lead.get(k, '')}{v}, and {lead.get(k, '')}{v}!") for i, (k, v) in enumerate(rows)])
    for r in pseudonyms.pseudonymise(docs, "k").collect():
        kind, value = rows[r.doc_id]
        assert r[f"n_{kind}"] == 2 and r.n_private == 2 and value not in r.text, (kind, value, r.text)
        one, two = re.fullmatch(r"see (.+), and (.+)!", r.text, re.S).groups()
        assert one == two and (kind == "ip" or kind == "date" and re.search(r"\b\d\b", value) or len(one.removeprefix(lead.get(kind, ""))) == len(value))
        if kind == "card":
            digits = [int(c) for c in one if c.isdigit()][::-1]
            assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
        if kind == "iban":
            bare = re.sub("[ -]", "", one)
            turned = bare[4:] + bare[:4]
            assert int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def test_spellings_of_one_value_have_one_pseudonym(spark):
    pairs = [("+1 212 555 1234", "+12125551234"), ("DE89 3704 0044 0532 0130 00", "DE89370400440532013000"), ("4111-1111-1111-1111", "4111111111111111"), ("1/2/2020", "01.02.2020")]
    docs = table(spark, [(i, f"see {v} now") for i, pair in enumerate(pairs) for v in pair])
    found = {}
    for r in pseudonyms.pseudonymise(docs, "k").collect():
        assert r.n_private == 1
        value = r.text.removeprefix("see ").removesuffix(" now")
        found.setdefault(r.doc_id, set()).add(tuple(int(x) for x in re.split("[./]", value)) if "20" in pairs[r.doc_id][0][-4:] else re.sub("[^0-9A-Z]", "", value))
    assert all(len(x) == 1 for x in found.values()), found


def test_social_numbers_stay_possible_and_apart(spark):
    rows = [(i, f"{a:03}-{g:02}-{n:04}") for i, (a, g, n) in enumerate((1 + i % 665, 1 + i % 99, 1 + 3 * i % 9999) for i in range(3000))]
    rows += [(9000, "899-99-9999"), (9001, "667-01-0001"), (9002, "665-99-9999"), (9003, "001-01-0001")]
    got = [r.text for r in pseudonyms.pseudonymise(table(spark, rows), "k").collect()]
    assert all(re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}", x) for x in got)
    assert len(set(got)) == len({t for _, t in rows})


def test_another_key_gives_other_pseudonyms(spark):
    docs = table(spark, [(1, "call +12125551234 on 2020-01-05")])
    assert pseudonyms.pseudonymise(docs, "k").first().text != pseudonyms.pseudonymise(docs, "l").first().text


def test_invalid_candidates_stay(spark):
    texts = ["4111111111111112", "DE88370400440532013000", "000-12-3456", "999.1.1.1", "1999-13-01", "version 2.0. 3.", "1.2.3.4.5", None, ""]
    got = pseudonyms.pseudonymise(table(spark, list(enumerate(texts))), "k").collect()
    assert [r.text for r in sorted(got)] == texts and all(r.n_private == 0 for r in got)


def test_permutation_is_one_to_one(spark):
    from pyspark.sql import functions as F

    numbers = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("x"))
    moved = {r[0] for r in numbers.select(pseudonyms.permute(F.col("x"), 10, "k", "t")).collect()}
    assert moved == {f"{i:03d}" for i in range(1000)}


ITEM = "If Anna buys 12 apples for 30 euros and then Anna sells 12 of them, how many euros are left for the trip?"


@pytest.mark.parametrize(
    "text,hit",
    [
        (f"before it. {ITEM} after it", True),
        ("So. If Bernd buys 7 apples for 55 dollars and then Bernd sells 7 of them, how many euros are left for the trip?", True),
        ("So. If Bernd buys 7 apples for 55 dollars and then Clara sells 8 of them, how many euros are left at the end?", False),
        ("If you want to know how many euros are left, look into the box on the table in the hall.", False),
        ("12 30 12 7 9 11 30 12 55 60 12 1 2 3", False),
        (None, False),
        ("", False),
    ],
)
def test_templates(spark, text, hit):
    items = spark.createDataFrame([(5, ITEM), (6, "1 2 3 4 5 6 7 8 9"), (7, None)], "item_id long, text string")
    got = decontaminate.decontaminate(table(spark, [(1, text)]), items).collect()
    assert [(r.contaminated, r.kept, r.item_ids) for r in got] == [(hit, not hit, [5] if hit else [])]
    joined = decontaminate.leaks(table(spark, [(1, text)]), items, most_broadcast=0).collect()
    assert [r.item_id for r in joined] == ([5] if hit else [])


LONG = (
    "The old mill by the river grinds 12 sacks of corn before noon and the miller rests for a while under the tall tree "
    "near the bridge. After the rest the new mill on the hill grinds 12 sacks of rye until the sun goes down behind the "
    "woods. How many sacks of corn and rye did both of the mills grind on this day, and how many more are left to grind?"
)
SAME = "A farmer puts 2 red apples and 2 green pears into the big basket and then walks slowly home with Anna and Bob over the long bridge."
TWO = SAME.replace("2 red", "12 red").replace("2 green", "30 green")


@pytest.mark.parametrize(
    "item,text,hit",
    [
        (LONG, LONG.replace("12 sacks of rye", "13 sacks of rye"), True),
        (TWO, TWO.replace("12", "7").replace("30", "7"), True),
        (SAME, SAME.replace("2 red", "3 red").replace("2 green", "5 green"), True),
        (SAME, SAME.replace("Anna", "Carl").replace("Bob", "Carl").replace("2 ", "4 "), True),
        (ITEM, ITEM.replace("then Anna", "then Clara").replace("12 apples", "11 apples").replace("If Anna", "If Bernd").split(", how")[0], False),
    ],
)
def test_inconsistent_slots_cost_only_their_windows(spark, item, text, hit):
    items = spark.createDataFrame([(5, item)], "item_id long, text string")
    got = decontaminate.decontaminate(table(spark, [(1, f"Well. {text} That is it.")]), items).collect()
    assert [r.contaminated for r in got] == [hit]


WHO = "Who wrote the play Hamlet?"
NAMES = "Anna has 12 apples. Bob has 5 more. Anna eats 3. Bob eats 2. How many are left?"


@pytest.mark.parametrize(
    "item,text,hit",
    [
        (WHO, f"Q: {WHO} A: not me", True),
        (WHO, f"Question: {WHO}", True),
        (WHO, f"They asked, {WHO}", True),
        (WHO, f'She said "{WHO}"', True),
        ("Name the longest river of Europe", "Task - Name the longest river of Europe", True),
        (WHO, "Shakespeare wrote the play Hamlet.", False),
        (NAMES, "Carl has 7 apples. Dora has 9 more. Carl eats 4. Dora eats 6. How many are left?", True),
        (NAMES, "So, Carl has 7 apples, Dora has 9 more, Carl eats 4, Dora eats 6, how many are left?", True),
        (NAMES, NAMES.lower(), True),
        (NAMES, "Carl has 7 dogs. Dora sees 9 cats. How many are left?", False),
    ],
)
def test_openers_are_read_either_way(spark, item, text, hit):
    items = spark.createDataFrame([(5, item)], "item_id long, text string")
    got = decontaminate.decontaminate(table(spark, [(1, text)]), items).collect()
    assert [r.contaminated for r in got] == [hit]


@given_tables
def test_given_items_are_found(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, i) for r in decontaminate.decontaminate(docs, items).collect() for i in r.item_ids}
    texts = [(r.item_id, r.text) for r in items.collect()]
    want = {(d.doc_id, i) for d in docs.collect() for i, t in texts if t in d.text}
    assert want <= got and len(got) <= 1.1 * len(want) + 2


def _permuted(text, base, key, kind):
    """The same permutation, number by number."""
    import hashlib

    def step(i, half, tweak):
        return int(hashlib.sha256(f"{key}|{kind}{base}|{i}|{tweak}|{half}".encode()).hexdigest()[:15], 16)

    out = ""
    for at in range(0, len(text), pseudonyms.PIECE):
        part = text[at : at + pseudonyms.PIECE]
        left, right = len(part) // 2, len(part) - len(part) // 2
        a, b, tweak = int(part[:left] or "0", base), int(part[left:], base), f"{len(part)}/{at + 1}"
        for i in range(pseudonyms.ROUNDS):
            if i % 2 == 0:
                a = (a + step(i, b, tweak)) % base**left
            else:
                b = (b + step(i, a, tweak)) % base**right
        out += "".join(np.base_repr(x, base).lower().rjust(n, "0") if n else "" for x, n in ((a, left), (b, right)))
    return out


@pytest.mark.parametrize("base,texts", [(10, ["411111111111111", "7", "0000"]), (36, ["und34", "z"]), (16, ["24be64439e3e49cf" * 3])])
def test_permutation_is_as_described(spark, base, texts):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(t,) for t in texts], "x string")
    got = rows.select("x", pseudonyms.permute(F.col("x"), base, "key", "kind").alias("y")).collect()
    assert {r.x: r.y for r in got} == {t: _permuted(t, base, "key", "kind") for t in texts}
