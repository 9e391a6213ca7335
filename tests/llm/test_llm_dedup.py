"""Exact, near and substring deduplication against brute force."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from helpers import ROWS, components, shingles, table
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import exact_dedup, near_dedup, suffix_dedup


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), unique=True, max_size=200))
def test_golomb_round_trip(values):
    want = np.array(sorted(values), np.uint64)
    assert np.array_equal(exact_dedup.golomb_decode(exact_dedup.golomb_encode(want)), want)


@pytest.mark.parametrize("packet_rows", [2, 1000])
def test_exact_groups(spark, packet_rows):
    got = {r.doc_id: r for r in exact_dedup.exact_duplicates(table(spark), packet_rows).collect() if r.doc_id != 7}
    bare = {i: "".join(c for c in t or "" if c not in " \t\n\v\f\r") for i, t in ROWS}
    for i, text in bare.items():
        if i == 7:
            continue
        same = [(-len(t or ""), j is None, j or 0, j) for j, t in ROWS if bare[j] == text]
        assert (got[i].keep_id, got[i].group_size) == (min(same)[3], len(same))
        assert got[i].kept == (got[i].keep_id == i)
        assert got[i].text_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_one_of_the_same_rows_stays(spark):
    rows = [(7, "same text"), (7, "same text"), (7, "another")]
    assert sorted(r.text for r in exact_dedup.without_copies(table(spark, rows)).collect()) == ["another", "same text"]


def _noisy(seed=3, groups=6, size=12):
    """Texts with a few changed words each, around the threshold, in chains and crowds."""
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([6, 40, 150]))]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                base = words
            rows.append(" ".join(words))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("percent,block", [(80, 1024), (85, 1024), (85, 5)])
def test_near_duplicates(spark, monkeypatch, percent, block):
    monkeypatch.setattr(near_dedup, "BLOCK_CLASSES", block)
    rows = [*_noisy(), (900, None), (901, ""), (902, "two words"), (903, "TWO words")]
    sets = {i: shingles(t) for i, t in rows}
    links = [
        (a, b) for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    want = components(sets, links)
    got = near_dedup.near_duplicates(table(spark, rows), percent).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(sets[r.doc_id]) and r.kept == (want[r.doc_id] == r.doc_id) for r in got)


def test_rows_that_repeat_a_doc_id_are_judged_by_their_own_text(spark):
    base = [(i % 23, t) for i, t in _noisy()] + [(3, "one text alone here now"), (3, "another text quite alone"), (None, "one text alone here now")]
    rows = [(i, t) for i, t in base if i is not None]
    sets = [shingles(t) for _, t in rows]
    links = [
        (a, b) for a, b in itertools.combinations(range(len(rows)), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    roots = components(range(len(rows)), links)
    least = {}
    for n, (i, _) in enumerate(rows):
        least[roots[n]] = min(i, least.get(roots[n], i))
    want = sorted((i, least[roots[n]]) for n, (i, _) in enumerate(rows))
    got = near_dedup.near_duplicates(table(spark, base), 80).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == want
    kept = sorted((r.doc_id, r.text) for r in near_dedup.without_near_copies(table(spark, base)).where("doc_id IS NOT NULL").collect())
    assert kept == sorted((i, t) for n, (i, t) in enumerate(rows) if least[roots[n]] == i)


def test_a_unique_row_is_not_lost_with_its_namesake(spark):
    text = "the quick brown fox jumps over the lazy dog"
    docs = table(spark, [(3, text), (7, text.upper()), (7, "a text unlike all of the others in the table")])
    assert sorted((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()) == [(3, 3, True), (7, 3, False), (7, 7, True)]
    assert sorted((r.doc_id, r.text[:3]) for r in near_dedup.without_near_copies(docs).collect()) == [(3, "the"), (7, "a t")]


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(0)
    items = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    one, two = near_dedup.registers(items[:2000]), near_dedup.registers(items[1000:])
    assert np.array_equal(np.maximum(one, two), near_dedup.registers(items))
    grid = np.linspace(0, 1, 101)
    counts = (one > two).sum(), (one < two).sum(), (one == two).sum()
    likely = [near_dedup.log_likelihood(*counts, 2000.0, 2000.0, s) for s in grid]
    assert abs(grid[int(np.argmax(likely))] - 1 / 3) < 0.15


def _brute_repeats(rows, length=100):
    seen, out = set(), {}
    for i, text in sorted((i, (t or "").encode()) for i, t in rows):
        gone = bytearray(len(text))
        for k in range(len(text) - length + 1):
            if text[k : k + length] in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(text[k : k + length])
        kept = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        out[i] = (len(text), sum(gone), sum(k for k, _ in itertools.groupby(gone)), kept)
    return out


@pytest.mark.parametrize("hot,part", [(200_000, 1 << 20), (2, 1 << 20), (200_000, 300)])
def test_repeats(spark, monkeypatch, hot, part):
    monkeypatch.setattr(suffix_dedup, "PART", part)
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.randrange(1, 9)))
    passage = " ".join(word() for _ in range(40))
    rows = [(i, " ".join(word() for _ in range(rng.randrange(60)))) for i in range(20)]
    rows += [(30 + i, t[: rng.randrange(len(t) + 1)] + passage[i:] + t[::-1]) for i, (_, t) in enumerate(rows)]
    rows += [(60, "a" * 500), (61, "ab" * 300), (62, rows[3][1] * 3), (63, None), (64, ""), (65, "a" * 99), (66, "a" * 100)]
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.without_repeats(table(spark, rows), 2000, hot).collect()}
    want = _brute_repeats(rows)
    assert {i: (a, b, c, bytes(k)) for i, (a, b, c, k) in got.items()} == want


def test_repeats_far_inside_a_long_text_after_a_short_one(spark):
    rng = random.Random(2)
    passage = rng.randbytes(150).hex()
    long = rng.randbytes((9 << 20) // 4).hex() + passage + "z"
    rows = [(1, "a short row"), (2, long), (3, "<" + passage + ">"), (4, "the end")]
    docs = table(spark, rows).coalesce(1)
    got = {r.doc_id: (r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in suffix_dedup.without_repeats(docs).collect()}
    assert got == {1: (0, 0, b"a short row"), 2: (0, 0, long.encode()), 3: (300, 1, b"<>"), 4: (0, 0, b"the end")}


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=200), st.integers(1, 4))
def test_suffix_array(data, letters):
    text = np.concatenate([np.frombuffer(data, np.uint8) % letters + 1, np.zeros(120)]).astype(np.uint8)
    array = suffix_dedup.suffix_array(text, suffix_dedup._words(text))
    whole = text.tobytes()
    some = [whole[i : i + 100] for i in array if i < len(data)]
    assert some == sorted(some) and sorted(array) == list(range(len(text)))
    wanted = np.flatnonzero(np.arange(len(data)) % 3 == 0)
    part = suffix_dedup.suffix_array(text, suffix_dedup._words(text), wanted)
    assert set(wanted) <= set(part) and len(set(part)) == len(part)
    some = [whole[i : i + 100] for i in part if i < len(data)]
    assert some == sorted(some)
