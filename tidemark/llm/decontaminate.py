"""Benchmark questions inside documents, also with other numbers, names and units.

A text becomes a template: words in lower case without the signs around them,
numbers, names (capitalised inside a sentence; neighbours are one name) and
units (after a number) as typed placeholders. A capitalised word that opens a
sentence, a line, a quote or what follows a colon is read both as a word and as a
name; ``COMMON`` words are names only beside a name. Windows of ``WINDOW`` template
tokens of documents and items meet by a hash join; shorter items are one window
of their own length. Items' windows are few as a rule: up to ``MOST_BROADCAST``
of them, counted first, tasks drop windows of documents that no item has before
the join. Beyond that, all windows are joined by a shuffle.

Windows of one document, item and offset are one alignment. Those whose fillings
are equal count. Of the others, each run of neighbouring windows counts if equal
names, numbers and units of the item are equal in the document too. Two equal numbers
may also become different ones, as they may be equal by chance, where the run
has ``WORDS_A_SLOT`` words or more for each of its slots. Windows of fewer than ``LITERALS`` words
count only if the fillings are equal, which are then part of what is joined by. A document is contaminated
by an item if at least ``ENOUGH`` of the item's windows count in alignments, or half
of them where that is less. An item of one window and fewer than ``LITERALS`` words
("Paris") must be a whole sentence, line, quote or what follows a colon.

Null and empty texts have no windows and stay. Null item ids are ids like
others. Rows that repeat a document are judged alike; rows that repeat a doc_id
with another text on their own. Documents' extra columns are ignored.
"""

from __future__ import annotations

import itertools
import sys
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, slices, workspace

WINDOW = 8
LITERALS = 4
ENOUGH = 6
#: Words for each slot of a run from which on two equal numbers may be equal by chance.
WORDS_A_SLOT = 5
MOST_BROADCAST = 2_000_000
#: Words that are a unit after a number (fixed values).
UNITS = frozenset(
    "% percent € $ £ euro euros dollar dollars cent cents mm cm m km meter meters metre metres kilometer kilometers "
    "mile miles foot feet inch inches yard yards g kg gram grams kilogram kilograms pound pounds ounce ounces ton tons "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week "
    "weeks month months year years mph kmh degree degrees °c °f watt watts kw volt volts hz".split()
)
#: Words that open sentences and are no names (fixed values).
COMMON = frozenset(
    "who whom whose what which when where why how the this that these those there it he she we they you his her its our their your "
    "my if in on at of to for from by with and or but so as after before while during since then than is are was were do does did "
    "has have had can could would should not no all each every some many much wer wen wem wessen was welche welcher welches wann wo "
    "warum wie der die das den dem des ein eine einen einem einer es er sie wir ihr wenn im am an auf bei mit von zu und oder aber nach "
    "vor ist sind war waren hat haben kann nicht alle jede jeder qui que quoi quel quelle quels quelles quand où pourquoi comment "
    "combien le la les un une des ce cette ces il elle nous vous ils elles si dans sur à de du pour par avec et ou mais est sont a "
    "quién qué cuál cuáles cuándo dónde cómo cuánto cuánta cuántos cuántas el los las una unos unas este esta estos en por con y o "
    "pero es son él ella ellos".split()
) - {"a", "y", "o"}
#: Low bits of a filling: number, name or unit.
NUMBER, NAME, UNIT = 1, 2, 3
NUMBER_CODE, NAME_CODE, UNIT_CODE = (np.uint64(x << 4) for x in (1, 2, 3))
FACTOR = 0x9E3779B97F4A7C15
#: Characters of one step of reading, up to the next space.
PIECE = 1 << 18
#: What a character is: a bit for each.
LETTER, DIGIT, SIGN, JOINS_WORD, JOINS_NUMBER, STOP, UPPER, LOWER = (1 << i for i in range(8))
MEANINGS = {"%€$£": SIGN, "'’-": JOINS_WORD, ".,:/": JOINS_NUMBER, ".!?:\"“”„«»‘’'\n": STOP}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """What each character is, and a number for it that a capital shares with its small letter."""
    what, low = np.zeros(sys.maxunicode + 1, np.uint8), np.arange(sys.maxunicode + 1, dtype=np.uint64)
    for point, c in enumerate(map(chr, range(sys.maxunicode + 1))):
        if c.isalnum():
            what[point] = DIGIT if c.isdecimal() else LETTER
            if c.isupper():
                what[point] |= UPPER
                low[point] = ord(c.lower()[0])
            elif c != c.upper():
                what[point] |= LOWER
    for characters, bit in MEANINGS.items():
        what[[ord(c) for c in characters]] |= bit
    return what, _mixed(low + np.uint64(FACTOR))


def _tokens(text: str):
    """Hash, kind (LETTER, DIGIT or SIGN), capital, place and number of stops before of each token; number of all stops.

    Apostrophes and hyphens join words, dots, commas, colons and slashes join numbers;
    a currency or percent sign is a token, so is a degree sign with its C or F.
    """
    table, numbers = _characters()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    what = table[points]
    kind = what & (LETTER | DIGIT | SIGN)
    degree = np.flatnonzero(points[:-1] == ord("°"))
    if len(degree):
        after = np.append(kind, 0)[degree + 2] & (LETTER | DIGIT)
        degree = degree[np.isin(points[degree + 1], [ord(c) for c in "CFcf"]) & (after == 0)]
        kind[degree] = kind[degree + 1] = SIGN
    for joins, of in ((JOINS_WORD, LETTER), (JOINS_NUMBER, DIGIT)):
        joint = np.flatnonzero(what[1:-1] & joins) + 1
        kind[joint[(kind[joint - 1] & of > 0) & (kind[joint + 1] & of > 0)]] = of
    stops = np.cumsum((kind == 0) & (what & STOP > 0))
    starts = np.ones(len(points), bool)
    starts[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == SIGN)
    starts[degree + 1] = False
    inside = np.flatnonzero(kind)
    first = np.flatnonzero(starts[inside])
    at = inside[first]
    lengths = np.diff(first, append=len(inside))
    if not len(first):
        return np.zeros(0, np.uint64), kind[at], np.zeros(0, bool), at, stops[at], int(stops[-1]) if len(stops) else 0
    powers = np.multiply.accumulate(np.full(int(lengths.max()), FACTOR, np.uint64))
    place = np.arange(len(inside)) - np.repeat(first, lengths)
    hashes = _mixed(np.add.reduceat(numbers[points[inside]] * powers[place], first)) & ~np.uint64(15)
    small = np.logical_or.reduceat(what[inside] & LOWER > 0, first)
    capital = (what[at] & UPPER > 0) & (small | (lengths == 1))
    return hashes, kind[at], capital, at, stops[at], int(stops[-1])


def _pieces(text: str):
    """The text in pieces that end before a space, as no token goes across one."""
    start = 0
    while (end := text.find(" ", start + PIECE)) >= 0:
        yield text[start:end]
        start = end
    yield text[start:]


@cache
def _hashes(words: frozenset[str]) -> np.ndarray:
    """Sorted hashes of words of one token each."""
    return np.sort(np.concatenate([_tokens(w)[0] for w in words]))


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


def templates(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Template codes and fillings (0 for words) of all texts, which are words or names, which open a sentence, and where each text ends.

    Words that may be names have the code of the word and the filling of the name.
    """
    read, start, passed = [], 0, 0
    for piece in _pieces("\n".join(texts)):
        *columns, at, before, stops = _tokens(piece)
        read.append((*columns, at + start, before + passed))
        start, passed = start + len(piece), passed + stops
    word, kind, capital, at, stops = (np.concatenate(c) for c in zip(*read, strict=True))
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), at, side="right")
    near = np.zeros(len(word), bool)  # to the token before, in one text
    near[1:] = owner[1:] == owner[:-1]
    opens = ~near  # a sentence
    opens[1:] |= stops[1:] != stops[:-1]
    number = kind == DIGIT
    unit = near & ~number & _among(word, _hashes(UNITS))
    unit[1:] &= number[:-1]
    capital &= ~unit
    name = capital & ~opens
    beside = np.zeros(len(word), bool)  # a name
    beside[1:] |= near[1:] & name[:-1]
    beside[:-1] |= near[1:] & name[1:]
    common = capital.copy()
    common[capital] = _among(word[capital], _hashes(COMMON))
    name &= ~common | beside
    either = capital & opens & ~common
    code = word.copy()
    code[number], code[unit], code[name] = NUMBER_CODE, UNIT_CODE, NAME_CODE
    sort = number * np.uint64(NUMBER) + (name | either) * np.uint64(NAME) + unit * np.uint64(UNIT)
    filling = np.where(sort > 0, word | sort, np.uint64(0))
    again = near.copy()  # the rest of a name
    again[1:] &= name[1:] & name[:-1]
    code, filling, either, opens, owner = code[~again], filling[~again], either[~again], opens[~again], owner[~again]
    return code, filling, either, opens, np.searchsorted(owner, np.arange(len(texts)), side="right")


def _windows(code: np.ndarray, filling: np.ndarray, either: np.ndarray, ends: np.ndarray, size: int):
    """Places, hashes, reading and number of words of windows of ``size`` codes, for each reading of the words that may be names.

    A bit of the reading says whether the window's first, second ... such word is a name.
    """
    n = len(code) - size + 1
    if n <= 0:
        return
    text = np.searchsorted(ends, np.arange(len(code)), side="right")
    at = np.flatnonzero(text[:n] == text[size - 1 :])
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total = (total ^ code[i : i + n]) * np.uint64(FACTOR)
        total ^= total >> np.uint64(29)
    slots = np.concatenate([[0], np.cumsum((filling > 0) & ~either)])
    literals = size - (slots[size:] - slots[:-size])
    yield at, total[at], 0, literals[at]
    before = np.concatenate([[0], np.cumsum(either)])
    words = (before[size:] - before[:-size])[at]
    for reading in range(1, 1 << size):
        some = words >= reading.bit_length() if reading & (reading - 1) == 0 else some
        here = at[some]
        if not len(here):
            return
        total, seen = np.full(len(here), size, np.uint64), np.zeros(len(here), np.int64)
        for i in range(size):
            is_either = either[here + i]
            total = (total ^ np.where(is_either & (reading >> seen & 1 > 0), NAME_CODE, code[here + i])) * np.uint64(FACTOR)
            total ^= total >> np.uint64(29)
            seen += is_either
        yield here, total, reading, literals[here] - reading.bit_count()


def _fillings(filling: np.ndarray, either: np.ndarray, at: np.ndarray, size: int, reading: int) -> np.ndarray:
    """What fills the windows at ``at`` in this reading."""
    places = at[:, None] + np.arange(size)
    words = either[places]
    seen = np.cumsum(words, 1) - words
    return np.where(words & (reading >> seen & 1 == 0), np.uint64(0), filling[places]).astype(np.int64)


ROWS = "id long, at int, tokens int, window long, fillings array<long>, whole boolean"
STEP = 20_000


def _rows(ids, texts: list[str], sizes, only: np.ndarray | None):
    """Window rows of texts; ``sizes`` None: one size for each text, of its own length."""
    code, filling, either, opens, ends = templates(texts)
    opens = np.append(opens, True)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    lengths = ends - starts
    sizes_here = sizes if sizes is not None else np.unique(np.clip(lengths[lengths > 0], None, WINDOW)).tolist()
    for size, (at, hashes, reading, literals) in ((s, w) for s in sizes_here for w in _windows(code, filling, either, ends, s)):
        few = np.flatnonzero(literals < LITERALS)  # such windows meet only if their fillings are equal
        for part in (few[a : a + STEP] for a in range(0, len(few), STEP)):
            for slot in _fillings(filling, either, at[part], size, reading).view(np.uint64).T:
                mixed = (hashes[part] ^ slot) * np.uint64(FACTOR)
                hashes[part] = mixed ^ (mixed >> np.uint64(29))
        if only is not None:
            wanted = _among(hashes, only)
            at, hashes = at[wanted], hashes[wanted]
        text = np.searchsorted(ends, at, side="right")
        if sizes is None:
            fits = np.minimum(lengths[text], WINDOW) == size
            at, text, hashes = at[fits], text[fits], hashes[fits]
        for a in range(0, len(at), STEP):
            here, own = at[a : a + STEP], text[a : a + STEP]
            fillings = _fillings(filling, either, here, size, reading)
            flat = pa.ListArray.from_arrays(np.arange(0, fillings.size + 1, size, dtype=np.int32), fillings.ravel())
            columns = [
                ids.take(pa.array(own)),
                pa.array((here - starts[own]).astype(np.int32)),
                pa.array(lengths[own].astype(np.int32)),
                pa.array(hashes[a : a + STEP].view(np.int64)),
                flat,
                pa.array(opens[here] & opens[here + size]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "at", "tokens", "window", "fillings", "whole"])


def _window_rows(rows: DataFrame, sizes=None, only=None) -> DataFrame:
    def run(batches):
        wanted = None if only is None else only.value
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            for a, b in slices(texts, 1 << 20):
                yield from _rows(batch["id"][a:b], texts[a:b], sizes, wanted)

    return rows.mapInArrow(run, ROWS)


def _consistent(slots: dict[int, tuple[int, int]], tokens: int) -> bool:
    """Whether equal fillings of the item (place: item's, document's) have become equal ones of the document."""
    became: dict[int, list[int]] = {}
    for item, doc in slots.values():
        became.setdefault(item, []).append(doc)
    chance = tokens - len(slots) >= WORDS_A_SLOT * len(slots)
    return all(len(set(docs)) == 1 or chance and len(docs) == 2 and item & 3 == NUMBER for item, docs in became.items())


def _counted(found: list[dict], size: int) -> list[int]:
    """Places in the item of an alignment's windows that count."""
    windows: dict = {}
    for f in found:
        if f["item_at"] not in windows or (f["equal"], -len(f["slots"])) > (windows[f["item_at"]]["equal"], -len(windows[f["item_at"]]["slots"])):
            windows[f["item_at"]] = f
    changed = sorted(at for at, f in windows.items() if not f["equal"])
    counted = [at for at, f in windows.items() if f["equal"]]
    for _, run in itertools.groupby(enumerate(changed), lambda x: x[1] - x[0]):
        run = [at for _, at in run]
        if _consistent({p["place"]: (p["item"], p["doc"]) for at in run for p in windows[at]["slots"]}, len(run) + size - 1):
            counted += run
    return counted


def _aligned(batches):
    for batch in batches:
        both = zip(batch["found"].to_pylist(), batch["item_tokens"].to_pylist(), strict=True)
        places = pa.array([_counted(f, min(WINDOW, n)) for f, n in both], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("doc_key", "item_id", "item_tokens")), places], ["doc_key", "item_id", "item_tokens", "places"])


def leaks(docs: DataFrame, items: DataFrame, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """doc_key, item_id and the number of its windows that a document holds, for contaminated documents.

    ``doc_key`` is a hash of doc_id and text (``document_key``).
    """
    spark = docs.sparkSession
    work = workspace(spark, "decontaminate")
    rows = items.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    known, seen = work.store(_window_rows(rows), "items")
    known = known.select(  # whether the item's own windows are whole sentences does not matter
        F.col("id").alias("item_id"), F.col("at").alias("item_at"), "window", F.col("fillings").alias("item_fillings"), F.col("tokens").alias("item_tokens")
    )
    sizes = [r["n"] for r in known.select(F.size("item_fillings").alias("n")).distinct().collect()]  # at most WINDOW
    only = None
    if seen["rows"] <= most_broadcast:
        hashes = known.select("window").distinct().toArrow()["window"].to_numpy()
        only = spark.sparkContext.broadcast(np.sort(hashes.view(np.uint64)) if len(hashes) else np.zeros(1, np.uint64))
    texts = docs.select(document_key(docs).alias("id"), F.col("text").cast("string").alias("text"))
    held = _window_rows(texts, sizes, only).withColumnRenamed("id", "doc_key")
    joined = held.join(known, "window").where(F.size("fillings") == F.size("item_fillings"))
    literals = F.size(F.filter("item_fillings", lambda x: x == 0))
    equal = F.col("fillings") == F.col("item_fillings")
    joined = joined.where((literals >= LITERALS) | equal & (F.col("whole") | (F.col("item_tokens") > WINDOW)))
    pairs = F.zip_with("item_fillings", "fillings", lambda a, b: F.struct(a.alias("item"), b.alias("doc")))
    placed = F.transform(pairs, lambda p, i: F.struct((F.col("item_at") + i).alias("place"), p["item"].alias("item"), p["doc"].alias("doc")))
    slots = F.filter(placed, lambda p: p["item"] != 0)
    aligned = (
        joined.select("doc_key", "item_id", "item_tokens", (F.col("at") - F.col("item_at")).alias("offset"), F.struct("item_at", equal.alias("equal"), slots.alias("slots")).alias("window"))
        .groupBy("doc_key", "item_id", "offset", "item_tokens")
        .agg(F.collect_set("window").alias("found"))
        .select("doc_key", "item_id", "item_tokens", "found")
        .mapInArrow(_aligned, "doc_key long, item_id long, item_tokens int, places array<int>")
    )
    held_windows = F.size(F.array_distinct(F.flatten(F.collect_list("places"))))
    of_item = F.col("item_tokens") - F.least("item_tokens", F.lit(WINDOW)) + 1
    need = F.least(F.lit(ENOUGH), F.ceil(of_item / 2))
    return (
        aligned.groupBy("doc_key", "item_id", "item_tokens")
        .agg(held_windows.alias("windows"))
        .where(F.col("windows") >= need)
        .select("doc_key", "item_id", "windows")
    )


def document_key(docs: DataFrame):
    return F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("string"))


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, contaminated, kept, item_ids (ascending) and n_windows of every document."""
    work = workspace(docs.sparkSession, "decontaminated")
    found, _ = work.store(leaks(docs, items), "leaks")
    found = found.groupBy("doc_key").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.sum("windows").alias("n_windows"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), document_key(docs).alias("doc_key"))
    hit = F.col("n_windows").isNotNull()
    return rows.join(found, "doc_key", "left").select(
        "doc_id",
        hit.alias("contaminated"),
        (~hit).alias("kept"),
        F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
        F.coalesce("n_windows", F.lit(0)).cast("long").alias("n_windows"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    work = workspace(docs.sparkSession, "leaks")
    name = fresh(docs, "leak")
    found, _ = work.store(leaks(docs, items).select(F.col("doc_key").alias(name)).distinct(), "leaks")
    return docs.join(found, document_key(docs) == F.col(name), "left_anti")
