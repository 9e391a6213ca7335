"""Quality of documents by votes of their nearest labelled neighbours.

A document's vector counts trigrams of character classes, trigrams of letters and
words over its whole text (square roots of their shares, weighted by rarity, letters
and words in hashed bins), projected onto the leading latent directions of the
labelled documents. The labelled vectors (at most
``most_labels`` of them, a documented bound, so also a bound on the broadcast)
go to every task, which multiplies blocks of documents with all of them: exact
cosines, no index. The ``neighbours`` most similar ones vote with a power of
their similarity; all that tie with the last of them vote too. The less of a vector's
length lies in these directions, compared with labelled vectors, the nearer is its score to
the mean label, so a text in no known words is not sure of its score.

Labelled rows are those with a non-null label and doc_id outside the held-out
fold; if there are more than the bound, those with the smallest hash of doc_id.
A null text counts as empty; an empty text, whose vector is zero, gets the mean
label. Without labelled rows every score is 0.5. Rows that repeat a doc_id are
scored one by one; extra columns are ignored. Scores use the text alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_texts, held_out, slices

MOST_LABELS = 3000
DIMENSIONS = 64
NEIGHBOURS = 15
POWER = 8
THRESHOLD = 0.7
#: Documents of one matrix product.
BLOCK = 256
CLASSES = 16
#: Vector entries for trigrams of classes, trigrams of letters, and words.
SHAPES, LETTERS, WORDS = CLASSES**3, 2048, 2048
SIZE = SHAPES + LETTERS + WORDS
#: Share of shapes, letters and words in a vector's squared length, before weights.
SHARES = (1.0, 0.1, 0.05)
FACTOR = 0x9E3779B97F4A7C15


def _classes() -> np.ndarray:
    """A class for each byte; bytes of letters beyond ASCII count as small letters."""
    groups = {" ": 4, "\n": 5, ".": 6, ",;:": 7, "!?": 8, "|": 10, "#$%&*": 11, "\"'()[]{}": 12}
    table = np.full(256, 9, np.uint16)
    table[128:] = 1
    table[:32] = 13
    table[ord("a") : ord("z") + 1] = 1
    table[ord("A") : ord("Z") + 1] = 2
    table[ord("0") : ord("9") + 1] = 3
    for signs, group in groups.items():
        table[[ord(c) for c in signs]] = group
    return table


TABLE = _classes()


#: Each byte in lower case; all that is no letter is a space.
LOW = np.array([c if c >= 128 or chr(c).isalpha() else 32 for c in bytes(range(256)).lower()], np.uint64)


def _bins(hashes: np.ndarray, n: int) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(FACTOR)
    return np.bincount((mixed >> np.uint64(40)).astype(np.int64) % n, minlength=n)


def counts(text: bytes) -> list[np.ndarray]:
    """How often each trigram of classes (with class 0 at both ends), of letters, and each word occurs."""
    raw = np.frombuffer(text, np.uint8)
    kinds = np.zeros(len(raw) + 2, np.uint16)
    kinds[1:-1] = TABLE[raw]
    shapes = np.bincount(kinds[:-2] << 8 | kinds[1:-1] << 4 | kinds[2:], minlength=SHAPES)
    low = np.full(len(raw) + 2, 32, np.uint64)
    low[1:-1] = LOW[raw]
    inside = low != 32
    middle = np.flatnonzero(inside)
    letters = _bins((low[middle - 1] << np.uint64(16) | low[middle] << np.uint64(8) | low[middle + 1]) * np.uint64(FACTOR), LETTERS)
    first = np.flatnonzero(~inside[middle - 1])
    if not len(first):
        return [shapes, letters, np.zeros(WORDS, np.int64)]
    lengths = np.diff(first, append=len(middle))
    powers = np.multiply.accumulate(np.full(int(lengths.max()), FACTOR, np.uint64))
    place = np.arange(len(middle)) - np.repeat(first, lengths)
    return [shapes, letters, _bins(np.add.reduceat(low[middle] * powers[place], first), WORDS)]


def features(texts: list[bytes]) -> np.ndarray:
    found = np.zeros((len(texts), SIZE), np.float32)
    for row, text in zip(found, texts, strict=True):
        if text:
            parts = counts(text)
            row[:] = np.concatenate([np.sqrt(part * (share / max(1, part.sum()))) for part, share in zip(parts, SHARES, strict=True)])
    return found


def latent(rows: np.ndarray, dimensions: int) -> np.ndarray:
    """Leading right singular vectors, by subspace iteration."""
    wide = min(dimensions + 16, *rows.shape)
    basis = rows @ np.random.default_rng(0).standard_normal((rows.shape[1], wide)).astype(np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr(rows @ (rows.T @ basis))
    return np.linalg.svd(basis.T @ rows, full_matrices=False)[2][:dimensions].T


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(1e-9, np.linalg.norm(rows, axis=1, keepdims=True))


def packed(row: np.ndarray) -> bytes:
    """The entries of a vector that are not zero: all their places, then all their values in half precision."""
    values = row.astype(np.float16)
    places = np.flatnonzero(values)
    return places.astype(np.uint16).tobytes() + values[places].tobytes()


def unpacked(rows: list[bytes]) -> np.ndarray:
    """The vectors that :func:`packed` made small."""
    found = np.zeros((len(rows), SIZE), np.float32)
    for row, raw in zip(found, rows, strict=True):
        n = len(raw) // 4
        row[np.frombuffer(raw, np.uint16, n)] = np.frombuffer(raw, np.float16, n, 2 * n)
    return found


class Votes:
    """The labelled vectors and what makes such vectors of texts."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, neighbours: int = NEIGHBOURS, dimensions: int = DIMENSIONS):
        """``rows`` are weighted in place, so that the driver holds them once."""
        seen = np.count_nonzero(rows, axis=0)
        self.weight = (np.log((1 + len(rows)) / (1 + seen)) + 1).astype(np.float32)
        rows *= self.weight
        self.directions = latent(rows, dimensions).astype(np.float32)
        self.labels = labels.astype(np.float32)
        self.vectors, known = self._inside(rows)
        self.known = float(known.mean())
        self.neighbours = min(neighbours, len(labels))

    def project(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unit vectors in the latent directions, and the share of the length of ``rows`` that lies in them."""
        return self._inside(rows * self.weight)

    def _inside(self, weighted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inside = weighted @ self.directions
        blocks = range(0, len(weighted), BLOCK)  # the squares of all rows at once would be another copy of them
        lengths = np.concatenate([np.linalg.norm(weighted[a : a + BLOCK], axis=1) for a in blocks])
        return _unit(inside), np.linalg.norm(inside, axis=1) / np.maximum(1e-9, lengths)

    def votes(self, vectors: np.ndarray) -> np.ndarray:
        near = vectors @ self.vectors.T
        last = -np.partition(-near, self.neighbours - 1, axis=1)[:, self.neighbours - 1 : self.neighbours]
        votes = np.where(near >= last - 1e-6, np.maximum(near, 0).astype(np.float64) ** POWER + 1e-12, 0)
        return np.clip(votes @ self.labels / votes.sum(1), 0, 1)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """What the neighbours of each text vote."""
        return self.votes(self.project(features(texts))[0])

    def judge(self, texts: list[bytes]) -> np.ndarray:
        """The votes, drawn to the mean label by what the labelled texts do not know of a text."""
        vectors, known = self.project(features(texts))
        sure = np.minimum(1, known / max(1e-9, self.known)).astype(np.float64) ** 2
        return np.clip(sure * self.votes(vectors) + (1 - sure) * float(self.labels.mean()), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, most_labels: int = MOST_LABELS) -> Votes | None:
    """Learn from documents with a label outside the held-out fold; None if there are none."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .where(~held_out())
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(most_labels)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")

    def run(batches):
        for batch in batches:
            texts = byte_texts(batch["text"])
            for a, b in slices(texts):
                found = [packed(x) for c in range(a, b, BLOCK) for x in features(texts[c : min(b, c + BLOCK)])]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][a:b], batch["quality"][a:b], pa.array(found, pa.binary())], ["doc_id", "quality", "found"]
                )

    # Repeated documents of a label are bounded once more, so the driver holds most_labels vectors at most.
    found = rows.mapInArrow(run, "doc_id long, quality int, found binary").orderBy("doc_id", "quality", "found").limit(most_labels)
    got = found.toArrow().to_pydict()
    if not got["doc_id"]:
        return None
    return Votes(unpacked(got["found"]), np.array(got["quality"]))


def score(docs: DataFrame, votes: Votes | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``threshold`` on) of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    model = docs.sparkSession.sparkContext.broadcast(votes)

    def run(batches):
        for batch in batches:
            texts = byte_texts(batch["text"])
            scores = np.full(len(texts), 0.5)
            for a, b in slices(texts):
                for c in range(a, b, BLOCK) if model.value else ():
                    scores[c : min(b, c + BLOCK)] = model.value.judge(texts[c : min(b, c + BLOCK)])
            arrays = [batch["doc_id"], batch["held_out"], pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def good(docs: DataFrame, votes: Votes | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with a score of ``threshold`` or more, with all their columns.

    Without labelled rows nothing is known against any document, and all stay.
    """
    if votes is None:
        return docs
    model = docs.sparkSession.sparkContext.broadcast(votes)
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = byte_texts(batch.column(place))
            keep = np.zeros(len(texts), bool)
            for a, b in slices(texts):
                for c in range(a, b, BLOCK):
                    keep[c : min(b, c + BLOCK)] = model.value.judge(texts[c : min(b, c + BLOCK)]) >= threshold
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
