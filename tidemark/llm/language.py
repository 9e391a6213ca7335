"""Language of documents by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers, one from each end, read windows of ``LENGTH`` bytes
and label every position; a document's score for a language is the mean of its
probability over the positions of letters, over the whole text. The network is
trained here, in numpy, by backpropagation through time, from windows of a
bounded sample of documents (``most_documents``) outside the held-out fold: of each
language those with the smallest hash of doc_id, in turns, so that a rare language
has as many as a common one, if there are. Its gates use x / (1 + |x|), which is cheap and has a plain derivative.

A text that is null, empty or without a letter is ``und`` with score 0. Without
a labelled document every text is ``und``. Of languages that tie the first in
alphabetical order is predicted. An empty table gives no rows; long texts are read
whole, a block of windows at a time. Rows that repeat a doc_id are handled
one by one; null doc_ids are passed on; extra columns are ignored. Prediction
sees the text alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import byte_texts, held_out, slices

LENGTH = 64
HIDDEN = 6
MOST_DOCUMENTS = 2000
WINDOWS_EACH = 3
STEPS = 160
BATCH = 256
RATE = 0.03
#: Windows that prediction reads together.
ROWS = 2048
UNDETERMINED = "und"

_is_letter = np.zeros(256, bool)
_is_letter[128:] = True
_is_letter[ord("A") : ord("Z") + 1] = True
_is_letter[ord("a") : ord("z") + 1] = True


def windows(text: bytes, length: int = LENGTH) -> np.ndarray:
    """The whole text as rows of bytes, the last one filled up with zeros."""
    rows = -(-len(text) // length)
    out = np.zeros(rows * length, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(rows, length)


class Layer:
    """One direction: update, reset and candidate parts side by side."""

    def __init__(self, random: np.random.Generator, hidden: int):
        self.hidden = hidden
        self.weights = {
            "x": random.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32),
            "h": random.normal(0, 0.3, (hidden, 3 * hidden)).astype(np.float32),
        }

    def step(self, byte: np.ndarray, h: np.ndarray):
        """The next state and what the backward step needs."""
        n = self.hidden
        x = self.weights["x"][byte]
        u = h @ self.weights["h"]
        gate = x[:, : 2 * n] + u[:, : 2 * n]
        gate_size = 1 + np.abs(gate)
        gate /= gate_size
        gate *= 0.5
        gate += 0.5
        z, r = gate[:, :n], gate[:, n:]
        c = u[:, 2 * n :] * r
        c += x[:, 2 * n :]
        c_size = 1 + np.abs(c)
        c /= c_size
        new = c - h
        new *= z
        new += h
        return new, (byte, h, u, z, r, c, gate_size, c_size)

    def back(self, kept, d: np.ndarray, sums: dict[str, np.ndarray]) -> np.ndarray:
        """The gradient with respect to the state before; adds those of the weights to ``sums``."""
        byte, h, u, z, r, c, gate_size, c_size = kept
        n = self.hidden
        d_c = d * z / c_size**2
        d_gate = np.concatenate([d * (c - h), d_c * u[:, 2 * n :]], 1) * 0.5 / gate_size**2
        d_x = np.concatenate([d_gate, d_c], 1)
        d_u = np.concatenate([d_gate, d_c * r], 1)
        np.add.at(sums["x"], byte, d_x)
        sums["h"] += h.T @ d_u
        return d * (1 - z) + d_u @ self.weights["h"].T


class Network:
    def __init__(self, names: list[str], hidden: int = HIDDEN, seed: int = 0):
        random = np.random.default_rng(seed)
        self.names = names
        self.layers = [Layer(random, hidden), Layer(random, hidden)]
        self.out = random.normal(0, 0.1, (2 * hidden, len(names))).astype(np.float32)
        self.bias = np.zeros(len(names), np.float32)

    def _states(self, rows: np.ndarray, keep: bool = False):
        """Both layers' states at every position: (position, row, 2 x hidden)."""
        count, length = rows.shape
        columns = np.ascontiguousarray(rows.T)
        n = self.layers[0].hidden
        states = np.zeros((length, count, 2 * n), np.float32)
        kept: list[list] = [[], []]
        for side, layer in enumerate(self.layers):
            h = np.zeros((count, n), np.float32)
            for t in range(length) if side == 0 else range(length - 1, -1, -1):
                h, needed = layer.step(columns[t], h)
                states[t, :, side * n : side * n + n] = h
                if keep:
                    kept[side].append(needed)
        return states, kept

    def position_probabilities(self, rows: np.ndarray) -> np.ndarray:
        """(position, row, language)."""
        states, _ = self._states(rows)
        scores = states.reshape(-1, states.shape[2]) @ self.out + self.bias
        scores -= scores.max(1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(1, keepdims=True)
        return scores.reshape(*states.shape[:2], -1)

    def gradients(self, rows: np.ndarray, labels: np.ndarray, weight: np.ndarray):
        """Mean cross entropy over weighted positions and its gradient for every array."""
        states, kept = self._states(rows, keep=True)
        length, count, width = states.shape
        scores = states @ self.out + self.bias
        scores = np.exp(scores - scores.max(2, keepdims=True))
        scores /= scores.sum(2, keepdims=True)
        place = weight.T / max(1.0, float(weight.sum()))
        true = np.take_along_axis(scores, labels[None, :, None].repeat(length, 0), 2)[:, :, 0]
        loss = float(-(np.log(true + 1e-9) * place).sum())
        d = scores
        d[:, np.arange(count), labels] -= 1
        d *= place[:, :, None]
        flat_d = d.reshape(-1, d.shape[2])
        found = [states.reshape(-1, width).T @ flat_d, flat_d.sum(0)]
        d_states = d @ self.out.T
        n = width // 2
        for side, layer in enumerate(self.layers):
            sums = {k: np.zeros_like(v) for k, v in layer.weights.items()}
            carried = np.zeros((count, n), np.float32)
            order = range(length - 1, -1, -1) if side == 0 else range(length)
            for needed, t in zip(reversed(kept[side]), order, strict=True):
                carried = layer.back(needed, carried + d_states[t, :, side * n : side * n + n], sums)
            found += [sums["x"], sums["h"]]
        return loss, found

    def arrays(self) -> list[np.ndarray]:
        return [self.out, self.bias, *(w for layer in self.layers for w in (layer.weights["x"], layer.weights["h"]))]

    def train(self, rows: np.ndarray, labels: np.ndarray, steps: int = STEPS, seed: int = 0) -> float:
        """Adam over random batches; the last batches' mean loss."""
        random = np.random.default_rng(seed)
        arrays = self.arrays()
        first, second = [np.zeros_like(a) for a in arrays], [np.zeros_like(a) for a in arrays]
        losses = []
        for step in range(1, steps + 1):
            pick = random.integers(0, len(rows), min(BATCH, len(rows)))
            loss, found = self.gradients(rows[pick], labels[pick], _is_letter[rows[pick]].astype(np.float32))
            losses.append(loss)
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            for array, m, v, g in zip(arrays, first, second, found, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                array -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return float(np.mean(losses[-10:]))

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean probability of each language over each text's letters; zeros without letters."""
        rows = [windows(t) for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(r) for r in rows])
        table = np.concatenate([np.zeros((0, LENGTH), np.uint8), *rows])
        total, letters = np.zeros((len(texts), len(self.names))), np.zeros(len(texts))
        for a in range(0, len(table), ROWS):
            here = table[a : a + ROWS]
            weight = _is_letter[here]
            each = (self.position_probabilities(here) * weight.T[:, :, None]).sum(0)
            np.add.at(total, owner[a : a + ROWS], each)
            np.add.at(letters, owner[a : a + ROWS], weight.sum(1))
        return total / np.maximum(letters, 1)[:, None]


def fit(docs: DataFrame, most_documents: int = MOST_DOCUMENTS) -> Network | None:
    """Train on documents with a lang outside the held-out fold; None if there are none."""
    chosen = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
        .where("lang IS NOT NULL AND length(text) > 0 AND doc_id IS NOT NULL")
        .where(~held_out())
    )
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = chosen.withColumn("turn", turn).where(F.col("turn") <= most_documents)

    def cut(batches):
        """A few windows of each text, at places that follow from its doc_id."""
        for batch in batches:
            rows = []
            for doc_id, raw in zip(batch["doc_id"].to_pylist(), byte_texts(batch["text"]), strict=True):
                places = np.random.default_rng(doc_id & 0xFFFFFFFF).integers(0, max(1, len(raw) - LENGTH + 1), WINDOWS_EACH)
                rows.append(b"".join(raw[p : p + LENGTH].ljust(LENGTH, b"\0") for p in places))
            arrays = [batch["doc_id"], batch["lang"], batch["turn"], pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang", "turn", "windows"])

    sample = chosen.mapInArrow(cut, "doc_id long, lang string, turn int, windows binary")
    got = sample.orderBy("turn", F.xxhash64("doc_id"), "doc_id", "lang", "windows").limit(most_documents).toArrow().to_pydict()
    if not got["lang"]:
        return None
    names = sorted(set(got["lang"]))
    network = Network(names)
    rows = np.frombuffer(b"".join(got["windows"]), np.uint8).reshape(-1, LENGTH)
    network.train(rows, np.repeat([names.index(x) for x in got["lang"]], WINDOWS_EACH))
    return network


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        for batch in batches:
            raw = byte_texts(batch["text"])
            names, scores = [UNDETERMINED] * len(raw), np.zeros(len(raw))
            spoken = [i for i, t in enumerate(batch["text"].to_pylist()) if t and any(c.isalpha() for c in t)] if model.value else []
            for a, b in slices([raw[i] for i in spoken], 1 << 20):
                found = model.value.documents([raw[i] for i in spoken[a:b]])
                for i, row in zip(spoken[a:b], found, strict=True):
                    names[i], scores[i] = model.value.names[int(row.argmax())], min(1.0, float(row.max()))
            arrays = [batch["doc_id"], batch["held_out"], pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
