"""SentencePiece encoding that keeps, for every piece, the bytes of the text it came from.

Normalisation replaces, at each place, the longest key of the model's compiled
character map (a double-array trie) and records the source bytes of every byte
it writes. The library segments; each document's pieces must spell exactly the
normalised text, so their lengths project every piece through that record onto a
span of the original UTF-8 text. A document that does not spell it ends the job.

Nulls count as the empty text, which has the end id alone. Rows that repeat a
doc_id are encoded one by one, a null doc_id is passed on, extra columns are
ignored. A document is encoded by one task, however long; others share tasks by
bytes. Where the model cannot join pieces across a space, the library encodes
each different space-separated chunk once while the task's memo holds it.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_format

from tidemark.llm.common import slices
from tidemark.llm.memo import Memo, flat

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁".encode()
#: Kinds of pieces in the model file (fixed values of its format).
UNKNOWN, CONTROL, USER_DEFINED, BYTE = 2, 3, 4, 6
SLICE = 1 << 20
#: Chunks that a task keeps the ids of: some 45 MB.
MOST_CHUNKS = 250_000
#: Texts with runs of spaces, or spaces at an end, are encoded whole.
ODD = re.compile("^ |  | $|▁")


def character_map(compiled: bytes) -> dict[bytes, bytes]:
    """All keys of a compiled map and what replaces them.

    A four-byte trie size, the trie's 32-bit units, then replacements that end
    with a zero byte. A unit holds its label, the place of its children, and
    whether the first child is a leaf with the place of the replacement.
    """
    if not compiled:
        return {}
    size = int.from_bytes(compiled[:4], "little")
    units = np.frombuffer(compiled[4 : 4 + size], "<u4").astype(np.int64)
    texts = compiled[4 + size :]
    labels = np.arange(1, 256)

    def children(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    found, stack = {}, [(0, b"")]
    while stack:
        place, key = stack.pop()
        first = place ^ children(int(units[place]))
        if key and units[place] >> 8 & 1:
            start = int(units[first]) & 0x7FFFFFFF
            found[key] = texts[start : texts.index(b"\0", start)]
        places = first ^ labels
        inside = places < len(units)
        same = np.zeros(255, bool)
        same[inside] = (units[places[inside]] & 0x800000FF) == labels[inside]
        stack += [(int(p), key + bytes([c])) for p, c in zip(places[same], labels[same], strict=True)]
    return found


class Normaliser:
    """The text as the model sees it, and where each of its bytes came from."""

    def __init__(self, spec, symbols: list[bytes] = ()):
        self.spec = spec
        self.rules = character_map(spec.precompiled_charsmap) | {s: s for s in symbols}
        self.longest = max(map(len, self.rules), default=0)
        starts = sorted({k.decode(errors="ignore")[:1] for k in self.rules} - {""})
        extra = [" "] if spec.remove_extra_whitespaces else []
        self.starts = re.compile("[" + "".join(map(re.escape, [*starts, *extra])) + "]") if starts or extra else None

    def __call__(self, text: str) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Normalised bytes, and the first source byte and the end of the source of each."""
        raw = text.encode()
        if self.starts is None:
            body, begin = raw, np.arange(len(raw))
            end = begin + 1
        else:
            body, begin, end = self._replaced(text)
        if self.spec.remove_extra_whitespaces:
            body, begin, end = self._single_spaces(body, begin, end)
        if not body:
            return b"", np.zeros(0, np.int64), np.zeros(0, np.int64)
        if self.spec.add_dummy_prefix:
            body = b" " + body
            begin = np.concatenate([begin[:1], begin])
            end = np.concatenate([begin[:1], end])
        if self.spec.escape_whitespaces:
            times = np.where(np.frombuffer(body, np.uint8) == 32, len(SPACE), 1)
            body, begin, end = body.replace(b" ", SPACE), np.repeat(begin, times), np.repeat(end, times)
        return body, begin, end

    def _replaced(self, text: str):
        parts, begins, ends = [], [], []
        done = at = 0  # characters, bytes

        def copy(piece: str):
            nonlocal at
            raw = piece.encode()
            parts.append(raw)
            begins.append(np.arange(at, at + len(raw)))
            ends.append(begins[-1] + 1)
            at += len(raw)

        for match in self.starts.finditer(text):
            if match.start() < done:
                continue
            copy(text[done : match.start()])
            window = text[match.start() : match.start() + self.longest].encode()[: self.longest]
            key = next((window[:n] for n in range(len(window), 0, -1) if window[:n] in self.rules), None)
            if key is None:
                copy(match.group())
                done = match.end()
                continue
            new = self.rules[key]
            parts.append(new)
            begins.append(np.full(len(new), at))
            ends.append(np.full(len(new), at + len(key)))
            at += len(key)
            done = match.start() + len(key.decode())
        copy(text[done:])
        return b"".join(parts), np.concatenate(begins), np.concatenate(ends)

    @staticmethod
    def _single_spaces(body: bytes, begin: np.ndarray, end: np.ndarray):
        """Without spaces at both ends and after another space."""
        space = np.frombuffer(body, np.uint8) == 32
        keep = ~space
        keep[1:] |= space[1:] & ~space[:-1]
        words = np.flatnonzero(~space)
        if not len(words):
            return b"", begin[:0], end[:0]
        keep[: words[0]] = False
        keep[words[-1] + 1 :] = False
        return np.frombuffer(body, np.uint8)[keep].tobytes(), begin[keep], end[keep]


class Encoder:
    def __init__(self, path: str):
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as file:
            model = model_format.ModelProto.FromString(file.read())
        self.surface, symbols, self.unknown = [], [], -1
        for i, piece in enumerate(model.pieces):
            text = piece.piece.encode()
            if piece.type == BYTE:
                text = bytes([int(piece.piece[1:-1], 16)])
            elif piece.type in (CONTROL, UNKNOWN):
                text = b""
            if piece.type == USER_DEFINED:
                symbols.append(text)
            if piece.type == UNKNOWN:
                self.unknown = i
            self.surface.append(text)
        self.lengths = np.array([len(s) for s in self.surface])
        self.names = [str(i) for i in range(len(self.surface))]
        self.normalise = Normaliser(model.normalizer_spec, symbols)
        self.separable = self._separable(model.normalizer_spec)
        self.memo = Memo(self._learn, np.int32, "pieces", MOST_CHUNKS)

    def _separable(self, spec) -> bool:
        """Whether chunks between single spaces are encoded independently of each other."""
        plain = self.normalise.starts is None and spec.add_dummy_prefix and spec.escape_whitespaces
        return plain and not any(re.search(rb"[^\xe2\x96\x81]\xe2\x96\x81", s) for s in self.surface)

    def _learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.pieces.encode(chunks, num_threads=1)
        for chunk, ids in zip(chunks, found, strict=True):
            spelled = b"".join(map(self.surface.__getitem__, ids))
            if chunk and self.unknown not in ids and spelled != SPACE + chunk.encode():
                raise ValueError("the pieces do not spell the normalised text")
        return flat(found, np.int32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text, with the end id."""
        whole = [i for i, t in enumerate(texts) if not self.separable or ODD.search(t)]
        out = dict(zip(whole, self.pieces.encode([texts[i] for i in whole], num_threads=1), strict=True)) if whole else {}
        chunks = [[] if i in out else t.split(" ") for i, t in enumerate(texts)]
        if self.memo.full():
            self.memo.clear()
        self.memo.add(chunks)
        end = [self.pieces.eos_id()]
        return [
            np.append(out[i] if i in out else self.memo.of(self.memo.places(c)), end).astype(np.int32)
            for i, c in enumerate(chunks)
        ]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.pieces.decode([i.tolist() for i in ids], num_threads=1)

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First source byte and end of the source of every piece; the end id's span is empty."""
        body, begin, end = self.normalise(text)
        lengths = self.lengths[ids]
        if (ids == self.unknown).any():  # an unknown piece spells itself
            strings = [*self.pieces.encode(text, out_type=str), ""]
            lengths = np.where(ids == self.unknown, [len(p.encode()) for p in strings], lengths)
        elif not self.separable and b"".join(map(self.surface.__getitem__, ids.tolist())) != body:
            raise ValueError("the pieces do not spell the normalised text")
        if lengths.sum() != len(body):
            raise ValueError("the pieces do not spell the normalised text")
        size = len(text.encode())
        after = np.cumsum(lengths)
        first = np.append(begin, size)[after - lengths]
        last = np.where(lengths > 0, np.append(end, size)[np.maximum(after - 1, 0)], first)
        return first, last


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _encoded(batches, path: str):
    """Slices of (doc ids, texts, ids) of about a megabyte; only their texts are Python strings at a time."""
    code = encoder(path)
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_pylist()
        doc_ids = batch["doc_id"].cast(pa.int64())
        for a, b in slices(list(map(range, sizes)), SLICE):
            texts = [t or "" for t in batch["text"][a:b].to_pylist()]
            yield code, doc_ids[a:b], texts, code.encode(texts)
        # A worker goes on to other tasks; what the batch took is given back.
        pa.default_memory_pool().release_unused()


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, ids, and for each id the span of the text: begins, ends (in UTF-8 bytes)."""

    def run(batches):
        for code, doc_ids, texts, ids in _encoded(batches, model):
            spans = [code.spans(t, i) for t, i in zip(texts, ids, strict=True)]
            arrays = [doc_ids, *(pa.array(x, pa.list_(pa.int32())) for x in (ids, [s for s, _ in spans], [e for _, e in spans]))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "begins", "ends"])

    return _columns(docs).mapInArrow(run, "doc_id long, ids array<int>, begins array<int>, ends array<int>")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and the text that the library makes of the ids; null ids are an empty text."""

    def run(batches):
        for batch in batches:
            texts = encoder(model).decode([np.array(i or [], np.int32) for i in batch["ids"].to_pylist()])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def encode_digests(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, covered_bytes.

    What ``encode`` and ``decode`` give, digested in the task that made it, so
    that ids do not travel: digests are of the decimal ids with single spaces
    and of the decoded text; covered_bytes is the length of the spans' union.
    """

    def run(batches):
        for code, doc_ids, texts, ids in _encoded(batches, model):
            decoded = code.decode(ids)
            names = [hashlib.sha256(" ".join(map(code.names.__getitem__, i.tolist())).encode()).hexdigest() for i in ids]
            covered = []
            for text, i in zip(texts, ids, strict=True):
                first, last = code.spans(text, i)
                reach = np.maximum.accumulate(last)
                before = np.concatenate([[0], reach[:-1]])
                covered.append(int(np.maximum(reach - np.maximum(first, before), 0).sum()))
            arrays = [
                doc_ids,
                pa.array(map(len, ids), pa.int64()),
                pa.array(names, pa.string()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string()),
                pa.array(covered, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "covered_bytes"])

    return _columns(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, covered_bytes long"
    )


def encode_and_check(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids, and whether decoding the ids gives the text back."""

    def run(batches):
        for code, doc_ids, texts, ids in _encoded(batches, model):
            for text, i in zip(texts, ids, strict=True):
                code.spans(text, i)  # ends the job if the pieces do not cover the text
            same = [a == b for a, b in zip(code.decode(ids), texts, strict=True)]
            arrays = [doc_ids, pa.array(map(len, ids), pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids", "round_trip"])

    return _columns(docs).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
