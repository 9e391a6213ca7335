"""Ids of words that a task has met before.

Tokenizers that never join across a space encode a text as the ids of its
space-separated chunks, one after the other. Natural text repeats its chunks, so
each is encoded by the library once while the memo holds it. Its owner empties it
between texts once it is full; results do not depend on it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np

#: Bounds of one memo: its chunks, and characters for each of them on average.
MOST_CHUNKS = 250_000
MOST_CHARACTERS = 16

_owners: dict[str, list[Memo]] = {}


def flat(lists: list[Iterable[int]], dtype) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and all ids one after the other."""
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    return lengths, np.fromiter(chain.from_iterable(lists), dtype, int(lengths.sum()))


class _Index(dict):
    """Numbers of chunks; one that is not known yet gets the next number and is noted in ``new``."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self.new.append(chunk)
        number = self[chunk] = len(self)
        return number


class Memo:
    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], dtype, owner: str, most: int = MOST_CHUNKS):
        """``learn`` gives the ids of chunks that are not known yet, as ``flat`` does.

        A Python worker serves one operator's tasks after another's: it keeps the
        memos of one ``owner`` at a time.
        """
        self.learn, self.dtype, self.owner, self.most = learn, dtype, owner, most
        _owners.setdefault(owner, []).append(self)
        self.clear()

    def full(self) -> bool:
        return len(self.index) > self.most or self.characters > self.most * MOST_CHARACTERS

    def clear(self) -> None:
        if not getattr(self, "index", True):
            return
        self.index = _Index()
        self.ids = np.zeros(1 << 16, self.dtype)
        self.lengths = np.zeros(1 << 14, np.int64)
        self.starts = np.zeros(1 << 14, np.int64)
        self.used = self.characters = 0

    def _room(self, chunks: int, ids: int) -> None:
        while len(self.lengths) < chunks:
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        while len(self.ids) < self.used + ids:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])

    def add(self, texts: list[list[str]]) -> None:
        """Learn all chunks of the texts; after this ``of`` answers for them."""
        for chunk in set().union(*texts).difference(self.index):
            self.index[chunk]
        self._learn_new()

    def places(self, chunks: list[str]) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))

    def take(self, texts: list[list[str]]) -> list[np.ndarray]:
        """``add`` and the ``places`` of each text, with one look at every chunk."""
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        places = np.fromiter(map(self.index.__getitem__, chain.from_iterable(texts)), np.int64, int(ends[-1]) if texts else 0)
        self._learn_new()
        return np.split(places, ends[:-1]) if texts else []

    def _learn_new(self) -> None:
        for owner, memos in _owners.items():
            if owner != self.owner:
                for memo in memos:
                    memo.clear()
        new, self.index.new = self.index.new, []
        if not new:
            return
        try:
            lengths, ids = self.learn(new)
        except BaseException:
            self.clear()  # the worker may go on with another task, for which these are not known
            raise
        n = len(self.index) - len(new)
        self._room(len(self.index), len(ids))
        self.lengths[n : n + len(new)] = lengths
        self.starts[n : n + len(new)] = self.used + np.cumsum(lengths) - lengths
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.characters += sum(map(len, new))

    def of(self, places: np.ndarray) -> np.ndarray:
        """The ids of the chunks at ``places``, one after the other."""
        lengths = self.lengths[places]
        after = np.cumsum(lengths)
        total = int(after[-1]) if len(after) else 0
        return self.ids[np.repeat(self.starts[places] - after + lengths, lengths) + np.arange(total)]
