"""Ids of texts out of the ids of their words, each of which is worked out once per worker."""

from __future__ import annotations

import ctypes
import itertools
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

STEP = 4 << 20  # bytes of text worked on at once
KNOWN = 800_000  # words that are remembered (about 200 MB); beyond that it starts anew


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of Linux has it


def released() -> None:
    """Gives a worker's free memory back to the system: Arrow and the C library keep it, each for itself, and it counts as the executor's."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def spans(sizes: Sequence[int], most: int) -> list[slice]:
    """Slices whose sizes add up to ``most`` at most, or of one element."""
    out, at, total = [], 0, 0
    for i, size in enumerate(sizes):
        if i > at and total + size > most:
            out.append(slice(at, i))
            at, total = i, 0
        total += size
    if at < len(sizes):
        out.append(slice(at, len(sizes)))
    return out


def sliced(batches: Iterable[pa.RecordBatch], column: str, most: int = STEP) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of at most ``most`` bytes of a text column, or of one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        for part in spans(sizes.tolist(), most):
            yield batch.slice(part.start, part.stop - part.start)
    released()


class Kept:
    """What each worker makes once for the tasks of a stage; made for a broadcast, with which a worker drops it.

    A worker gives up a broadcast when it begins a task that doesn't use it, so the memory is free for the next stage in Python.
    """

    def __init__(self):
        self.made = None

    def __getstate__(self):
        """Nothing: workers make it by themselves."""
        return {"made": None}

    def get(self, make: Callable):
        if self.made is None:
            self.made = make()
        return self.made


class Pool:
    """Number sequences of different length in one array; ``gather`` puts together those of many codes at once."""

    def __init__(self, kind=np.uint32):
        self.begin, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.values = np.zeros(0, kind)

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        """More sequences, one after the other in ``flat``."""
        self.begin = np.concatenate([self.begin, len(self.values) + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.values = np.concatenate([self.values, flat]).astype(self.values.dtype, copy=False)

    def joined(self, codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sequences of all codes one after the other, and how far those of each run of ``counts`` codes go."""
        lengths = self.length[codes]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.values[np.repeat(self.begin[codes] - ends + lengths, lengths) + np.arange(total)]
        return flat, np.concatenate([[0], ends])[np.cumsum(counts)]

    def gather(self, codes: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
        """For each run of ``counts`` codes, their sequences one after the other."""
        flat, ends = self.joined(codes, counts)
        return np.split(flat, ends[:-1]) if len(counts) else []


class Lexicon:
    """Words seen so far, with one or more sequences of ids for each.

    ``learn`` takes new words and gives them back in an order of its own, with the ids and their number by word for each column.
    """

    def __init__(self, learn: Callable[[list], tuple[list, list[tuple[np.ndarray, np.ndarray]]]], columns: int = 1, most: int = KNOWN):
        self.learn, self.columns, self.most = learn, columns, most
        self.clear()

    def clear(self) -> None:
        self.code: dict = {}
        self.pools = [Pool() for _ in range(self.columns)]

    def codes(self, texts: list[list]) -> tuple[np.ndarray, np.ndarray]:
        """The code of every word, and the number of words of each list."""
        if len(self.code) > self.most:
            self.clear()
        new = list(set().union(*texts).difference(self.code))
        if new:
            new, columns = self.learn(new)
            self.code.update(zip(new, range(len(self.code), len(self.code) + len(new))))
            for pool, (flat, lengths) in zip(self.pools, columns):
                pool.add(flat, lengths)
        counts = np.fromiter(map(len, texts), np.int64, len(texts))
        found = map(self.code.__getitem__, itertools.chain.from_iterable(texts))
        return np.fromiter(found, np.int64, counts.sum()), counts
