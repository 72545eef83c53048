"""What a Python worker holds between rows, bounded in bytes and given back after each task."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
import pyarrow.compute

BUDGET_BYTES = 96 << 20    # of one worker, over all its caches
ENTRY_BYTES = 160          # a key, a value and their places, besides their own lengths

_caches: list[Held] = []


class Held(dict):
    """A cache that makes what it lacks; all caches of a worker share one budget."""

    def __init__(self):
        super().__init__()
        self.bytes = 0
        _caches.append(self)

    def make(self, key: str) -> bytes | int:
        raise NotImplementedError

    def __missing__(self, key: str) -> bytes | int:
        self[key] = value = self.make(key)
        self.bytes += ENTRY_BYTES + len(key) + (len(value) if isinstance(value, bytes) else 0)
        return value

    def drop(self) -> None:
        self.clear()
        self.bytes = 0


def bounded() -> None:
    """Empty all caches if together they are over the budget; call it between texts."""
    if sum(c.bytes for c in _caches) > BUDGET_BYTES:
        for c in _caches:
            c.drop()


def release() -> None:
    """Empty all caches and give the memory back to the system, so that later stages find it free."""
    for c in _caches:
        c.drop()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


# A worker keeps its caches between tasks of one kind; any task of another kind that is wrapped here ends with none.
def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function over a task's batches that releases what the task held."""
    @wraps(run)
    def until_done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return until_done


def pieces(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts in ``column`` have about ``most`` bytes, one longer text alone."""
    start, size = 0, 0
    for at, n in enumerate(pa.compute.binary_length(batch.column(column)).to_pylist()):
        if at > start and size + (n or 0) > most:
            yield batch.slice(start, at - start)
            start, size = at, 0
        size += n or 0
    if batch.num_rows > start or not batch.num_rows:
        yield batch.slice(start)
