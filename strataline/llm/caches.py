"""What a Python worker remembers between tasks.

A worker outlives a task and may serve another operator next. Each task says which memories it
uses; those of other operators are dropped when it starts, and free memory goes back to the
system when it ends, so that a worker never holds more than one operator's.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa

_forget: dict[str, Callable[[], int]] = {}


def remembers(name: str, forget: Callable[[], int]) -> None:
    """Announce a memory; `forget` empties it and says how many entries it had."""
    _forget[name] = forget


def forget_others(*used: str) -> None:
    """Drop what tasks that use these memories do not need."""
    if sum([forget() for name, forget in _forget.items() if name not in used]):
        give_back()


def give_back() -> None:
    """Hand free memory back to the system, as far as the platform can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # no glibc: the memory stays with the process, and is used again
        return


def in_worker(task: Callable[[Iterator], Iterator], *used: str) -> Callable[[Iterator], Iterator]:
    """A task for mapInArrow that keeps only the memories it names."""

    def run(batches: Iterator) -> Iterator:
        forget_others(*used)
        try:
            yield from task(batches)
        finally:
            give_back()

    return run
