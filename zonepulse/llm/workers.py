"""What Python workers, which later stages use again, keep between tasks."""

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa


def give_back() -> None:
    """Returns memory that was freed but is still held by allocators to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc's
    if trim:
        trim(0)


_KEPT: dict[str, Callable[[], None]] = {}


def keeps(owner: str, forget: Callable[[], None]) -> None:
    """This worker holds something for the next tasks of ``owner``; a tidied task of any other has it forgotten."""
    _KEPT[owner] = forget


def forget_others(owner: str | None) -> None:
    for other in [o for o in _KEPT if o != owner]:
        _KEPT.pop(other)()


def tidied(run: Callable[[Iterable], Iterator], at_end: Callable[[], None] = give_back, owner: str | None = None):
    """``run``, for ``mapInArrow``; a task's end gives freed memory back, so a long job's workers don't add up their peaks. What they
    keep for tasks of another ``owner`` goes at the begin."""
    def tidy(batches):
        if _KEPT.keys() - {owner}:
            forget_others(owner)
            at_end()
        try:
            yield from run(batches)
        finally:
            at_end()

    return tidy
