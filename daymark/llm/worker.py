"""What a Python worker keeps between the tasks it is reused for.

Spark reuses workers over tasks and stages.  A worker keeps one object, for the
stage that made it: tasks of one stage share an encoder and its cache, the
first task of another stage frees it.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark import TaskContext

_KEPT: dict[tuple, Any] = {}


def _stage() -> int:
    task = TaskContext.get()
    return -1 if task is None else task.stageId()


def free_other_stages() -> None:
    """Drop what an earlier stage left, and give its memory back to the system."""
    stage = _stage()
    old = [k for k in _KEPT if k[0] != stage]
    for k in old:
        del _KEPT[k]
    if old:
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # not glibc
            pass


def kept_for_stage(key: tuple, make: Callable[[], Any]) -> Any:
    """The stage's object of that key; ``key`` must tell apart all that ``make`` depends on."""
    free_other_stages()
    full = (_stage(), *key)
    if full not in _KEPT:
        _KEPT.clear()
        _KEPT[full] = make()
    return _KEPT[full]


__all__ = ["free_other_stages", "kept_for_stage"]
