"""What a Python worker keeps from task to task.

The package's functions travel to workers by value, with copies of the module values they refer to.
What is to stay with a worker, and not to travel, hangs on a module of its own in each process.
"""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable
from typing import Any

import pyarrow as pa

_NAME = "_dropsieve_worker"


def kept() -> dict:
    """The process's own dictionary."""
    return vars(sys.modules.setdefault(_NAME, types.ModuleType(_NAME)))


def codec(key: tuple[str, str], make: Callable[[], Any]) -> Any:
    """What ``make`` builds from a vocabulary, kept for the tasks that follow; one at a time, for each takes 100 MB."""
    have = kept().get("codec")
    if have is None or have[0] != key:
        drop_codec()
        have = kept()["codec"] = key, make()
    return have[1]


def drop_codec() -> None:
    kept().pop("codec", None)


def give_back() -> None:
    """Hands memory that is free to the system: a worker would keep the most that any task before took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)
