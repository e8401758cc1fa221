"""What operators keep in a Python worker between tasks.

Spark reuses Python workers for any task. An operator may keep a table for its own next task; before
another operator's task starts in the same worker, it is released.
"""

from __future__ import annotations

import gc
from collections.abc import Callable

import pyarrow as pa

_owner: str | None = None
_release: list[Callable[[], None]] = []


def claim(owner: str) -> None:
    """Say whose task starts; what other operators kept is released."""
    global _owner
    if owner != _owner:
        kept = bool(_release)
        while _release:
            _release.pop()()
        if kept:
            gc.collect()  # tables and their codecs refer to each other
        pa.default_memory_pool().release_unused()
        _owner = owner


def keep(release: Callable[[], None]) -> None:
    """Register how to release what the present owner keeps."""
    _release.append(release)
