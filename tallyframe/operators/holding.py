"""Cached tables that several threads share: held once, freed by the last one that uses them.

Spark keeps one cached copy per plan, so of two users of equal plans the first to unpersist would drop it under the
other. Here users of one plan are counted.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@dataclass
class _Held:
    frame: DataFrame
    users: int


_lock = threading.Lock()
_tables: dict[tuple[int, int], list[_Held]] = {}


def _is_held(df: DataFrame) -> bool:
    level = df.storageLevel
    return level.useMemory or level.useDisk


@contextmanager
def held(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK_DESER) -> Iterator[DataFrame]:
    """``df`` in memory or on disk while used; a table that its caller holds already stays as it is."""
    key = id(df.sparkSession), df.semanticHash()
    with _lock:
        known = _tables.setdefault(key, [])
        entry = next((h for h in known if h.frame.sameSemantics(df)), None)
        if entry is None and not _is_held(df):
            entry = _Held(df.persist(level), 0)
            known.append(entry)
        if entry is not None:
            entry.users += 1
    try:
        yield df
    finally:
        with _lock:
            if entry is not None:
                entry.users -= 1
                if not entry.users:
                    known.remove(entry)
                    entry.frame.unpersist()
            if not known:
                _tables.pop(key, None)
