"""Tables that several readers of a job share.

A table is loaded once per (session, path, format, schema, columns).  The first
reader gets the plain scan; when a second one comes while the first is open, the
scan is persisted, and both read the persisted rows from then on, since they
hold the same frame.  The last reader to close releases it.  Readers that open
before any of them runs a job therefore read the files once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .files import load_table


@dataclass
class _Entry:
    frame: DataFrame
    readers: int = 0
    persisted: bool = False


_TABLES: dict[tuple, _Entry] = {}


def _key(spark: SparkSession, path: str, fmt: str, schema, columns) -> tuple:
    text = json.dumps(schema.jsonValue(), sort_keys=True) if isinstance(schema, StructType) else schema
    return (id(spark._jsparkSession), path, fmt, text, tuple(columns or ()))


@contextmanager
def shared_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None,
                 columns: Sequence[str] | None = None) -> Iterator[DataFrame]:
    """A reader of the table at ``path`` (only ``columns``, if given) for the length of a ``with`` block."""
    key = _key(spark, path, fmt, schema, columns)
    entry = _TABLES.get(key)
    if entry is None:
        frame = load_table(spark, path, fmt, schema)
        entry = _TABLES[key] = _Entry(frame.select(*columns) if columns else frame)
    entry.readers += 1
    if entry.readers > 1 and not entry.persisted:
        entry.frame.persist(StorageLevel.MEMORY_AND_DISK)
        entry.persisted = True
    try:
        yield entry.frame
    finally:
        entry.readers -= 1
        if not entry.readers:
            del _TABLES[key]
            if entry.persisted:
                entry.frame.unpersist(blocking=True)


def open_tables() -> int:
    """Tables that have a reader now."""
    return len(_TABLES)
