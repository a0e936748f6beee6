"""Small helpers that the operators of this subpackage share.

Operators take a table and the names of the columns they use; every other
column is ignored, so clashing names in the input do no harm.  Data that a
job reads several times is written once as Parquet below the session's
``spark.checkpoint.dir`` (shared storage on a cluster), which also cuts the
lineage: a lost executor re-reads the files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: The word of all contracts: a run of characters other than blank and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

#: Scratch tables by session and path, with the pipeline stage that wrote each.
_WRITTEN: list[tuple[SparkSession, str, int]] = []
_STAGE = [0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; ``release`` deletes it."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path, _STAGE[0]))
    return path


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Delete every scratch table of this session; call it once results are written."""
    for item in [x for x in _WRITTEN if x[0] is spark]:
        delete(spark, item[1])
        _WRITTEN.remove(item)


def begin_stage(spark: SparkSession, number: int, docs: DataFrame) -> None:
    """Delete the scratch tables of the stages before ``number``, but for those that hold ``docs``.

    A stage's result is written before the next one begins, so what it worked
    with is not needed any more.
    """
    old = [x for x in _WRITTEN if x[0] is spark and 0 < x[2] < number]
    held = docs.inputFiles() if old else []
    for item in old:
        if not any(item[1].rsplit("/", 1)[1] in f for f in held):
            delete(spark, item[1])
            _WRITTEN.remove(item)
    _STAGE[0] = number


def stored(spark: SparkSession, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it from there."""
    path = scratch_dir(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder, for small tables read several times."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times in ``body``.

    A lambda variable is evaluated once per row, whatever the optimizer does
    to the projections around it.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Words of a text as an array; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def total_chars(df: DataFrame, text: str) -> int:
    """Bytes of all texts (at least 1), for the choice of a number of blocks."""
    row = df.agg(F.sum(F.octet_length(F.col(text))).alias("n")).first()
    return max(1, int(row["n"] or 0))


def text_slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text, one row at least.

    Parts are copies: Arrow's string kernels misread arrays that begin inside
    their buffers.
    """
    size = pc.binary_length(batch["text"]).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + 64
    part = (np.cumsum(size) - size) // most
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if a < b:
            yield batch.take(pa.array(np.arange(a, b)))
