"""Sinks: Parquet between stages, delimited text for small result tables; a failing write leaves the old table."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


@contextmanager
def committed(spark: SparkSession, path: str) -> Iterator[str]:
    """A path beside ``path`` to write to; what is there becomes ``path`` only once the block has ended without an error.

    The old table stays whole until then, so it may also be what the new one is computed from. The change is two renames
    within one folder, after which the old files go; if the second fails, the first is undone.
    """
    path = path.rstrip("/")
    mark = uuid.uuid4().hex
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    final, fresh, old = hadoop(path), hadoop(f"{path}.new-{mark}"), hadoop(f"{path}.old-{mark}")
    files = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        yield fresh.toString()
        _renamed(files.rename, fresh, final, old if files.exists(final) else None)
        files.delete(old, True)
    finally:
        files.delete(fresh, True)


def _renamed(rename: Callable, fresh, final, old) -> None:
    if old is not None and not rename(final, old):
        raise OSError(f"{final} cannot be renamed")
    try:
        done = rename(fresh, final)
    except Exception:
        if old is not None:
            rename(old, final)
        raise
    if not done:
        if old is not None:
            rename(old, final)
        raise OSError(f"{fresh} cannot be renamed to {final}")


def write_stage(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), order_by: Sequence[str] = ()
) -> DataFrame:
    """Write a stage as Parquet, in key order where asked, and return it as read back: later stages start from the files.

    A table that ``path`` already holds is replaced once the new one is complete (:func:`committed`).
    """
    with committed(df.sparkSession, path) as target:
        writer = (df.orderBy(*order_by) if order_by else df).write
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)
    return df.sparkSession.read.parquet(path)


def write_table(df: DataFrame, path: str, order_by: Sequence[str] = ()) -> None:
    """Write a result table as delimited text with a header, sorted when asked, in place of one that is there."""
    with committed(df.sparkSession, path) as target:
        (df.orderBy(*order_by) if order_by else df).write.option("header", True).csv(target)
