"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def text_or_empty(column: str = "text") -> Column:
    """The text, with null read as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def packed(docs: DataFrame, **more: Column) -> DataFrame:
    """All columns of ``docs`` as the struct ``row``, beside the named columns.

    Whatever names the documents' own columns have, they cannot clash; ``select("row.*")`` undoes it.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       *[c.alias(n) for n, c in more.items()])


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: cuts the lineage durably.

    A lost executor re-reads the files; nothing upstream is computed again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Set session settings for the jobs run inside the block and restore them afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def width(spark: SparkSession) -> int:
    """Number of partitions for an explicit repartition: the session's shuffle width."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces whose ``column`` holds about ``most_bytes`` (at least one row each)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = max(1, batch.column(column).nbytes)
        step = max(1, int(n * most_bytes / size)) if size > most_bytes else n
        for at in range(0, n, step):
            yield batch.slice(at, step)


def give_back() -> None:
    """Return freed memory to the system at the end of a task: workers live on, beside those of
    later stages."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def _libc():
    try:
        libc = ctypes.CDLL(None)
        libc.malloc_trim  # noqa: B018  (not every C library has it)
        return libc
    except (OSError, AttributeError):
        return None


_LIBC = _libc()


class Remembered:
    """Results by key for repeated work, in bounded memory.

    Two generations of about ``most`` keys are held; a key that was not asked for while a generation
    filled up is forgotten and simply worked out again.
    """

    def __init__(self, most: int):
        self.now: dict = {}
        self.before: dict = {}
        self.most = most

    def get(self, key):
        got = self.now.get(key)
        if got is None and (got := self.before.get(key)) is not None:
            self.now[key] = got
        return got

    def age(self) -> None:
        """Begin a new generation if the present one is full."""
        if len(self.now) > self.most:
            self.now, self.before = {}, self.now

    def forget(self) -> None:
        """Keep only the keys asked for in both generations."""
        self.now, self.before = {k: v for k, v in self.now.items() if k in self.before}, {}
