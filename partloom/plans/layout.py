"""How the rows of a write are spread over tasks, hence over files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from partloom.sources.catalog import quote


# Column that a row is dealt by, gone after the shuffle.
_ROW_HASH = "__row_hash__"


def rebalance(df: DataFrame, columns: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """Bring rows of equal ``columns`` together, in tasks of even size.

    Spark splits a key that holds too many bytes over several tasks and merges
    small ones, both at run time, so neither a hot key nor many thin keys hurt.
    Without adaptive execution the hint does nothing and only more files result.
    Without ``columns`` rows go by a hash of themselves: dealt in turn, Spark would sort them first so
    that a task that is run again deals them as before.
    """
    by, dealt = [F.col(quote(c)) for c in columns], df
    if not by and (hashed := _row_hash(df)):
        by, dealt = [F.col(quote(_ROW_HASH))], df.withColumn(_ROW_HASH, hashed[0])
    return dealt.hint("rebalance", *([parts] if parts else []), *by).drop(_ROW_HASH)


def _row_hash(df: DataFrame) -> list[Column]:
    hashable = [F.col(quote(f.name)) for f in df.schema.fields if not _unhashable(f.dataType)]
    return [F.xxhash64(*hashable)] if hashable else []


def _unhashable(kind: DataType) -> bool:
    return any(word in kind.simpleString() for word in ("map<", "variant"))


def for_table(df: DataFrame, partitioned_by: Sequence[str], bucketed_by: Sequence[str], buckets: int | None) -> DataFrame:
    """Rows of one partition, or else of one bucket, in as few files as their size asks for."""
    if partitioned_by:
        return rebalance(df, partitioned_by)
    if bucketed_by:
        # As many shuffle partitions as buckets: the two hashes agree, so each task
        # that is not merged with another writes a single bucket.
        return rebalance(df, bucketed_by, buckets)
    return df


def union(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows by column name. Halves are put together, so the plan is as deep as the logarithm of their number."""
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    return union(frames[:middle]).unionByName(union(frames[middle:]))
