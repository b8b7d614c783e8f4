"""What several operators share: written tables, key digests, components of a graph."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partloom.errors import ConfigError
from partloom.sources.storage import shared_folder


def work_folder(spark: SparkSession) -> str:
    """A fresh folder below the one that every node reaches (``spark.checkpoint.dir``).

    Where that setting is absent, a local session gets a temporary folder; a cluster is refused.
    """
    try:
        root = shared_folder(spark)
    except ConfigError:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-"):
            raise
        root = "file:" + tempfile.mkdtemp(prefix="run-") + "/"
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}/"


def stored(frame: DataFrame, folder: str, name: str) -> DataFrame:
    """The rows written as Parquet below ``folder`` and read again: lineage ends there, and a lost
    executor costs no more than the reading."""
    path = f"{folder}{name}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def give_back() -> None:
    """Hand memory that a batch has left unused back to the machine.

    Python workers live on from task to task and stage to stage, and what each of them once needed
    would add up beside the executor's heap.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def is_empty(frame: DataFrame) -> bool:
    return not frame.take(1)


#: Most blocks of 64 bits in a table that says which keys another frame may hold.
MOST_BLOCKS = 1 << 19


def asked_for(frame: DataFrame, column: str, keys: DataFrame, name: str = "asked_for") -> DataFrame:
    """``frame`` with a boolean column that is false only where ``keys`` does not hold the row's ``column`` (long).

    A blocked Bloom filter in a broadcast join, so rows that a join would refuse are not shuffled. It has
    at most ``MOST_BLOCKS`` rows; for too many keys all rows are marked.
    """
    n = keys.count()
    blocks = max(1, n * 12 // 64)
    if blocks > 2 * MOST_BLOCKS:
        return frame.withColumn(name, F.lit(True))
    hashed = F.xxhash64(column, F.lit(11))
    block = F.pmod(F.shiftright(hashed, 24), F.lit(min(blocks, MOST_BLOCKS)))
    mask = F.lit(0).cast("long")
    for k in range(4):
        place = F.shiftrightunsigned(hashed, 6 * k).bitwiseAND(63).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    held = keys.select(block.alias("__block__"), mask.alias("mask")).groupBy("__block__").agg(F.bit_or("mask").alias("__bits__"))
    marked = frame.withColumns({"__block__": block, "__mask__": mask}).join(F.broadcast(held), "__block__", "left")
    found = F.coalesce(F.col("__bits__").bitwiseAND(F.col("__mask__")) == F.col("__mask__"), F.lit(False))
    return marked.withColumn(name, found).drop("__block__", "__mask__", "__bits__")


def merge_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star per component of the pairs ``(a, b)``: each node with its least fellow node.

    Works on whole arrays: labels sink to the least neighbour and are then shortened, until still.
    """
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a):]
    label = np.arange(len(nodes))
    while len(x):
        low = np.minimum(label[x], label[y])
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        while True:
            shorter = label[label]
            if np.array_equal(shorter, label):
                break
            label = shorter
        apart = label[x] != label[y]
        x, y = x[apart], y[apart]
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def components(links: DataFrame, folder: str, name: str = "components") -> DataFrame:
    """``node`` and ``component`` (its least node) for every node of the links ``a``-``b`` (long).

    Each round orders all nodes by a hash drawn anew, joins every node to the first of its
    neighbourhood and replaces links by the links between those: a constant share of the nodes goes
    per round whatever the shape of the graph. A node's first neighbour is found by a partial
    aggregate, so a hub is not gathered in one task. Each round is written to ``folder``.
    """
    left = stored(
        links.where("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long")).distinct(), folder, f"{name}-links"
    )
    steps: list[DataFrame] = []
    number = 0
    while not is_empty(left):
        seed = F.lit(number + 1)
        order = lambda column: F.struct(F.xxhash64(column, seed).alias("h"), F.col(column).alias("id"))  # noqa: B023, E731
        both = left.select("a", "b").union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min(order("b")).alias("best")).select(
            F.col("a").alias("node"), F.least(F.col("best"), order("a")).getField("id").alias("head")
        )
        first = stored(first, folder, f"{name}-heads-{number}")
        steps.append(first)
        ends = lambda end: first.select(F.col("node").alias(end), F.col("head").alias(f"{end}_head"))  # noqa: B023, E731
        left = (
            left.join(ends("a"), "a").join(ends("b"), "b").where("a_head <> b_head")
            .select(F.least("a_head", "b_head").alias("a"), F.greatest("a_head", "b_head").alias("b")).distinct()
        )
        left = stored(left, folder, f"{name}-links-{number}")
        number += 1
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    joined = steps[-1]
    for earlier in reversed(steps[:-1]):
        # Heads that later rounds no longer saw stand for themselves.
        later = joined.select(F.col("node").alias("head"), F.col("head").alias("last"))
        joined = earlier.join(later, "head", "left").select("node", F.coalesce("last", "head").alias("head"))
    joined = stored(joined, folder, f"{name}-joined")
    least = joined.groupBy("head").agg(F.min("node").alias("component"))
    return joined.join(least, "head").select("node", "component")


#: Bytes of text that are worked on at once; a longer text is worked on alone.
_CHUNK = 4_000_000


def plain(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def chunks(texts: pa.Array, bytes_at_once: int | None = None) -> Iterator[pa.Array]:
    """The texts in parts of bounded size, each a copy: some kernels misread a slice once it is cast."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, before + (bytes_at_once or _CHUNK), side="right")))
        yield texts.take(pa.array(np.arange(at, to)))
        at = to


def flat_words(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The number of the value each word is from, and the words; white space is ASCII's six characters."""
    lists = pc.ascii_split_whitespace(values)
    owner = pc.list_parent_indices(lists)
    flat = pc.list_flatten(lists)
    real = pc.not_equal(flat, pa.scalar("", flat.type))
    return owner.filter(real).to_numpy(zero_copy_only=False).astype(np.int64), flat.filter(real)
