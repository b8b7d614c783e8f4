"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

Fingerprints are the paths of a binary trie. Pairs of nodes of equal depth are walked together from
the pair (root, root): a child pair that differs adds one to the pair's differing bits, and pairs over
the budget are dropped with everything below. The first levels are walked by Spark: each distinct
fingerprint goes to the pairs of subtrees that its prefix takes part in, and one group of rows is one
pair. Within a group the walk goes on level by level over arrays.

Skew: copies share a fingerprint, so they meet in a partial aggregate before anything is joined, and
a subtree holds distinct fingerprints only. The depth of the first levels follows the number of
fingerprints. Bits are taken in the order of their balance, so a crowd of like fingerprints parts
early. A pair of subtrees gives a spanning star of its links, never all pairs.

Defined results: a text without words has fingerprint zero; ids may repeat (each row keeps its own
fingerprint; a component's id is its least non-null id, null if it has none); extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partloom.llm.common import components, give_back, merge_pairs, stored, work_folder

BITS = 64
#: Fingerprints that a subtree of the first levels should hold.
SUBTREE = 2048
#: Most first levels, so that a prefix has at most a few hundred partners.
MOST_LEVELS = 20
#: Node pairs that are walked at once.
FRONTIER = 1_000_000
#: Shingles whose bits are counted at once.
_SHINGLES = 16_384


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The text's SimHash, as a signed 64-bit number: bit set if set in over half of the shingles' hashes."""
    if not text:
        return 0
    words = text.encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    if len(words) <= shingle:
        starts, stops = [0], [len(line)]
    else:
        starts = np.concatenate([[0], ends[:-shingle]]).tolist()
        stops = (ends[shingle - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(BITS, np.int64), len(starts)
    for at in range(0, n, _SHINGLES):
        hashes = [digest(line[a:b], seed) for a, b in zip(starts[at: at + _SHINGLES], stops[at: at + _SHINGLES], strict=True)]
        packed = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(packed, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id``, ``text_hash`` (64 bits) and ``fp`` (long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(text.as_py(), shingle, seed) for text in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), found], names=["doc_id", "text_hash", "fp"])
            give_back()

    text = F.col("text").cast("string")
    slim = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, text_hash long, fp long")


def walk(a: np.ndarray, b: np.ndarray, skip: int, budget: int, itself: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs into the sorted ``a`` and ``b`` (uint64, each with one ``skip``-bit prefix) whose
    values differ in at most ``budget`` bits beyond the prefix. ``itself``: ``a`` is ``b``; each pair once."""

    def ones_before(values: np.ndarray, level: int) -> np.ndarray:
        bit = (values >> np.uint64(BITS - 1 - level)) & np.uint64(1)
        return np.concatenate([[0], np.cumsum(bit.astype(np.int64))])

    cuts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    todo = [(skip, np.array([[0, len(a), 0, len(b), 0]]))]
    while todo:
        level, pairs = todo.pop()
        if not len(pairs):
            continue
        if len(pairs) > FRONTIER:
            half = len(pairs) // 2
            todo += [(level, pairs[:half]), (level, pairs[half:])]
            continue
        if level == BITS:  # equal values are one fingerprint, so a node at the bottom holds one of each side
            x, y = pairs[:, 0], pairs[:, 2]
            keep = x != y if itself else slice(None)
            yield x[keep], y[keep]
            continue
        single = (pairs[:, 1] - pairs[:, 0] == 1) & (pairs[:, 3] - pairs[:, 2] == 1)
        if single.any():  # nothing branches below: the rest of the bits at once
            x, y = pairs[single, 0], pairs[single, 2]
            rest = np.uint64((1 << (BITS - level)) - 1)
            near = pairs[single, 4] + np.bitwise_count((a[x] ^ b[y]) & rest) <= budget
            if itself:
                near &= x != y
            yield x[near], y[near]
            pairs = pairs[~single]
            if not len(pairs):
                continue
        if level not in cuts:
            cuts[level] = (ones_before(a, level), ones_before(b, level))
        ones_a, ones_b = cuts[level]
        a0, a1, b0, b1, differ = pairs.T
        am, bm = a1 - (ones_a[a1] - ones_a[a0]), b1 - (ones_b[b1] - ones_b[b0])
        same = np.column_stack([a0, am, b0, bm, differ]), np.column_stack([am, a1, bm, b1, differ])
        left = differ < budget
        across = np.column_stack([a0, am, bm, b1, differ + 1])[left]
        back = left & ~((a0 == b0) & (a1 == b1)) if itself else left
        children = np.concatenate([*same, across, np.column_stack([am, a1, b0, bm, differ + 1])[back]])
        children = children[(children[:, 1] > children[:, 0]) & (children[:, 3] > children[:, 2])]
        if itself:  # a node with one fingerprint has no pair within itself
            children = children[~((children[:, 0] == children[:, 2]) & (children[:, 1] - children[:, 0] == 1) & (children[:, 3] - children[:, 2] == 1))]
        todo.append((level + 1, children))


def _reordered(values: np.ndarray, order: list[int]) -> np.ndarray:
    """The values with their bits (0 the highest) in the given order; distances stay."""
    bits = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, order]
    return np.ascontiguousarray(np.packbits(bits, axis=1)).view(">u8").reshape(-1).astype(np.uint64)


def links(distinct: DataFrame, budget: int, levels: int, order: list[int]) -> DataFrame:
    """Spanning links ``a``-``b`` of the distinct fingerprints ``fp`` that differ in at most ``budget`` bits."""
    masks = [sum(1 << i for i in chosen) for k in range(min(budget, levels) + 1) for chosen in combinations(range(levels), k)]

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fps = frame["fp"].to_numpy(np.int64)
            trie = _reordered(fps.view(np.uint64), order)
            prefix = (trie >> np.uint64(BITS - levels)).astype(np.int64) if levels else np.zeros(len(fps), np.int64)
            for mask in masks:  # the pair of subtrees is named by the lesser prefix and what they differ in
                yield pd.DataFrame({"low": np.minimum(prefix, prefix ^ mask), "mask": np.int64(mask), "fp": fps})

    def meet(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        low, mask = key
        fps = frame["fp"].to_numpy(np.int64)
        trie = _reordered(fps.view(np.uint64), order)
        rank = np.argsort(trie, kind="stable")
        fps, trie = fps[rank], trie[rank]
        if mask:
            cut = int(np.searchsorted(trie >> np.uint64(BITS - levels), np.uint64(low), side="right"))
        else:
            cut = 0
        a, b = (trie[:cut], trie[cut:]) if mask else (trie, trie)
        if not len(a) or not len(b):
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        left, right = np.empty(0, np.int64), np.empty(0, np.int64)
        for x, y in walk(a, b, levels, budget - int(mask).bit_count(), not mask):
            # What is known shrinks to a star at once, so memory follows the rows and not their pairs.
            left, right = merge_pairs(np.concatenate([left, fps[x]]), np.concatenate([right, fps[y + cut if mask else y]]))
        return pd.DataFrame({"a": left, "b": right})

    sent = distinct.mapInPandas(send, "low long, mask long, fp long")
    return sent.groupBy("low", "mask").applyInPandas(meet, "a long, b long")


def _classes(prints: DataFrame, distance: int, folder: str) -> DataFrame:
    """``fp``, its ``class`` and ``least``, the smallest id that has it, for every distinct fingerprint."""
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), folder, "distinct")
    bit = [F.sum(F.shiftrightunsigned("fp", BITS - 1 - i).bitwiseAND(1)).alias(f"b{i}") for i in range(BITS)]
    totals = distinct.agg(F.count("*").alias("n"), *bit).first()  # one row of 65 numbers
    n = totals["n"]
    order = sorted(range(BITS), key=lambda i: (abs(2 * (totals[f"b{i}"] or 0) - n), i))
    levels = min(MOST_LEVELS, max(0, (n // SUBTREE).bit_length()))
    found = components(links(distinct.select("fp"), distance, levels, order), folder)
    return distinct.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("class")
    )


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2, seed: int = 42, folder: str | None = None) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 lower-case hex digits) and ``component_id`` of every row."""
    folder = folder or work_folder(docs.sparkSession)
    prints = stored(fingerprints(docs, shingle, seed), folder, "prints")
    classes = _classes(prints, distance, folder)
    least = classes.groupBy("class").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "class").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = 3, distance: int = 2, seed: int = 42, folder: str | None = None) -> DataFrame:
    """One row of each group of near copies, with all columns: the one of the smallest id.

    Where several rows have that id, the one whose text has the smallest hash; rows of one id and one
    text leave one. Rows of one id that are not near copies stay, as do all rows without an id.
    """
    folder = folder or work_folder(docs.sparkSession)
    prints = stored(fingerprints(docs.where("doc_id IS NOT NULL"), shingle, seed), folder, "prints")
    first = prints.groupBy("fp").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    first = first.join(_classes(prints, distance, folder), "fp").groupBy("class").agg(F.min("first").alias("first"))
    own = "text_hash"
    while own in docs.columns:
        own += "_"
    named = docs.where("doc_id IS NOT NULL").withColumn(own, F.xxhash64(F.col("text").cast("string")))
    kept = first.select(F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias(own))
    alone = named.join(kept, ["doc_id", own], "left_semi").dropDuplicates(["doc_id", own])
    return alone.select(*(F.col(f"`{name}`") for name in docs.columns)).unionByName(docs.where("doc_id IS NULL"))
