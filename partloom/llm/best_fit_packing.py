"""Best-fit packing into sequences of several permitted lengths.

Documents are cut into pieces no longer than the largest length, and pieces go, longest first, to the
open bin that they leave the least room in. Where none has room a bin is opened: of the permitted
lengths, the one whose cost per token is least when filled with the longest pieces still waiting that
fit. In the end each bin takes the smallest permitted length that holds its contents.

Pieces are dealt over shards of a bounded number of pieces by a hash, and a shard is packed in one
group; a shard of ``per_shard`` pieces is close to what packing all of them would give. Only ids
and lengths are shuffled.

Defined results: a null or empty text is one piece of no words; a token is a word (white space is
ASCII's), and every piece takes ``overhead`` tokens more; rows without an id or with one that repeats
are documents of their own; ties go by (doc_id, piece); extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partloom.llm.common import stored, work_folder


@dataclass(frozen=True)
class Lengths:
    """Permitted lengths with their costs; by default a length costs its tokens and a fixed part per sequence."""

    sizes: tuple[int, ...] = (512, 2048, 8192)
    costs: Mapping[int, float] | None = None
    fixed: float = 64.0
    overhead: int = 1

    def __post_init__(self):
        if not self.sizes or list(self.sizes) != sorted(set(self.sizes)) or self.sizes[0] <= self.overhead:
            raise ValueError("sizes must rise, each above the overhead")

    def cost(self, size: int) -> float:
        return self.costs[size] if self.costs else size + self.fixed


class _Waiting:
    """How many pieces of each length still wait."""

    def __init__(self, lengths: np.ndarray):
        kinds, counts = np.unique(lengths, return_counts=True)
        self.kinds, self.counts = kinds.tolist(), counts.tolist()

    def take(self, length: int) -> None:
        self.counts[bisect_left(self.kinds, length)] -= 1

    def fill(self, room: int) -> int:
        """Tokens that the longest waiting pieces that fit would put into ``room``."""
        filled, at = 0, len(self.kinds)
        while True:
            at = bisect_right(self.kinds, room - filled, hi=at) - 1
            if at < 0:
                return filled
            filled += min(self.counts[at], (room - filled) // self.kinds[at]) * self.kinds[at]


def pack_lengths(lengths: np.ndarray, allowed: Lengths) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For pieces in falling order of length: the bin of each, its place in the bin, and the length of each bin."""
    waiting = _Waiting(lengths)
    rooms: list[int] = []  # the different rooms of open bins
    by_room: dict[int, list[int]] = {}
    used: list[int] = []
    opened: list[int] = []
    bins, places = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, length in enumerate(lengths.tolist()):
        waiting.take(length)
        at = bisect_left(rooms, length)
        if at < len(rooms):
            room = rooms[at]
            chosen = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
        else:
            rate = lambda size: allowed.cost(size) / (length + waiting.fill(size - length))  # noqa: B023, E731
            size = min((s for s in allowed.sizes if s >= length), key=lambda s: (rate(s), -s))
            chosen = len(used)
            used.append(0)
            opened.append(size)
        bins[i], places[i] = chosen, used[chosen]
        used[chosen] += length
        room = opened[chosen] - used[chosen]
        if room:
            if room not in by_room:
                insort(rooms, room)
                by_room[room] = []
            by_room[room].append(chosen)
    sizes = np.array(allowed.sizes)
    return bins, places, sizes[np.searchsorted(sizes, np.array(used, np.int64))] if used else np.empty(0, np.int64)


_PLAN = (
    "doc_id {kind}, piece int, first_word long, n_words long, bin_id long, bin_size long, bin_tokens long, position long"
)


def pack(docs: DataFrame, allowed: Lengths | None = None, per_shard: int = 100_000, folder: str | None = None) -> DataFrame:
    """A row per piece: its words (``first_word``, ``n_words``), its bin, the bin's length and contents
    in tokens, and the piece's position in it."""
    allowed = allowed or Lengths()
    folder = folder or work_folder(docs.sparkSession)
    largest = allowed.sizes[-1] - allowed.overhead
    words = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    # Rows without an id get a number, so that they do not all meet in one shard.
    counted = stored(docs.select("doc_id", words.alias("words"), F.monotonically_increasing_id().alias("row")), folder, "lengths")
    last = F.greatest(F.ceil(F.col("words") / largest) - 1, F.lit(0)).cast("int")
    pieces = counted.select("doc_id", "row", "words", F.explode(F.sequence(F.lit(0), last)).alias("piece")).select(
        "doc_id", "row", "piece",
        (F.col("piece") * F.lit(largest).cast("long")).alias("first_word"),
        F.least(F.col("words") - F.col("piece") * F.lit(largest).cast("long"), F.lit(largest)).alias("n_words"),
    )
    total = counted.agg(F.sum(last + 1)).first()[0] or 0  # one number
    shards = max(1, -(-total // per_shard))
    who = F.when(F.col("doc_id").isNull(), F.xxhash64("row", "piece")).otherwise(F.xxhash64("doc_id", "piece"))
    overhead = allowed.overhead

    def fill(key: tuple, rows: pa.Table) -> pa.Table:
        order = [("n_words", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("row", "ascending")]
        rows = rows.sort_by(order)
        lengths = rows["n_words"].to_numpy() + overhead
        bins, places, sizes = pack_lengths(lengths, allowed)
        contents = np.bincount(bins, weights=lengths, minlength=len(sizes)).astype(np.int64)
        found = {"bin_id": (key[0].as_py() << 32) + bins, "bin_size": sizes[bins], "bin_tokens": contents[bins], "position": places}
        out = rows.select(["doc_id", "piece", "first_word", "n_words"])
        for name, values in found.items():
            out = out.append_column(name, pa.array(values, pa.int64()))
        return out

    kind = docs.schema["doc_id"].dataType.simpleString()
    return pieces.withColumn("shard", F.pmod(who, F.lit(shards))).groupBy("shard").applyInArrow(fill, _PLAN.format(kind=kind))


def sequences(plan: DataFrame) -> DataFrame:
    """A row per bin: its length, its tokens, and its pieces in order (``doc_id``, ``first_word``, ``n_words``, ``position``).
    A bin holds no more pieces than its length has tokens."""
    piece = F.struct("position", "doc_id", "piece", "first_word", "n_words")
    return plan.groupBy("bin_id").agg(
        F.first("bin_size").alias("bin_size"), F.first("bin_tokens").alias("bin_tokens"),
        F.sort_array(F.collect_list(piece)).alias("pieces"),
    ).withColumn("doc_ids", F.transform("pieces", lambda p: p["doc_id"]))
