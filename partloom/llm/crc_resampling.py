"""Importance resampling towards a target: hashed features, log-ratio weights, a weighted draw without return.

Every feature (a run of 1 to ``max_words`` words) falls into one of ``n_buckets`` by the CRC-32 of its bytes.
A bucket's gain is the log of how much commoner it is among the target's features than among the source's,
a text's weight is the mean gain of its features, and Gumbel noise keyed by seed and id turns the
highest scores into a draw in proportion to the weights.

CRCs are taken over arrays: the distinct features of a batch are dealt by length, those of one length are
a matrix of bytes with a row per place, each row moves the CRCs of the whole length on by one byte, and the
buckets go back to the features' places. Lengths over ``runs.LONGEST`` bytes, of which there are few,
are hashed one by one.

At scale: both passes over the texts are without a shuffle but for at most ``n_buckets`` counts a task.
What the driver holds is one gain a bucket. Ranks come from a range shuffle of the scores with a row number as
the last key, so equal scores and ids are divided as well; each part counts from its own offset.

Defined results: a null text has no features, weight 0, and a score; a null id counts as the empty text in
the noise and is the smallest id; rows of one id and score keep some order; extra columns are ignored; an
empty table gives no rows, an empty target makes all gains those of counts of zero.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partloom.llm.common import chunks, plain, stored, work_folder
from partloom.llm.runs import binary_bytes, crcs, gathered, lowered, runs, text_bytes

#: Of ASCII, only letters and digits make words; all else above it does.
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def features(texts: pa.Array, n_buckets: int, max_words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2, … words: the text each feature is from, and its bucket."""
    data, places = text_bytes(texts)
    data = lowered(data)
    owner, start, length = runs(_WORD_BYTE[data], places)
    # All words with one space behind each, so that a run of words is a range of bytes.
    spaced_start = np.concatenate([[0], np.cumsum(length + 1)])
    spaced = np.full(spaced_start[-1], 32, np.uint8)
    spaced[np.arange(int(length.sum())) + np.repeat(np.arange(len(length)), length)] = data[_WORD_BYTE[data]]
    for words in range(1, max_words + 1):
        n = max(0, len(owner) - words + 1)
        whole = np.flatnonzero(owner[:n] == owner[words - 1: words - 1 + n])
        at, size = spaced_start[whole], spaced_start[whole + words] - 1 - spaced_start[whole]
        named = gathered(spaced, at, size).dictionary_encode()
        kinds, ends = binary_bytes(named.dictionary)
        bucket = crcs(kinds, ends[:-1], np.diff(ends)).astype(np.int64) % n_buckets
        yield owner[whole], bucket[named.indices.to_numpy(zero_copy_only=False)]


def bucket_counts(texts: DataFrame, n_buckets: int, max_words: int) -> DataFrame:
    """``bucket`` and ``n``: how many features of the column ``text`` each bucket holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for part in chunks(plain(batch.column("text"))):
                for _, bucket in features(part, n_buckets, max_words):
                    total += np.bincount(bucket, minlength=n_buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    counted = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, n_buckets: int) -> np.ndarray:
    """The gain of each bucket in thousandths, from the bucket counts of both sides; at most ``n_buckets`` rows come here."""
    counts = np.zeros((2, n_buckets), np.int64)
    for side, frame in zip(counts, (source, target), strict=True):
        for bucket, n in frame.select("bucket", "n").collect():
            side[bucket] = n
    held, wanted = int(counts[0].sum()) + n_buckets, int(counts[1].sum()) + n_buckets
    ratio = lambda s, t: float((t + 1) * held) / float((s + 1) * wanted)
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in counts.T.tolist()], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, max_words: int) -> DataFrame:
    """``doc_id``, ``n_features``, ``n_words`` and ``weight`` (floored mean gain) of every row."""
    n_buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.empty((3, 0), np.int64)]
            for part in chunks(plain(batch.column("text"))):
                n, words, total = (np.zeros(len(part), np.int64) for _ in range(3))
                for longer, (owner, bucket) in enumerate(features(part, n_buckets, max_words)):
                    held = np.bincount(owner, minlength=len(part))
                    n += held
                    words += 0 if longer else held
                    np.add.at(total, owner, gain[bucket])
                found.append(np.stack([n, words, np.where(n > 0, total // np.maximum(n, 1), 0)]))
            columns = [pa.array(values) for values in np.concatenate(found, axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "n_features", "n_words", "weight"])

    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, n_features long, n_words long, weight long")


def noise(seed: int) -> Column:
    """Gumbel noise of a row in thousandths, from the first 32 bits of a digest of seed and ``doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(share))).cast("long")


def ranked(scored: DataFrame, drawn: int, folder: str) -> DataFrame:
    """The rows with ``rank`` 1, 2, … by falling score, then doc_id; beyond ``drawn`` it is null."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            place = pa.array(np.arange(seen, seen + batch.num_rows, dtype=np.int64))
            seen += batch.num_rows
            columns = [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int64)), place]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part", "place"])

    order = [F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("row")]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in scored.schema.fields)
    dealt = scored.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = stored(dealt.mapInArrow(number, f"{kinds}, part long, place long"), folder, "numbered")
    sizes = dict(map(tuple, numbered.groupBy("part").count().collect()))  # a row per shuffle partition
    before, total = [], 0
    for part in sorted(sizes):
        before.append((part, total))
        total += sizes[part]
    offsets = scored.sparkSession.createDataFrame(before, "part long, before long")
    rank = F.col("before") + F.col("place") + 1
    return numbered.join(F.broadcast(offsets), "part").withColumn("rank", F.when(rank <= drawn, rank))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    n_buckets: int = 10_000,
    max_words: int = 1,
    seed: int = 2024,
    folder: str | None = None,
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` (null: not drawn) of every row.

    Of the rows with at least ``least_words`` words, ``percent`` in a hundred (rounded down) are drawn.
    """
    folder = folder or work_folder(docs.sparkSession)
    gain = gains(bucket_counts(docs, n_buckets, max_words), bucket_counts(target, n_buckets, max_words), n_buckets)
    scored = weights(docs, gain, max_words).withColumns(
        {"score": F.col("weight") + noise(seed), "row": F.monotonically_increasing_id()}
    )
    scored = stored(scored, folder, "scored")
    able = F.col("n_words") >= least_words
    drawn = percent * scored.where(able).count() // 100
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    chosen = ranked(scored.where(able), drawn, folder).select(columns)
    return chosen.unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")).select(columns))
