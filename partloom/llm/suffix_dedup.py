"""Remove every byte of a string of ``min_bytes`` bytes that also starts anywhere else, by suffix orders.

One suffix array of the whole corpus would be one task's work, so the corpus is dealt into shards in which equal
strings are certain to meet. Of the windows (strings of ``min_bytes``) of a text each one names the k-gram of
least hash within it, the leftmost of equals. Equal windows name equal k-grams at the same distance, and
the windows that name one place follow each other: an *occurrence* is such a run of windows, with the bytes that they
cover as its *content* and the k-gram's hash as its key. Occurrences whose key is alone in the corpus
have no partner and go no further than a count of keys.

Occurrences of equal content are one *class*; its content is read from one text only and counts as often as
it comes. The classes of one key make a shard: their contents, one after the other, form a string whose suffixes are
ordered by grouping under Lyndon prefixes (``lyndon_order``), hundreds of shards side by side. In that order equal
windows stand together; neighbours are compared byte for byte, and windows whose run counts two or more are
repeats. They go back to all occurrences of the class, and per text the windows' bytes are cut out together.

Skew: copies fall together in partial aggregates (equal contents, equal texts). A key of more than ``MOST``
classes is split: the contents of its classes are cut anew by the longest k-grams that leave ``FINE`` of them in a window,
which gives other keys, classes and shards. Where one of those has too many classes as well, its windows are
counted one by one, by hash. So no shard grows with the data.
Joins are by hashes, with rows that adaptive execution can divide. Texts are shuffled only if a bounded table of
bits says that the other side may ask for them; where there are too many for that, all are.

Defined results: a null text is empty; rows of equal text have equal results, and each repeats the other; ids are
passed on as they are; extra columns are ignored; a text under ``min_bytes`` bytes stays; an empty table
gives no rows. Texts count as equal by 64 bits of hash and their length, contents of one key by 64 bits of hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partloom.llm.common import asked_for, chunks, is_empty, plain, stored, work_folder
from partloom.llm.lyndon_order import suffix_orders
from partloom.llm.runs import binary_bytes, text_bytes

#: Classes of a shard above which it is split.
MOST = 256
#: K-grams in a window for the second cut of a shard with too many classes.
FINE = 20
#: Bytes of a text that are hashed at once, and of shards whose suffixes are ordered at once.
_PIECE, _ORDERED = 1 << 20, 1 << 20
_PLACE = 24  # bits that tell a place within a piece

_BASE = 0x9E3779B97F4A7C15
_CODES = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=np.uint64)


# --- occurrences ---------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and their inverses."""
    out = np.full((2, size), np.array([[_BASE], [pow(_BASE, -1, 1 << 64)]], np.uint64), np.uint64)
    out[:, 0] = 1
    np.multiply.accumulate(out, axis=1, out=out)
    return out[0], out[1]


class Hashes:
    """Hashes of any range of ``data``, from sums over its beginnings."""

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        power, self._back = _powers(1 << (max(n, _PIECE + 4096) - 1).bit_length())
        self._sums = np.zeros(n, np.uint64)
        inner = self._sums[1:]
        np.take(_CODES, data, out=inner)
        np.multiply(inner, power[: n - 1], out=inner)
        np.cumsum(inner, out=inner)

    def grams(self, k: int) -> np.ndarray:
        out = self._sums[k:] - self._sums[:-k]
        return np.multiply(out, self._back[: len(out)], out=out)

    def ranges(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self._sums[stop] - self._sums[start]) * self._back[start]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values that follow each other."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    upto = np.minimum.accumulate(rows, axis=1).ravel()
    np.minimum.accumulate(rows[:, ::-1], axis=1, out=rows[:, ::-1])
    return np.minimum(padded[:n], upto[width - 1: width - 1 + n])


def occurrences(data: np.ndarray, places: np.ndarray, width: int, gram: int):
    """Text, first window, number of windows, key and content hash of every occurrence in a piece."""
    if len(data) < width:
        return tuple(np.empty(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    hashed = Hashes(data)
    # High bits of the hash rank the grams, the leftmost first among equals; the low ones tell the place.
    grams = hashed.grams(gram)
    np.bitwise_and(grams, np.uint64(((1 << 64) - 1) >> _PLACE << _PLACE), out=grams)
    np.bitwise_or(grams, np.arange(len(grams), dtype=np.uint64), out=grams)
    named = _least(grams, width - gram + 1)
    n = len(named)
    heads = np.empty(n, bool)
    np.not_equal(named[1:], named[:-1], out=heads[1:])
    # A text's windows begin at its first byte and end where too few bytes are left.
    heads[0] = True
    heads[places[:-1][places[:-1] < n]] = True
    over = places[1:] - width + 1
    heads[over[(over > places[:-1]) & (over < n)]] = True
    first = np.flatnonzero(heads)
    count = np.diff(first, append=n)
    text = np.searchsorted(places, first, side="right") - 1
    whole = first < over[text]
    start, count, text = first[whole], count[whole], text[whole]
    anchor = (named[start] & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
    content = _mixed(hashed.ranges(start, start + count + width - 1))
    shape = ((anchor - start) * width + count).astype(np.uint64)
    key = _mixed(hashed.ranges(anchor, anchor + gram))
    return text, start - places[text], count, key, _mixed(content + shape * np.uint64(_BASE))


def pieces(texts: pa.Array, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Bytes of some texts: the texts' numbers, the bytes, where each begins, and the place of the first within its
    text. A long text comes in parts that share ``width - 1`` bytes."""
    seen = 0
    for part in chunks(texts, _PIECE):
        data, places = text_bytes(part)
        numbers = np.arange(seen, seen + len(part))
        seen += len(part)
        if len(part) > 1 or len(data) <= _PIECE:
            yield numbers, data, places, 0
            continue
        for at in range(0, len(data) - width + 1, _PIECE):
            some = data[at: at + _PIECE + width - 1]
            yield numbers, some, np.array([0, len(some)]), at


def found_in(texts: DataFrame, width: int, gram: int) -> DataFrame:
    """Every occurrence: ``text_hash``, ``n_bytes``, ``at`` (first window), ``n`` (windows), ``key``, ``content``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, sizes = plain(batch.column("text_hash")), plain(batch.column("n_bytes"))
            for numbers, data, places, offset in pieces(plain(batch.column("text")), width):
                text, at, n, key, content = occurrences(data, places, width, gram)
                rows = pa.array(numbers[text])
                yield pa.RecordBatch.from_arrays(
                    [hashes.take(rows), sizes.take(rows), pa.array(at + offset), pa.array(n.astype(np.int32)),
                     pa.array(key.view(np.int64)), pa.array(content.view(np.int64))],
                    names=["text_hash", "n_bytes", "at", "n", "key", "content"],
                )

    return texts.select("text_hash", "n_bytes", "text").mapInArrow(
        run, "text_hash long, n_bytes long, at long, n int, key long, content long"
    )


def repeated(texts: DataFrame, width: int, gram: int, folder: str) -> DataFrame:
    """The occurrences whose key comes more than once, one row per text hash and place, with their number ``times``."""
    every = stored(found_in(texts, width, gram), folder, "every")
    keys = stored(every.groupBy("key").count().where("count > 1").select("key"), folder, "keys")
    with_key = stored(every.join(keys, "key", "left_semi"), folder, "with-key")
    alike = with_key.groupBy("key", "content", "n", "text_hash", "n_bytes", "at").agg(F.count("*").alias("times"))
    return stored(alike, folder, "occurrences")


# --- shards ----------------------------------------------------------------------


def classes_of(found: DataFrame, most: int, folder: str) -> DataFrame:
    """One row per key and content: ``n``, ``times``, the first text and place that hold it, and whether its key is hot."""
    classes = found.groupBy("key", "content").agg(
        F.first("n").alias("n"), F.sum("times").alias("times"), F.min(F.struct("text_hash", "n_bytes", "at")).alias("first")
    )
    classes = stored(classes.select("key", "content", "n", "times", "first.*"), folder, "classes")
    hot = classes.groupBy("key").count().where(F.col("count") > most).select("key", F.lit(True).alias("hot"))
    return classes.join(hot, "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))


_CLASS = "key long, content long, n int, times long, bytes binary"


def contents(texts: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """The classes with their bytes, read from the texts that hold them first."""
    wanted = classes.groupBy("text_hash", "n_bytes").agg(F.collect_list(F.struct("key", "content", "n", "times", "at")).alias("asked"))
    joined = asked_for(texts, "text_hash", classes).where("asked_for").join(wanted, ["text_hash", "n_bytes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            asked = plain(batch.column("asked"))
            for i, named in enumerate(zip(batch.column("text_hash").to_pylist(), batch.column("n_bytes").to_pylist(), strict=True)):
                if named == last:  # copies of a text stand together
                    continue
                last = named
                data = batch.column("text")[i].as_buffer()
                key, content, n, times, at = asked[i].values.flatten()
                cut = [data[s: s + c + width - 1].to_pybytes() for s, c in zip(at.to_pylist(), n.to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([key, content, n, times, pa.array(cut, pa.binary())], names=["key", "content", "n", "times", "bytes"])

    return joined.select("text_hash", "n_bytes", F.col("text").cast("binary").alias("text"), "asked").mapInArrow(run, _CLASS)


def parts_of(classes: DataFrame, width: int, gram: int) -> DataFrame:
    """The classes' contents cut anew: ``of_key`` and ``of_content`` tell the class, ``place`` the first window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of_key, of_content, times = (plain(batch.column(name)) for name in ("key", "content", "times"))
            whole = plain(batch.column("bytes"))
            raw, places = binary_bytes(whole)
            text, at, n, key, content = occurrences(raw, places, width, gram)
            row = pa.array(text)
            cut = [raw[a: a + c + width - 1].tobytes() for a, c in zip((places[text] + at).tolist(), n.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [of_key.take(row), of_content.take(row), pa.array(at), pa.array(key.view(np.int64)), pa.array(content.view(np.int64)),
                 pa.array(n.astype(np.int32)), times.take(row), pa.array(cut, pa.binary())],
                names=["of_key", "of_content", "place", "key", "content", "n", "times", "bytes"],
            )

    return classes.mapInArrow(run, f"of_key long, of_content long, place long, {_CLASS}")


def windows_of(classes: DataFrame, width: int) -> DataFrame:
    """Every window of the classes with its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, content, times = (plain(batch.column(name)) for name in ("key", "content", "times"))
            for i, n in enumerate(batch.column("n").to_pylist()):
                raw = np.frombuffer(batch.column("bytes")[i].as_buffer(), np.uint8)
                row = pa.array(np.full(n, i))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_mixed(Hashes(raw).grams(width)).view(np.int64)), pa.array(np.arange(n)), key.take(row), content.take(row), times.take(row)],
                    names=["window", "place", "key", "content", "times"],
                )

    return classes.mapInArrow(run, "window long, place long, key long, content long, times long")


def repeats_in(shards: list[list[tuple[bytes, int, int]]], width: int) -> list[np.ndarray]:
    """For each class of each shard, given as (bytes, windows, times): which of its windows are repeats."""
    lengths = [sum(len(b) + 1 for b, _, _ in shard) for shard in shards]
    places = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    flat = [one for shard in shards for one in shard]
    starts = np.concatenate([[0], np.cumsum([len(b) + 1 for b, _, _ in flat], dtype=np.int64)])
    # Every class ends in a symbol below all bytes.
    raw = np.frombuffer(b"".join(b + b"\0" for b, _, _ in flat) + bytes(8), np.uint8)
    symbols = raw[: starts[-1]].astype(np.int64) + 1
    symbols[starts[1:] - 1] = 0
    order = suffix_orders(symbols, places)

    count = np.array([n for _, n, _ in flat])
    weight = np.zeros(starts[-1], np.int64)
    windows = np.repeat(starts[:-1], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    weight[windows] = np.repeat(np.array([t for _, _, t in flat]), count)
    order = order[weight[order] > 0]
    shard = np.repeat(np.arange(len(shards)), lengths)[order]
    equal = np.flatnonzero(shard[1:] == shard[:-1])
    eights = np.ndarray(len(raw) - 7, np.uint64, raw, strides=1).copy()
    for step in [*range(0, width - 7, 8), *([width - 8] if width % 8 else [])]:
        equal = equal[eights[order[equal] + step] == eights[order[equal + 1] + step]]
    heads = np.ones(len(order), bool)
    heads[equal + 1] = False
    first = np.flatnonzero(heads)
    total = np.add.reduceat(weight[order], first) if len(first) else np.empty(0, np.int64)
    again = np.zeros(starts[-1], bool)
    again[order] = np.repeat(total > 1, np.diff(first, append=len(order)))
    return [again[s: s + n] for s, n in zip(starts.tolist(), count.tolist(), strict=False)]


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def answers(held: list[tuple[int, list[int], list]], width: int) -> Iterator[pa.RecordBatch]:
    """Ranges of repeats in shards, given as key, contents and classes (bytes, windows, times).

    Windows of one class name one place, so no two of them are equal: a class without others is a repeat as a
    whole or not at all, and there is nothing to order it among.
    """
    alone = [(key, named[0], 0, cut[0][1]) for key, named, cut in held if len(named) == 1 and cut[0][2] > 1]
    held = sorted((shard for shard in held if len(shard[1]) > 1), key=lambda shard: sum(len(one[0]) for one in shard[2]))
    while held or alone:
        rows, alone = alone, []
        size, some = 0, []
        while held and (not some or size + sum(len(one[0]) for one in held[-1][2]) <= _ORDERED):
            some.append(held.pop())
            size += sum(len(one[0]) for one in some[-1][2])
        flags = iter(repeats_in([shard for _, _, shard in some], width) if some else [])
        for key, named, _ in some:
            for content in named:
                low, high = _stretches(next(flags))
                rows += [(key, content, a, b) for a, b in zip(low.tolist(), high.tolist(), strict=True)]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["key", "content", "low", "high"])


def by_suffixes(cut: DataFrame, width: int) -> DataFrame:
    """``key``, ``content`` and ranges ``low`` to ``high`` of windows that are repeats, from the shards' suffix orders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, list[int], list]] = []
        size = 0
        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("key", "content", "n", "times", "bytes"))
            for key, content, n, times, text in zip(*columns, strict=True):
                if held and held[-1][0] == key:
                    if held[-1][1][-1] == content:
                        continue
                else:
                    if size > 2 * _ORDERED:
                        yield from answers(held, width)
                        held, size = [], 0
                    held.append((key, [], []))
                held[-1][1].append(content)
                held[-1][2].append((text, n, times))
                size += len(text)
        if held:
            yield from answers(held, width)

    tasks = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut.repartition(tasks, "key").sortWithinPartitions("key", "content")
    return dealt.mapInArrow(run, "key long, content long, low long, high long")


def by_windows(windows: DataFrame, folder: str) -> DataFrame:
    """The same by counting windows of one hash."""
    windows = stored(windows, folder, "windows")
    often = windows.groupBy("key", "window").agg(F.sum("times").alias("times")).where("times > 1").select("key", "window")
    place = F.col("place")
    return windows.join(often, ["key", "window"], "left_semi").select("key", "content", place.alias("low"), (place + 1).alias("high"))


def by_parts(classes: DataFrame, width: int, most: int, folder: str) -> DataFrame:
    """The same for classes of keys that have too many of them: cut into smaller shards, and those into windows."""
    # A text that was divided among tasks may have given its class in each.
    parts = stored(parts_of(classes.dropDuplicates(["key", "content"]), width, max(8, width - FINE + 1)), folder, "parts")
    alike = parts.groupBy("key", "content").agg(F.first("n").alias("n"), F.sum("times").alias("times"), F.first("bytes").alias("bytes"))
    alike = stored(alike, folder, "alike")
    held = alike.groupBy("key").agg(F.count("*").alias("held"), F.sum("times").alias("all_times")).where("all_times > 1")
    held = stored(held, folder, "held")
    few = alike.join(held.where(F.col("held") <= most).select("key"), "key", "left_semi")
    marks = stored(by_suffixes(few, width), folder, "part-marks")
    crowded = held.where(F.col("held") > most).select("key")
    if not is_empty(crowded):
        marks = marks.unionByName(by_windows(windows_of(alike.join(crowded, "key", "left_semi"), width), folder))
    back = parts.select("of_key", "of_content", "place", "key", "content").join(marks, ["key", "content"])
    return back.select(
        F.col("of_key").alias("key"), F.col("of_content").alias("content"),
        (F.col("place") + F.col("low")).alias("low"), (F.col("place") + F.col("high")).alias("high"),
    )


# --- removal ---------------------------------------------------------------------


def _removed(spans, size: int) -> tuple[list[dict], np.ndarray]:
    """Joined spans and which bytes they leave."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, spans.field(0).to_numpy(), 1)
    np.add.at(edges, spans.field(1).to_numpy(), -1)
    gone = np.cumsum(edges[:-1]) > 0
    return [{"start": a, "stop": b} for a, b in zip(*(e.tolist() for e in _stretches(gone)), strict=True)], ~gone


def remove_repeats(docs: DataFrame, min_bytes: int = 200, gram: int = 50, most: int = MOST, folder: str | None = None) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``spans`` (byte ranges that go, merged) and ``kept`` (the other bytes) of every row."""
    if not 8 <= gram < min_bytes:
        raise ValueError("gram must be at least 8 and less than min_bytes")
    folder = folder or work_folder(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("text_hash"), F.octet_length("text").cast("long").alias("n_bytes")
    )
    long_enough = texts.where(F.col("n_bytes") >= min_bytes)
    found = repeated(long_enough, min_bytes, gram, folder)
    classes = classes_of(found, most, folder)
    whole = contents(long_enough, classes.where("NOT hot"), min_bytes)
    marks = stored(by_suffixes(whole, min_bytes), folder, "marks")
    hot = classes.where("hot")
    if not is_empty(hot):
        marks = marks.unionByName(by_parts(contents(long_enough, hot, min_bytes), min_bytes, most, folder))
    span = F.struct((F.col("at") + F.col("low")).alias("start"), (F.col("at") + F.col("high") + (min_bytes - 1)).alias("stop"))
    spans = found.join(marks, ["key", "content"]).groupBy("text_hash", "n_bytes").agg(F.collect_list(span).alias("found"))
    spans = stored(spans, folder, "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, kept, joined = plain(batch.column("found")), [], []
            for i in range(batch.num_rows):
                raw = np.frombuffer(batch.column("text")[i].as_buffer(), np.uint8)
                merged, left = _removed(found[i].values, len(raw)) if found[i].is_valid else ([], slice(None))
                joined.append(merged)
                kept.append(raw[left].tobytes())
            shape = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            columns = [batch.column("doc_id"), batch.column("n_bytes"), pa.array(joined, shape), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "spans", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = "array<struct<start:bigint,stop:bigint>>"
    binary = F.col("text").cast("binary")
    marked = asked_for(texts, "text_hash", spans)
    cut = marked.where("asked_for").join(spans, ["text_hash", "n_bytes"], "left").select(
        "doc_id", "n_bytes", binary.alias("text"), "found"
    ).mapInArrow(run, f"doc_id {kind}, n_bytes long, spans {shape}, kept binary")
    untouched = marked.where("NOT asked_for").select("doc_id", "n_bytes", F.array().cast(shape).alias("spans"), binary.alias("kept"))
    return cut.unionByName(untouched)
