"""Substring dedup: paragraphs banded by MinHash, verified by exact Jaccard, removed by components.

Two kinds of paragraphs are looked at. Lines of at least ``min_words`` words are compared by MinHash:
bands tuned to a recall, colliding lines joined, the Jaccard similarity of their word shingles
computed in full, and lines clustered by components; one line of a cluster stays. Passages that
stand within longer lines are no line of their own, so texts are also cut into content-defined
paragraphs: windows of words whose places depend on the words alone (the least hash of each run of
windows). Every passage of ``min_words`` words belongs to the window with the least hash in it, so equal
passages belong to equal windows at the same place. A passage goes if an equal one (by 128 bits of
hashes of all its words) stands before it: what stays is the occurrence with the least (doc_id, word).

Scale: equal windows meet in a partial aggregate. Blocks, a window with all passages that belong to
it, are only sent for windows that may repeat, told by a bitmap of fixed size; where it fills up it lets
more rows pass, and the joins after it decide. Equal blocks are told by one key; only where a window
has several different blocks, the first of each are looked at. Their passages come in quarters by where the window
stands in them, and what all passages of a quarter hold (42 words of 50) has a hash; only passages of quarters that
another block has too are read from the texts again and compared one by one. Buckets of a band with
equal members are verified once, large ones in pairs of blocks; a group gives a spanning star of its links.

Defined results: words are split at ASCII white space and compared without ASCII case; a null text is
empty and stays null; rows without an id are left as they are; rows that repeat an id and its text count as
one document, and rows that repeat an id with another text as several, in the order of a hash of their texts;
extra columns are kept; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partloom.llm.common import chunks, components, flat_words, give_back, merge_pairs, plain, stored, work_folder

#: Words of a content-defined paragraph.
WINDOW = 16
#: Bits of the table that tells which paragraphs may repeat (8 MB).
TABLE_BITS = 26
#: Parts of a window's passages, by where the window stands in them.
PARTS = 4
#: Members of a bucket that are verified in one group, and rows of small buckets that make up a group.
BLOCK, TOGETHER = 2048, 8192
#: Members up to which a bucket is small.
SMALL = 64
#: Bytes of text, and windows, that are worked on at once.
BYTES, ROWS = 1_000_000, 4096

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # odd, so they have inverses


def tuned_bands(similarity: float, recall: float) -> tuple[int, int]:
    """The longest bands, and as many of them, that find a pair of this similarity with this probability
    using at most 64 hashes: (bands, rows)."""
    best = (1, 1)
    for rows in range(1, 17):
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))
        if bands * rows <= 64:
            best = (bands, rows)
    return best


@dataclass(frozen=True)
class Options:
    min_words: int = 50
    shingle: int = 5
    similarity: float = 0.8
    recall: float = 0.999
    seed: int = 7

    def __post_init__(self):
        if self.min_words < WINDOW + 8:
            raise ValueError(f"min_words must be at least {WINDOW + 8}")

    @property
    def run(self) -> int:
        """Windows in a row of which one is chosen: any ``min_words`` words hold that many."""
        return self.min_words - WINDOW + 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Rolling:
    """Hashes of word ranges by prefix sums modulo 2**64."""

    def __init__(self, words: np.ndarray, base: np.uint64):
        n = len(words) + 1
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, base)]))
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        self.back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, inverse)]))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(words * powers[:-1])])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[stop] - self.sums[start]) * self.back[start] + (stop - start).astype(np.uint64))


@dataclass
class _Paragraphs:
    """The paragraphs of some texts; places are word numbers over all of them."""

    doc_start: np.ndarray  # first word of each document, and the end of the last
    words: np.ndarray  # a hash per word
    window: np.ndarray
    window_keys: np.ndarray
    least: np.ndarray  # first and last place where a passage begins that belongs to each window
    most: np.ndarray
    rolling: _Rolling
    line: np.ndarray
    line_end: np.ndarray
    line_keys: tuple[np.ndarray, np.ndarray]
    shingles: np.ndarray  # a hash per place, of the shingle that begins there

    def doc_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_start, place, side="right") - 1

    def within_documents(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the windows that repeat an earlier one of their own document, and of those earlier ones."""
        order = np.lexsort((self.window, self.window_keys, self.doc_of(self.window)))
        parts = [self.doc_of(self.window)[order], self.window_keys[order]]
        new = np.ones(len(order), bool)
        new[1:] = np.any([x[1:] != x[:-1] for x in parts], axis=0)
        first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        return order[~new], first[~new]

    def passages(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the passages of ``some`` windows begin, one window after the other, and where each window's begin."""
        return _between(self.least[some], self.most[some])


def _between(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from each first to its last, and where each begin."""
    count = last - first + 1
    offset = np.concatenate([[0], np.cumsum(count)])
    return np.arange(offset[-1]) - np.repeat(offset[:-1] - first, count), offset


def _paragraphs(texts: pa.Array, o: Options) -> _Paragraphs:
    values = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    lines = pc.split_pattern(values, "\n")
    line_doc = pc.list_parent_indices(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    in_line, flat = flat_words(pc.list_flatten(lines))
    coded = flat.dictionary_encode()
    known = np.fromiter((xxhash.xxh3_64_intdigest(w, o.seed) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    words = known[coded.indices.to_numpy(zero_copy_only=False)] if len(known) else np.empty(0, np.uint64)
    n = len(words)
    doc_start = np.searchsorted(line_doc[in_line] if n else np.empty(0, np.int64), np.arange(len(texts) + 1))
    first, second = _Rolling(words, _A), _Rolling(_mixed(words ^ _B), _B)

    # The place with the least hash of each run of windows that lies within one document.
    window = lowest = highest = np.empty(0, np.int64)
    if n >= o.min_words:
        at = np.arange(n - WINDOW + 1)
        order = first.of(at, at + WINDOW)
        doc = line_doc[in_line]
        whole = np.flatnonzero(doc[: n - o.min_words + 1] == doc[o.min_words - 1:])
        if len(whole):
            runs = np.lib.stride_tricks.sliding_window_view(order, o.run)
            least = np.concatenate([runs[part].argmin(axis=1) + part for part in np.array_split(whole, len(whole) // (4 * ROWS) + 1)])
            # Places of runs ascend, and so do those of their least windows.
            window, at = np.unique(least, return_index=True)
            lowest, highest = whole[at], whole[np.append(at[1:], len(whole)) - 1]
    # Lines with enough words.
    line, words_in = np.unique(in_line, return_index=True)[1], np.bincount(in_line)
    words_in = words_in[words_in > 0]
    long = words_in >= o.min_words
    line, line_end = line[long], (line + words_in)[long]
    at = np.arange(max(0, n - o.shingle + 1))
    return _Paragraphs(
        doc_start, words, window, first.of(window, window + WINDOW), lowest, highest, second,
        line, line_end, (first.of(line, line_end), second.of(line, line_end)), first.of(at, at + o.shingle),
    )


def _shingles_of(p: _Paragraphs, o: Options) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of all long lines, one line after the other, and where each line's begin."""
    count = p.line_end - p.line - o.shingle + 1
    offset = np.concatenate([[0], np.cumsum(count)])
    place = np.arange(offset[-1]) - np.repeat(offset[:-1], count) + np.repeat(p.line, count)
    return p.shingles[place], offset


def _bands(p: _Paragraphs, o: Options) -> np.ndarray:
    """A row of band values per long line."""
    bands, rows = tuned_bands(o.similarity, o.recall)
    out = np.zeros((len(p.line), bands), np.uint64)
    if not len(p.line):
        return out
    values, offset = _shingles_of(p, o)
    factors = np.random.default_rng(o.seed).integers(1, 2**63, 2 * bands * rows, dtype=np.uint64)
    for k in range(bands * rows):
        least = np.minimum.reduceat(values * (factors[2 * k] << np.uint64(1) | np.uint64(1)) + factors[2 * k + 1], offset[:-1])
        out[:, k // rows] = _mixed(out[:, k // rows] * _A + least)
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


_FIRST = "kind int, k1 long, k2 long, doc_id long, text_key long, start long, bands binary"


def _named(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _each_chunk(batches: Iterator[pa.RecordBatch], o: Options) -> Iterator[tuple[_Paragraphs, np.ndarray, np.ndarray]]:
    for batch in batches:
        ids, keys = (plain(batch.column(name)).to_numpy(zero_copy_only=False) for name in ("doc_id", "text_key"))
        at = 0
        for texts in chunks(plain(batch.column("text")), BYTES):
            yield _paragraphs(texts, o), ids[at: at + len(texts)], keys[at: at + len(texts)]
            at += len(texts)
        give_back()


def _found(docs: DataFrame, o: Options) -> DataFrame:
    """Every paragraph by its key: windows are kind 0, lines kind 1 with their place and bands."""
    names = [c.split()[0] for c in _FIRST.split(", ")]

    def run(batches):
        for p, ids, keys in _each_chunk(batches, o):
            bands = _bands(p, o)
            # Windows are only counted, once per document.
            own = np.ones(len(p.window), bool)
            own[p.within_documents()[0]] = False
            zero = pa.array(np.zeros(own.sum(), np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(zero), np.int32)), _signed(p.window_keys[own]), zero, zero, zero, zero, pa.nulls(len(zero), pa.binary())],
                names=names,
            )
            doc = p.doc_of(p.line)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(len(doc), np.int32)), *map(_signed, p.line_keys), pa.array(ids[doc]), pa.array(keys[doc]), pa.array(p.line - p.doc_start[doc]),
                 pa.array([row.tobytes() for row in bands], pa.binary())],
                names=names,
            )

    return _named(docs).mapInArrow(run, _FIRST)


def _bitmap(keys: DataFrame) -> np.ndarray:
    """A table of 2**TABLE_BITS bits in which the place of every key ``k1`` is set. At most that many
    bits come to the driver, whatever the number of keys."""
    place = F.shiftrightunsigned("k1", 64 - TABLE_BITS)
    words = keys.groupBy(F.shiftright(place, 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(k1, {64 - TABLE_BITS}) & 63 AS INT))")).alias("bits")
    )
    table = np.zeros(1 << (TABLE_BITS - 6), np.uint64)
    got = words.toArrow()
    table[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return table


def _may_be_in(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys >> np.uint64(64 - TABLE_BITS)
    return (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _in_table(table: np.ndarray):
    @F.arrow_udf("boolean")
    def run(keys: pa.Array) -> pa.Array:
        return pa.array(_may_be_in(table, keys.to_numpy(zero_copy_only=False).view(np.uint64)))

    return run


_SECOND = "kind int, k1 long, k2 long, doc_id long, text_key long, start long, stop long, hashes binary"


def _of_themselves(p: _Paragraphs, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ranges of passages that repeat an earlier one of their document, as few as they make; and the
    numbers of the windows all of whose passages do."""
    some = np.unique(np.concatenate(p.within_documents()))
    at, offset = p.passages(some)
    window = np.repeat(some, np.diff(offset))
    keys = [p.rolling.of(at, at + words), p.window_keys[window], p.doc_of(at)]
    order = np.lexsort((at, *keys))
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    first = at[order][np.flatnonzero(new)][np.cumsum(new) - 1][~new]
    later = at[order][~new]
    wholly = np.flatnonzero(np.bincount(window[order][~new], minlength=len(p.window)) > p.most - p.least)
    # The first occurrence itself stays whole.
    start, stop = np.maximum(later, first + words), later + words
    order = np.argsort(start, kind="stable")
    start, doc, reached = start[order], p.doc_of(later[order]), np.maximum.accumulate(stop[order])
    # A range ends where its document does, so a new one begins there at the latest.
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] > reached[:-1]) | (doc[1:] != doc[:-1])
    last = np.append(np.flatnonzero(new)[1:], len(start))[: new.sum()] - 1
    return start[new], reached[last], wholly


def _quarters(p: _Paragraphs, o: Options) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per window and part of its passages: a key of the words that all of them hold, zero where the window has none
    of them, and the first and last place where those begin that it has."""
    edge = -(-np.arange(PARTS + 1) * o.run // PARTS)
    origin = (p.window - (o.min_words - WINDOW))[:, None]
    low, high = origin + edge[:-1], origin + edge[1:] - 1
    has = (p.least[:, None] <= high) & (p.most[:, None] >= low)
    keys = _mixed(p.rolling.of(np.where(has, high, 0), np.where(has, low + o.min_words, 0)) + np.arange(PARTS, dtype=np.uint64) * _B)
    return np.where(has, keys | np.uint64(1), np.uint64(0)), np.maximum(low, p.least[:, None]), np.minimum(high, p.most[:, None])


def _again(docs: DataFrame, windows: np.ndarray, lines: np.ndarray, o: Options) -> DataFrame:
    """The paragraphs that may repeat: as kind 0 the blocks of windows, with a key of all their words and the
    keys of their quarters; as kind 1 lines with their shingles; as kind 2 the word ranges in which documents repeat themselves."""
    names = [c.split()[0] for c in _SECOND.split(", ")]

    def run(batches):
        for p, ids, keys in _each_chunk(batches, o):
            start, stop, wholly = _of_themselves(p, o.min_words)
            doc, zero = p.doc_of(start), pa.array(np.zeros(len(start), np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(start), 2, np.int32)), zero, zero, pa.array(ids[doc]), pa.array(keys[doc]), pa.array(start - p.doc_start[doc]),
                 pa.array(stop - p.doc_start[doc]), pa.nulls(len(start), pa.binary())],
                names=names,
            )
            chosen = _may_be_in(windows, p.window_keys)
            # An occurrence all of whose passages the document has before needs no other to be found.
            chosen[wholly] = False
            some = np.flatnonzero(chosen)
            start, stop = p.least[some], p.most[some] + o.min_words
            doc = p.doc_of(start)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(some), np.int32)), _signed(p.window_keys[some]), _signed(p.rolling.of(start, stop)), pa.array(ids[doc]), pa.array(keys[doc]),
                 pa.array(start - p.doc_start[doc]), pa.array(stop - p.doc_start[doc]), _rows(_quarters(p, o)[0][some])],
                names=names,
            )
            if not len(p.line):
                continue
            values, offset = _shingles_of(p, o)
            chosen = np.flatnonzero(_may_be_in(lines, p.line_keys[0]))
            doc = p.doc_of(p.line[chosen])
            sets = [np.unique(values[offset[i]: offset[i + 1]]).tobytes() for i in chosen]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(len(chosen), np.int32)), *(_signed(k[chosen]) for k in p.line_keys), pa.array(ids[doc]), pa.array(keys[doc]),
                 pa.array(p.line[chosen] - p.doc_start[doc]), pa.array(p.line_end[chosen] - p.doc_start[doc]), pa.array(sets, pa.binary())],
                names=names,
            )

    return _named(docs).mapInArrow(run, _SECOND)


def _place(*parts: np.ndarray) -> np.ndarray:
    """A hash of the numbers that name a block and where it stands."""
    out = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        out = _mixed((out ^ part.view(np.uint64)) * _A)
    return out


def _place_of(*columns: str):
    """The same as a column."""

    @F.arrow_udf("long")
    def run(k1: pa.Array, k2: pa.Array, doc: pa.Array, key: pa.Array, start: pa.Array) -> pa.Array:
        return _signed(_place(*(x.to_numpy(zero_copy_only=False) for x in (k1, k2, doc, key, start))))

    return run(*columns)


def _lists(values: np.ndarray, offset: np.ndarray) -> pa.Array:
    """Binary values that hold the numbers between the offsets."""
    return pa.Array.from_buffers(pa.binary(), len(offset) - 1, [None, pa.py_buffer((8 * offset).astype(np.int32)), pa.py_buffer(values)])


def _rows(values: np.ndarray) -> pa.Array:
    """Each row of a matrix as a binary value."""
    return _lists(np.ascontiguousarray(values), np.arange(len(values) + 1) * values.shape[1])


def _quarter_keys(blocks: DataFrame) -> DataFrame:
    """The keys of the quarters that blocks have, as ``k1``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column("hashes").to_pylist()), np.uint64)
            yield pa.RecordBatch.from_arrays([_signed(keys[keys != 0])], names=["k1"])

    return blocks.select("hashes").mapInArrow(run, "k1 long")


def _any_in_table(table: np.ndarray):
    @F.arrow_udf("boolean")
    def run(hashes: pa.Array) -> pa.Array:
        keys = np.frombuffer(b"".join(hashes.to_pylist()), np.uint64).reshape(len(hashes), -1)
        return pa.array((_may_be_in(table, keys) & (keys != 0)).any(axis=1))

    return run


def _with_passages(docs: DataFrame, rows: np.ndarray, places: np.ndarray, quarters: np.ndarray, o: Options) -> DataFrame:
    """The ``quarters`` of the blocks that stand at ``places`` of some ``rows``, with a hash of each passage."""
    names = ["k1", "doc_id", "text_key", "start", "hashes"]

    def run(batches):
        for p, ids, keys in _each_chunk(batches, o):
            k2, doc = p.rolling.of(p.least, p.most + o.min_words), p.doc_of(p.least)
            start = p.least - p.doc_start[doc]
            chosen = _may_be_in(places, _place(p.window_keys, k2, ids[doc], keys[doc], start))
            keyed, first, last = _quarters(p, o)
            some, part = np.nonzero(chosen[:, None] & _may_be_in(quarters, keyed) & (keyed != 0))
            doc, first = doc[some], first[some, part]
            at, offset = _between(first, last[some, part])
            yield pa.RecordBatch.from_arrays(
                [_signed(p.window_keys[some]), pa.array(ids[doc]), pa.array(keys[doc]), pa.array(first - p.doc_start[doc]),
                 _lists(p.rolling.of(at, at + o.min_words), offset)],
                names=names,
            )

    some = _named(docs).where(_in_table(rows)(F.xxhash64("doc_id", "text_key")))
    return some.mapInArrow(run, "k1 long, doc_id long, text_key long, start long, hashes binary")


def similar_links(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that join the ``sets`` (each of distinct numbers) as all pairs with Jaccard similarity of at
    least ``similarity`` would. Every pair that could join two clusters is counted in full, over an inverted index.

    A set that is in no cluster yet leads one: it is compared with all sets. That leaves the pairs of two
    sets that lead nothing and are in different clusters; those outside the largest cluster are compared with all.
    """
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    member = np.repeat(np.arange(len(sets)), size)
    value = np.unique(np.concatenate(sets) if sets else np.empty(0, np.uint64), return_inverse=True)[1]
    rank = np.argsort(value, kind="stable")
    posted = member[rank]
    begin = np.searchsorted(value[rank], np.arange(value.max() + 2 if len(value) else 1))
    ends = np.cumsum(size)
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

    def compare(i: int) -> np.ndarray:
        mine = value[ends[i] - size[i]: ends[i]]
        count = begin[mine + 1] - begin[mine]
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin[mine], count)
        common = np.bincount(posted[place], minlength=len(sets))
        found = np.flatnonzero((common > 0) & (common >= similarity * (size + size[i] - common) - 1e-9))
        a.append(np.full(len(found), i))
        b.append(found)
        return found

    cluster = np.full(len(sets), -1)
    for i in range(len(sets)):
        if cluster[i] < 0:
            found = compare(i)
            cluster[found[cluster[found] < 0]] = i
            cluster[i] = i
    if len(sets):
        largest = np.bincount(cluster).argmax()
        for i in np.flatnonzero((cluster != np.arange(len(sets))) & (cluster != largest)):
            compare(i)
    x, y = np.concatenate(a), np.concatenate(b)
    return x[x != y], y[x != y]


def _line_links(buckets: DataFrame, lines: DataFrame, found: DataFrame, o: Options) -> DataFrame:
    """Links ``a``-``b`` of lines (by ``k1``) that are similar enough and share a bucket. The shingles of a
    line are those of its first occurrence, so that they are sent once per bucket."""
    first = lines.select(F.col("k1").alias("id"), "k2", "first.*")
    occurrences = found.where("kind = 1").select(F.col("k1").alias("id"), "k2", "doc_id", "text_key", "start", F.col("hashes").alias("shingles")).dropDuplicates(["id", "k2", "doc_id", "text_key", "start"])
    members = buckets.join(first, "id").join(occurrences, ["id", "k2", "doc_id", "text_key", "start"])
    # A large bucket is cut into blocks, and every pair of blocks is a group; small ones share a group.
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    # As many groups as a shuffle has tasks at least, so that no task has most of the small buckets.
    tasks = int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = max(tasks, -(-buckets.where(F.col("size") <= SMALL).count() // TOGETHER))
    group = F.when(F.col("size") <= SMALL, F.pmod(F.xxhash64("bucket"), F.lit(shared))).otherwise(F.col("bucket"))
    spread = members.select(
        "bucket", "id", "shingles", (F.col("size") <= SMALL).alias("small"), group.alias("group"), own.alias("own"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"),
    )
    spread = spread.select(
        "small", "group", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "bucket", "id", "shingles"
    )
    similarity = o.similarity

    def verify(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("bucket", kind="stable")
        ids, bucket = frame["id"].to_numpy(np.int64), frame["bucket"].to_numpy()
        sets = [np.frombuffer(shingles, np.uint64) for shingles in frame["shingles"]]
        edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        size = np.diff(np.append(edge, len(bucket)))
        two = edge[size == 2]
        near = similar_twos([sets[i] for i in two], [sets[i + 1] for i in two], similarity)
        x, y = [two[near]], [two[near] + 1]
        for start, n in zip(edge[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            left, right = similar_links(sets[start: start + n], similarity)
            x.append(left + start)
            y.append(right + start)
        a, b = merge_pairs(ids[np.concatenate(x)], ids[np.concatenate(y)])
        return pd.DataFrame({"a": a, "b": b})

    return spread.groupBy("small", "group", "i", "j").applyInPandas(verify, "a long, b long")


def similar_twos(left: list[np.ndarray], right: list[np.ndarray], similarity: float) -> np.ndarray:
    """For sets side by side, whether their Jaccard similarity is at least ``similarity``; all counted at once."""
    if not left:
        return np.empty(0, bool)
    sizes = [np.fromiter(map(len, side), np.int64, len(side)) for side in (left, right)]
    pair = np.concatenate([np.repeat(np.arange(len(left)), n) for n in sizes])
    value = np.concatenate([*left, *right])
    order = np.lexsort((value, pair))
    value, pair = value[order], pair[order]
    again = (value[1:] == value[:-1]) & (pair[1:] == pair[:-1])
    common = np.bincount(pair[1:][again], minlength=len(left))
    return common >= similarity * (sizes[0] + sizes[1] - common) - 1e-9


def _buckets(lines: DataFrame, o: Options, folder: str) -> DataFrame:
    """``bucket``, ``size`` and ``id`` of the lines that share a band, one bucket per set of members."""
    bands, _ = tuned_bands(o.similarity, o.recall)
    band = F.explode(F.array(*(F.struct(F.lit(i).alias("band"), F.substr("bands", F.lit(8 * i + 1), F.lit(8)).alias("value")) for i in range(bands))))
    tall = lines.select(F.col("k1").alias("id"), band.alias("b")).select("id", F.xxhash64("b.band", "b.value").alias("bucket"))
    several = tall.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(tall.join(several, "bucket"), folder, "members")
    groups = members.groupBy("bucket", "size").agg(
        F.min("id").alias("least"), F.bit_xor(F.xxhash64("id")).alias("x"), F.sum(F.shiftright(F.xxhash64("id", F.lit(1)), 24)).alias("s")
    )
    once = groups.groupBy("size", "least", "x", "s").agg(F.min("bucket").alias("bucket")).select("bucket")
    return members.join(once, "bucket")


def _passages(blocks: DataFrame, some: np.ndarray | None = None) -> DataFrame:
    """``k1``, ``k2`` and place (``doc_id``, ``text_key``, ``start``) of the passages of blocks, or of ``some`` that may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                rows = part.column("hashes").to_pylist()
                hashes = np.frombuffer(b"".join(rows), np.uint64)
                count = np.fromiter((len(r) // 8 for r in rows), np.int64, len(rows))
                row = np.repeat(np.arange(len(rows)), count)
                place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                if some is not None:
                    chosen = _may_be_in(some, hashes)
                    row, place, hashes = row[chosen], place[chosen], hashes[chosen]
                k1, doc, key, start = (part.column(name).to_numpy(zero_copy_only=False)[row] for name in ("k1", "doc_id", "text_key", "start"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1), _signed(hashes), pa.array(doc), pa.array(key), pa.array(start + place)], names=["k1", "k2", "doc_id", "text_key", "start"]
                )

    return blocks.select("k1", "doc_id", "text_key", "start", "hashes").mapInArrow(run, "k1 long, k2 long, doc_id long, text_key long, start long")


def _window_spans(docs: DataFrame, found: DataFrame, o: Options, folder: str) -> DataFrame:
    """Word ranges of the passages that repeat an earlier one of another document."""
    every = found.where("kind = 0")
    first = F.min(F.struct("doc_id", "text_key", "start")).alias("first")
    another = "doc_id <> first.doc_id OR text_key <> first.text_key"
    blocks = stored(every.groupBy("k1", "k2").agg(F.count("*").alias("n"), first), folder, "blocks")
    # Of equal blocks all but the first go as a whole.
    copied = blocks.where("n > 1").select("k1", "k2", "first")
    may_be_copied = _in_table(_bitmap(copied.select(F.col("k2").alias("k1"))))
    whole = every.where(may_be_copied("k2")).select("k1", "k2", "doc_id", "text_key", "start", "stop").join(copied, ["k1", "k2"])
    whole = whole.where(another).select("doc_id", "text_key", "start", "stop")
    # The first ones of different blocks of a window may still share passages, if they share a quarter.
    several = _bitmap(blocks.groupBy("k1").agg(F.count("*").alias("n")).where("n > 1"))
    leading = _bitmap(blocks.where(_in_table(several)("k1")).select(_place_of("k1", "k2", "first.doc_id", "first.text_key", "first.start").alias("k1")))
    place = _place_of("k1", "k2", "doc_id", "text_key", "start")
    members = every.where(_in_table(leading)(place))
    shared = _bitmap(_quarter_keys(members).groupBy("k1").agg(F.count("*").alias("n")).where("n > 1"))
    likely = members.where(_any_in_table(shared)("hashes")).select(place.alias("place"), F.xxhash64("doc_id", "text_key").alias("row"))
    likely = stored(likely, folder, "likely")
    places, rows = (_bitmap(likely.select(F.col(name).alias("k1"))) for name in ("place", "row"))
    members = stored(_with_passages(docs, rows, places, shared, o), folder, "members-of-windows")
    repeated = _passages(members).groupBy("k1", "k2").agg(F.count("*").alias("n"), first).where("n > 1").select("k1", "k2", "first")
    repeated = stored(repeated, folder, "passages")
    again = _passages(members, _bitmap(repeated.select(F.col("k2").alias("k1")))).join(repeated, ["k1", "k2"])
    single = again.where(another).select("doc_id", "text_key", "start", (F.col("start") + o.min_words).alias("stop"))
    return whole.union(single)


def _line_spans(found: DataFrame, distinct: DataFrame, links: DataFrame, folder: str) -> DataFrame:
    """Word ranges of the lines of a cluster or of equal lines, but for the first."""
    clusters = components(links, folder, "lines")
    named = distinct.join(clusters, F.col("k1") == F.col("node"), "left").select("k1", "k2", "n", "first", F.coalesce("component", "k1").alias("cluster"))
    stays = named.groupBy("cluster").agg(F.min("first").alias("kept"), F.sum("n").alias("n")).where("n > 1").select("cluster", "kept")
    members = named.join(stays, "cluster").select("k1", "k2", "kept")
    lines = found.where("kind = 1").select("k1", "k2", "doc_id", "text_key", "start", "stop").join(members, ["k1", "k2"])
    return lines.where("doc_id <> kept.doc_id OR text_key <> kept.text_key OR start <> kept.start").select("doc_id", "text_key", "start", "stop")


def _merged(spans: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Overlapping or touching ranges as one; those of fewer than ``least`` words are left out."""
    out: list[list[int]] = []
    for start, stop in spans[np.argsort(spans[:, 0], kind="stable")].tolist():
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out if b - a >= least]


def repeated_spans(docs: DataFrame, options: Options | None = None, folder: str | None = None) -> DataFrame:
    """``doc_id``, ``text_key`` (``xxhash64`` of the text) and ``spans`` (array of start and stop, words from 0)
    of what is to be removed."""
    o, folder = options or Options(), folder or work_folder(docs.sparkSession)
    first = F.min(F.struct("doc_id", "text_key", "start")).alias("first")
    keyed = _found(docs, o).groupBy("kind", "k1", "k2").agg(F.count("*").alias("n"), first, F.max("bands").alias("bands"))
    keyed = stored(keyed.where("kind = 1 OR n > 1"), folder, "paragraphs")
    windows, lines = keyed.where("kind = 0"), keyed.where("kind = 1")
    buckets = stored(_buckets(lines, o, folder), folder, "buckets")
    wanted = buckets.select(F.col("id").alias("k1")).union(lines.where("n > 1").select("k1"))
    repeating = _bitmap(wanted)
    found = stored(_again(docs, _bitmap(windows), repeating, o), folder, "again")
    lines = lines.where(_in_table(repeating)("k1"))
    links = _line_links(buckets, lines, found, o)
    own = found.where("kind = 2").select("doc_id", "text_key", "start", "stop")
    spans = _window_spans(docs, found, o, folder).union(_line_spans(found, lines, links, folder)).union(own)
    least = o.min_words

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            merged = [_merged(np.array([(s["start"], s["stop"]) for s in spans], np.int64), least) for spans in f["spans"]]
            rows = [(d, k, [{"start": a, "stop": b} for a, b in m]) for d, k, m in zip(f["doc_id"], f["text_key"], merged, strict=True) if m]
            yield pd.DataFrame(rows, columns=["doc_id", "text_key", "spans"])

    by_doc = spans.distinct().groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return stored(by_doc.mapInPandas(merge, "doc_id long, text_key long, spans array<struct<start: long, stop: long>>"), folder, "spans")


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and the white space after them."""
    places = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out, at = [], 0
    for start, stop in spans:
        out.append(text[at: places[start]])
        at = places[stop]
    return "".join([*out, text[at:]])


def remove_repeats(
    docs: DataFrame, options: Options | None = None, folder: str | None = None, spans_column: str | None = None
) -> DataFrame:
    """The rows of ``docs`` with repeated paragraphs cut out of ``text``, and with what was cut where a
    ``spans_column`` is named (null for nothing). A text that is all repeats stays as an empty one."""
    if spans_column in docs.columns:
        raise ValueError(f"the table has a column {spans_column} of its own")
    own, key = spans_column or "spans", "text_key"
    while own in docs.columns:
        own += "_"
    while key in (*docs.columns, own):
        key += "_"
    spans = repeated_spans(docs, options, folder).withColumnsRenamed({"spans": own, "text_key": key})
    table = _bitmap(spans.select(F.xxhash64("doc_id", key).alias("k1")))

    @F.arrow_udf("string")
    def without(texts: pa.Array, spans: pa.Array) -> pa.Array:
        rows = zip(texts.to_pylist(), spans.to_pylist(), strict=True)
        left = pa.array([cut(t, [(s["start"], s["stop"]) for s in found]) if t and found else t for t, found in rows], pa.string())
        give_back()
        return left

    # Texts that surely have none stay where they are; the others are shuffled to their spans.
    text_key = F.xxhash64(F.col("text").cast("string"))
    touched = _in_table(table)(F.xxhash64(F.col("doc_id").cast("long"), text_key))
    joined = docs.where(touched).withColumn(key, text_key).join(spans, ["doc_id", key], "left").drop(key).withColumn("text", without(F.col("text").cast("string"), own))
    rest = docs.where(~touched).withColumn(own, F.lit(None).cast(spans.schema[own].dataType))
    columns = [*docs.columns, own] if spans_column else docs.columns
    return joined.unionByName(rest).select(*(f"`{name}`" for name in columns))
