"""Words that are one edit from a far commoner word, found by generated edits and Bloom filters.

The vocabulary (words of at least ``least_letters`` letters that occur ``least_count`` times) is held in
blocked Bloom filters, one shard per length in letters, which every task gets. Every word is edited: each
letter left out and looked up among the words one letter shorter, each letter replaced by every later letter of
the vocabulary's alphabet and looked up among the words of its length. A pair one insertion apart is the
pair one deletion apart seen from the longer word, and a replacement is seen from the word with the
earlier letter, so every unordered pair is generated once. Edits are never spelled out for the look-up: a
word's hash is a sum over its letters, and an edit changes a few terms. Only hits become strings; they
meet the vocabulary in a join by word, which removes the false ones.

The filters hold at most ``filter_bytes`` in all, whatever the vocabulary: beyond ``BITS`` bits a word
more probes hit by chance and are refused by the join, so the result stays as it is. Words are counted
in a partial aggregate, so a frequent word is no hot key; a word has at most as many near words as edits.

Defined results: a null text has no words; a null id counts as the empty text in the keyed deletion; repeated
rows count as often as they come; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partloom.llm.common import chunks, is_empty, plain, stored, work_folder
from partloom.llm.runs import crcs, lowered, runs, text_bytes

#: Bits of a filter per word, and of those the ones a word sets within its block of 64.
BITS, SET = 24, 5
#: Most bytes of all filters together.
FILTER_BYTES = 32 << 20
#: Distinct words of a task that are counted before they go to the shuffle.
_HELD = 200_000
#: Edits that are looked up at once.
_PROBES = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


# --- the vocabulary ------------------------------------------------------------


def _in_word(data: np.ndarray) -> np.ndarray:
    """Bytes of A to Z, a to z and U+00C0 to U+00FF, which are C3 80 to C3 BF."""
    folded = data | np.uint8(32)
    inside = ((folded >= 97) & (folded <= 122)) | (data == 0xC3)
    inside[1:] |= data[:-1] == 0xC3
    return inside


def words_of(ids: pa.Array, texts: pa.Array, least_letters: int, drop_one_in: int) -> pa.Array:
    """The words of the texts, each occurrence, after the keyed deletion."""
    data, places = text_bytes(texts)
    data = lowered(data)
    owner, start, length = runs(_in_word(data), places)
    letters = length - np.diff(np.concatenate([[0], np.cumsum(data == 0xC3)])[np.stack([start, start + length])], axis=0)[0]
    long_enough = letters >= least_letters
    owner, start, length, letters = (a[long_enough] for a in (owner, start, length, letters))
    heads, ends = text_bytes(pc.binary_join_element_wise(pc.fill_null(ids.cast(pa.string()), ""), "", ":"))
    key = crcs(heads, ends[:-1], np.diff(ends))
    hashed = crcs(data, start, length, key[owner])
    cut = hashed % drop_one_in == 0
    changed = []
    for i in np.flatnonzero(cut).tolist():
        if letters[i] > least_letters:
            word = data[start[i]: start[i] + length[i]].tobytes().decode()
            at = int(hashed[i]) % len(word)
            changed.append(word[:at] + word[at + 1:])
    start, length = start[~cut], length[~cut]
    offsets = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])
    index = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], length)
    kept = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[index])))
    return pa.chunked_array([kept, pa.array(changed, pa.large_string())])


def vocabulary(docs: DataFrame, least_letters: int = 6, least_count: int = 5, drop_one_in: int = 199) -> DataFrame:
    """``word`` and ``n``: the words that occur often enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.StructArray] = []

        def counted() -> pa.Table:
            together = pa.table({"word": pa.chunked_array([h.field(0) for h in held]), "n": pa.chunked_array([h.field(1) for h in held])})
            held.clear()
            summed = together.group_by("word").aggregate([("n", "sum")])
            return pa.table({"word": summed["word"].cast(pa.string()), "n": summed["n_sum"]}).combine_chunks()

        for batch in batches:
            ids, texts = plain(batch.column("doc_id")), plain(batch.column("text"))
            at = 0
            for part in chunks(texts):
                held.append(words_of(ids.slice(at, len(part)), part, least_letters, drop_one_in).value_counts())
                at += len(part)
                if sum(map(len, held)) > _HELD:
                    together = counted()
                    if len(together) * 2 > _HELD:
                        yield from together.to_batches()
                    else:
                        one = together.to_batches()[0]
                        held.append(pa.StructArray.from_arrays([one.column(0).cast(pa.large_string()), one.column(1)], ["word", "n"]))
        if held:
            yield from counted().to_batches()

    slim = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = slim.mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# --- filters ---------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _ODD, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _term(letter: np.ndarray) -> np.ndarray:
    return _mixed(letter.astype(np.uint64) + np.uint64(1))


def _letters(words: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(word.encode("utf-32-le"), np.uint32) for word in words.to_pylist()]


class Blocks:
    """Blocked Bloom filters: a word of so many letters has one block of 64 bits in its length's shard."""

    def __init__(self, sizes: dict[int, int], filter_bytes: int):
        """``sizes``: how many words of each length there are."""
        wanted = {length: max(1, n * BITS // 64) for length, n in sizes.items()}
        most = max(len(wanted), filter_bytes // 8)
        share = min(1.0, most / max(1, sum(wanted.values())))
        self.blocks = {length: max(1, int(n * share)) for length, n in sorted(wanted.items())}
        self.first, at = {}, 0
        for length, n in self.blocks.items():
            self.first[length] = at
            at += n
        self.total = at

    def place(self, length: int, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block of each hash, and the bits that it sets there."""
        mixed = _mixed(hashed)
        block = self.first[length] + ((mixed >> np.uint64(32)) * np.uint64(self.blocks[length]) >> np.uint64(32)).astype(np.int64)
        mask = np.zeros(len(mixed), np.uint64)
        for k in range(SET):
            mask |= np.uint64(1) << ((mixed >> np.uint64(6 * k)) & np.uint64(63))
        return block, mask


def filled(words: DataFrame, shape: Blocks) -> np.ndarray:
    """The filters with all words in; at most ``shape.total`` blocks come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spelled = _letters(plain(batch.column("word")))
            size = np.array([len(s) for s in spelled])
            for length in np.unique(size).tolist():
                codes = np.stack([s for s in spelled if len(s) == length])
                block, mask = shape.place(length, (_term(codes) * _powers(length)).sum(axis=1, dtype=np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(mask.view(np.int64))], names=["block", "mask"])

    rows = words.select("word").mapInArrow(run, "block long, mask long").groupBy("block").agg(F.bit_or("mask").alias("mask"))
    out = np.zeros(shape.total, np.uint64)
    for block, mask in rows.collect():
        out[block] = mask & 0xFFFFFFFFFFFFFFFF
    return out


# --- edits -----------------------------------------------------------------------


def hits(codes: np.ndarray, alphabet: np.ndarray, shape: Blocks, bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Edits of words of one length that the filters may hold: word, place, and the code put there (-1: left out)."""
    n, length = codes.shape
    power = _powers(length)
    terms = _term(codes) * power
    whole = terms.sum(axis=1, dtype=np.uint64)
    if length - 1 in shape.first:
        # Letters behind the gap move one place to the front.
        front = np.concatenate([np.zeros((n, 1), np.uint64), np.cumsum(terms, axis=1, dtype=np.uint64)[:, :-1]], axis=1)
        moved = _term(codes[:, 1:]) * power[:-1]
        behind = np.zeros((n, length), np.uint64)
        behind[:, :-1] = np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
        block, mask = shape.place(length - 1, (front + behind).ravel())
        found = np.flatnonzero(bits[block] & mask == mask)
        yield found // length, found % length, np.full(len(found), -1)
    put = _term(alphabet)
    for at in range(length):
        rest = whole - terms[:, at]
        block, mask = shape.place(length, (rest[:, None] + put * power[at]).ravel())
        found = (bits[block] & mask == mask).reshape(n, len(alphabet)) & (alphabet > codes[:, at, None])
        word, letter = np.nonzero(found)
        yield word, np.full(len(word), at), alphabet[letter].astype(np.int64)


def probed(words: DataFrame, alphabet: np.ndarray, shape: Blocks, bits: np.ndarray) -> DataFrame:
    """``word``, ``n`` and each ``edit`` of it that may be a word."""
    shared = words.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = plain(batch.column("word")), plain(batch.column("n"))
            texts, spelled = words.to_pylist(), _letters(words)
            size = np.array([len(s) for s in spelled])
            for length in np.unique(size).tolist():
                members = np.flatnonzero(size == length)
                step = max(1, _PROBES // (length + len(alphabet)))
                for at in range(0, len(members), step):
                    some = members[at: at + step]
                    source, edits = [], []
                    for word, place, put in hits(np.stack([spelled[i] for i in some]), alphabet, shape, shared.value):
                        for w, p, c in zip(word.tolist(), place.tolist(), put.tolist(), strict=True):
                            text = texts[some[w]]
                            source.append(some[w])
                            edits.append(text[:p] + ("" if c < 0 else chr(c)) + text[p + 1:])
                    picked = pa.array(source, pa.int64())
                    yield pa.RecordBatch.from_arrays([words.take(picked), n.take(picked), pa.array(edits, pa.string())], names=["word", "n", "edit"])

    # A small vocabulary is still a lot of edits: its words are dealt to as many tasks as a shuffle has.
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return words.select("word", "n").repartition(tasks, "word").mapInArrow(run, "word string, n long, edit string")


def near_pairs(words: DataFrame, folder: str, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Every pair of words one edit apart, seen from both: ``word``, ``n``, ``other``, ``other_n``."""
    sizes = {row[0]: row[1] for row in words.groupBy(F.char_length("word")).count().collect()}  # a row per length
    letter = F.explode(F.array_distinct(F.split("word", "")))
    spelled = words.select(letter.alias("letter")).distinct().where("letter <> ''").collect()  # a row per letter there is
    alphabet = np.array(sorted(ord(row[0]) for row in spelled), np.uint32)
    shape = Blocks(sizes, filter_bytes)
    found = probed(words, alphabet, shape, filled(words, shape)).distinct()
    true = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = stored(found.join(true, F.col("edit") == F.col("other")).select("word", "n", "other", "other_n"), folder, "pairs")
    back = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return pairs.unionByName(back)


def groups(
    docs: DataFrame,
    least_letters: int = 6,
    least_count: int = 5,
    drop_one_in: int = 199,
    ratio: int = 5,
    filter_bytes: int = FILTER_BYTES,
    folder: str | None = None,
) -> DataFrame:
    """Every word with the commoner word it is a variant of.

    ``word``, ``n``, ``n_near`` (words one edit away), ``form`` (the commonest of those, the first in code-point
    order among equals, if it comes at least ``ratio`` times as often; else null), ``form_n`` and ``root``
    (the end of the chain of forms).
    """
    folder = folder or work_folder(docs.sparkSession)
    words = stored(vocabulary(docs, least_letters, least_count, drop_one_in), folder, "words")
    best = F.min(F.struct((-F.col("other_n")).alias("rarity"), F.col("other").alias("form")))
    near = near_pairs(words, folder, filter_bytes).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    common = -F.col("best.rarity") >= F.col("n") * ratio
    told = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(common, F.col("best.form")).alias("form"), F.when(common, -F.col("best.rarity")).alias("form_n"),
    )
    told = stored(told, folder, "told")
    ends = roots(told.where("form IS NOT NULL").select("word", F.col("form").alias("root")), folder)
    return told.join(ends, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )


def roots(steps: DataFrame, folder: str) -> DataFrame:
    """``word`` and the ``root`` its chain ends at. Counts grow by a factor along a chain, so chains are short,
    and each round halves them."""
    steps, number = stored(steps, folder, "steps-0"), 0
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = steps.join(further, "root", "left")
        if is_empty(joined.where("beyond IS NOT NULL")):
            return steps
        number += 1
        steps = stored(joined.select("word", F.coalesce("beyond", "root").alias("root")), folder, f"steps-{number}")
