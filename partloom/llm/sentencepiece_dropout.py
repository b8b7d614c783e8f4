"""SentencePiece BPE with seeded merge-dropout: varied segmentations that decode to the same text.

The vocabulary is a SentencePiece BPE model with byte pieces. A text becomes symbols (spaces as ``▁``,
one put before the text), and an agenda holds the candidate merges of neighbouring symbols by
score, then place. Each candidate that is taken from the agenda is skipped if a keyed hash says so:
of the seed, the document, the word's place in it, and the two places and pieces, never of a running
generator, so a rerun task gives the same pieces. Without dropout the pieces are SentencePiece's own.

No piece of the vocabulary holds ``▁`` after another character, so merges never cross into the next
word: texts are cut before each run of ``▁``. Each occurrence of a word has draws of its own. A different
word is segmented once without dropout, with a list of its merges; an occurrence that skips none of
them has that segmentation, and only the others go through the agenda. Where ``variants`` are given,
an occurrence has one of so many draws instead.

Decoding is exact: pieces without a vocabulary entry are spelled in bytes, and so is a ``▁`` that the text itself
holds. Defined results: a null text has null pieces; an empty text has none; ids may be null or
repeat; extra columns are ignored by ``encode``; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partloom.llm.common import chunks, plain

SPACE = "\u2581"
#: Different words that are segmented at once, and bytes of text that are encoded at once.
TOGETHER, BYTES = 50_000, 2_000_000
# Words of more characters than the last are segmented alone.
_WIDTHS = (2, 4, 6, 8, 10, 12, 16, 24, 32, 64, 128, 256)
#: Ids from here on stand for a character (its code point more) that no piece spells.
_CHARACTER = 1 << 20
_SHIFT = 22
_NONE = np.int32(2**31 - 1)


# The merges stand in an open hash table of this many slots, less one.
_SLOTS = (1 << 19) - 1


def _slot(key: np.ndarray) -> np.ndarray:
    return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(45)).astype(np.int64)


@dataclass(frozen=True)
class Vocabulary:
    """A model as tables: ids of the mergeable pieces, of byte pieces and of characters, every id's bytes,
    and for each pair of ids that merges the merged id and its rank (equal scores have equal ranks)."""

    pieces: dict[str, int]
    byte_ids: list[int]
    spelled: list[bytes]
    of_character: np.ndarray
    pairs: np.ndarray
    merged: np.ndarray
    rank: np.ndarray
    inner: np.ndarray  # pairs of characters that follow each other in some piece, as sorted numbers

    @cached_property
    def merges(self) -> dict[int, tuple[int, int]]:
        """Rank and merged id by pair, for merges that are looked up one by one."""
        held = np.flatnonzero(self.pairs >= 0)
        return dict(zip(self.pairs[held].tolist(), zip(self.rank[held].tolist(), self.merged[held].tolist(), strict=True), strict=True))

    def crossing(self, points: np.ndarray) -> np.ndarray:
        """For each character but the last, whether a piece may reach from it to the next one."""
        key = points[:-1].astype(np.int64) * 0x110000 + points[1:]
        at = np.minimum(np.searchsorted(self.inner, key), len(self.inner) - 1)
        return self.inner[at] == key if len(self.inner) else np.zeros(len(key), bool)

    def merge(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The merged id and rank of neighbours; no rank where they do not merge."""
        key = left.astype(np.int64) << _SHIFT | right
        slot = _slot(key)
        found = self.pairs[slot]
        # Few keys share a slot with another; those look on.
        lost = np.nonzero((found != key) & (found >= 0))
        while len(lost[0]):
            slot[lost] = (slot[lost] + 1) & _SLOTS
            found = self.pairs[slot[lost]]
            lost = tuple(x[(found != key[lost]) & (found >= 0)] for x in lost)
        return self.merged[slot], np.where(self.pairs[slot] == key, self.rank[slot], _NONE)


@lru_cache(maxsize=2)
def vocabulary(model_file: str) -> Vocabulary:
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = model.get_piece_size()
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if not all(model.is_byte(i) for i in byte_ids):
        raise ValueError("the vocabulary has no byte pieces")
    outside = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
    pieces = {model.id_to_piece(i): i for i in range(n) if not outside(i)}
    if crossing := [p for p in pieces if SPACE in p.lstrip(SPACE)]:
        raise ValueError(f"pieces cross words: {crossing[:3]}")
    spelled = [b""] * n
    for piece, i in pieces.items():
        spelled[i] = piece.replace(SPACE, " ").encode()
    for b, i in enumerate(byte_ids):
        spelled[i] = bytes([b])
    of_character = np.arange(0x110000, dtype=np.int32) + _CHARACTER
    for piece, i in pieces.items():
        if len(piece) == 1:
            of_character[ord(piece)] = i
    symbol = lambda text: pieces.get(text, _CHARACTER + ord(text) if len(text) == 1 else -1)
    splits = [(symbol(p[:k]), symbol(p[k:]), i) for p, i in pieces.items() for k in range(1, len(p))]
    table = np.array([x for x in splits if x[0] >= 0 and x[1] >= 0], np.int64).reshape(-1, 3)
    if len(table) > _SLOTS // 2:
        raise ValueError("the vocabulary has too many merges for the table")
    scores = np.array([model.get_score(i) for i in range(n)])
    rank = np.unique(-scores[table[:, 2]], return_inverse=True)[1].astype(np.int32)
    keys = table[:, 0] << _SHIFT | table[:, 1]
    pairs, row = np.full(_SLOTS + 1, -1, np.int64), np.zeros(_SLOTS + 1, np.int64)
    for i, slot in enumerate(_slot(keys).tolist()):
        while pairs[slot] >= 0:
            slot = (slot + 1) & _SLOTS
        pairs[slot], row[slot] = keys[i], i
    inner = {ord(a) * 0x110000 + ord(b) for piece in pieces for a, b in pairwise(piece)}
    return Vocabulary(
        pieces, byte_ids, spelled, of_character, pairs, table[row, 2].astype(np.int32), rank[row], np.array(sorted(inner), np.int64)
    )


def _skips(seed: int, variant: np.ndarray, merged: np.ndarray, left: np.ndarray, place: np.ndarray, dropout: float) -> np.ndarray:
    """Whether a candidate merge is skipped: a hash of the seed, the variant, the merge and its place."""
    u = np.uint64
    x = merged.astype(u) * u(0x9E3779B97F4A7C15) ^ left.astype(u) * u(0xC2B2AE3D27D4EB4F) ^ place.astype(u) << u(40)
    x ^= variant.astype(u) * u(0x165667B19E3779F9) ^ u((seed * 0x27D4EB2F165667C5) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> u(30))) * u(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> u(27))) * u(0x94D049BB133111EB)
    return ((x ^ (x >> u(31))) >> u(11)).astype(np.float64) < dropout * 2.0**53


_64 = (1 << 64) - 1


def _skips_one(seed: int, variant: int, merged: int, left: int, place: int, dropout: float) -> bool:
    """``_skips`` for a single candidate."""
    x = (merged * 0x9E3779B97F4A7C15 ^ left * 0xC2B2AE3D27D4EB4F) & _64
    x = (x ^ place << 40 ^ variant * 0x165667B19E3779F9 ^ seed * 0x27D4EB2F165667C5) & _64
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & _64
    x = (x ^ x >> 27) * 0x94D049BB133111EB & _64
    return (x ^ x >> 31) >> 11 < dropout * 2.0**53


def segment(word: str, v: Vocabulary, dropout: float = 0.0, seed: int = 0, variant: int = 0, offset: int = 0) -> list[int]:
    """Symbol ids of one word, its spaces written as ``\u2581``, by an agenda of candidate merges.
    ``offset`` is the place of its first character where it is a part of a longer word."""
    ids = v.of_character[np.frombuffer(word.encode("utf-32-le"), np.uint32)].tolist()
    n, variant, merges = len(ids), int(variant), v.merges
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    agenda = []
    for i in range(n - 1):
        if found := merges.get(ids[i] << _SHIFT | ids[i + 1]):
            agenda.append((found[0], i, i + 1, ids[i], ids[i + 1], found[1]))
    heapify(agenda)
    while agenda:
        _, i, j, a, b, merged = heappop(agenda)
        if ids[i] != a or after[i] != j or ids[j] != b:
            continue  # one of the two has been merged meanwhile
        if dropout and _skips_one(seed, variant, merged, a, i + offset, dropout):
            continue
        ids[i], ids[j] = merged, -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if found := merges.get(merged << _SHIFT | ids[k]):
                heappush(agenda, (found[0], i, k, merged, ids[k], found[1]))
        if (h := before[i]) >= 0 and (found := merges.get(ids[h] << _SHIFT | merged)):
            heappush(agenda, (found[0], h, i, ids[h], merged, found[1]))
    out, i = [], 0
    while i < n:
        out.append(ids[i])
        i = after[i]
    return out


def _segment_table(
    ids: np.ndarray, size: np.ndarray, v: Vocabulary, dropout: float, seed: int, variant: np.ndarray, merges: list | None = None,
    offset: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """The agendas of many short words at once: a row of ``ids`` is a word of ``size`` symbols. Every
    round takes the first candidate of each word and skips or merges it. The symbols that are left, and how many.
    ``merges`` gets the row, merged piece, left piece and place of each candidate that was taken. ``offset``:
    places of the rows' first symbols in their words."""
    n, width = ids.shape
    offset = np.zeros(n, np.int64) if offset is None else offset
    column = np.arange(width, dtype=np.int32)
    inside = column < size[:, None]
    if width < 2:
        return ids[inside], size
    # One row after the other; a pair stands where its left symbol does.
    flat = ids.reshape(-1).copy()
    merged, rank = np.zeros((n, width), np.int32), np.full((n, width), _NONE, np.int32)
    merged[:, :-1], rank[:, :-1] = v.merge(ids[:, :-1], ids[:, 1:])
    rank[column >= (size - 1)[:, None]] = _NONE
    after = np.broadcast_to(column + 1, ids.shape).reshape(-1).copy()
    before = np.broadcast_to(column - 1, ids.shape).reshape(-1).copy()
    end = size.astype(np.int32)
    flat_merged, flat_rank = merged.reshape(-1), rank.reshape(-1)
    alive = inside.reshape(-1).copy()
    row = np.arange(n)
    while len(row):
        at = rank[row].argmin(axis=1)
        place = row * width + at
        live = flat_rank[place] != _NONE
        if not live.all():
            row, at, place = row[live], at[live], place[live]
        to = flat_merged[place]
        if merges is not None:
            merges.append((row, to, flat[place], at + offset[row]))
        if dropout and len(row):
            skip = _skips(seed, variant[row], to, flat[place], at + offset[row], dropout)
            flat_rank[place[skip]] = _NONE
            kept = ~skip
            r, at, place, to = row[kept], at[kept], place[kept], to[kept]
        else:
            r = row
        base = r * width
        gone = base + after[place]
        flat[place] = to
        alive[gone] = False
        flat_rank[gone] = _NONE
        behind = after[gone]
        after[place] = behind
        more = behind < end[r]
        # Beside the merged symbol there are new pairs, or none any more.
        flat_rank[place] = _NONE
        p, q = place[more], (base + behind)[more]
        before[q] = at[more]
        flat_merged[p], flat_rank[p] = v.merge(flat[p], flat[q])
        ahead = before[place] >= 0
        p, q = (base + before[place])[ahead], place[ahead]
        flat_merged[p], flat_rank[p] = v.merge(flat[p], flat[q])
    return flat[alive], alive.reshape(n, width).sum(axis=1)


def segment_many(
    words: list[str], variants: np.ndarray, v: Vocabulary, dropout: float, seed: int, merges: list | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The piece ids of all words, one after the other, and where each word's begin (and the last ends).
    ``merges`` gets the candidates that were taken, by word number; none of words that are segmented alone."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    symbols = v.of_character[points]
    word, start, length, offset = _units(words, points, v)
    count = np.zeros(len(word), np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []  # numbers of units, and their symbols one after the other
    kind = np.searchsorted(_WIDTHS, length)
    for k, width in enumerate(_WIDTHS):
        chosen = np.flatnonzero(kind == k)
        for some in np.array_split(chosen, max(1, -(-len(chosen) * width // (TOGETHER * 8)))):
            if not len(some):
                continue
            inside = np.arange(width) < length[some][:, None]
            ids = np.where(inside, symbols[np.minimum(start[some][:, None] + np.arange(width), max(0, len(symbols) - 1))], -1)
            taken = None if merges is None else []
            ids, size = _segment_table(ids.astype(np.int32), length[some], v, dropout, seed, variants[word[some]], taken, offset[some])
            if merges is not None:
                merges += [(word[some[row]], *rest) for row, *rest in taken]
            count[some] = size
            parts.append((some, ids))
    for i in np.flatnonzero(kind == len(_WIDTHS)).tolist():
        text = points[start[i]: start[i] + length[i]].tobytes().decode("utf-32-le")
        found = np.array(segment(text, v, dropout, seed, int(variants[word[i]]), int(offset[i])), np.int32)
        count[i] = len(found)
        parts.append((np.array([i]), found))
    begin = np.concatenate([[0], np.cumsum(count)])
    flat = np.empty(begin[-1], np.int32)
    for some, ids in parts:
        n = count[some]
        flat[np.arange(len(ids)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[some], n)] = ids
    return _in_bytes(flat, begin[np.searchsorted(word, np.arange(len(words) + 1))], v)


def _units(words: list[str], points: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What is segmented by itself: its word, first character, length and place in the word. Words of more than the
    greatest width are cut wherever no piece reaches across, which no merge can tell."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(length) - length
    long = np.flatnonzero(length > _WIDTHS[-1])
    if not len(long):
        return np.arange(len(words)), start, length, np.zeros(len(words), np.int64)
    heads = [start[length > 0]]
    for i in long.tolist():
        heads.append(start[i] + 1 + np.flatnonzero(~v.crossing(points[start[i]: start[i] + length[i]])))
    empty = np.flatnonzero(length == 0)
    begin = np.unique(np.concatenate(heads))
    word = np.searchsorted(start, begin, side="right") - 1
    word = np.concatenate([word, empty])  # of words that begin at one place the last has the characters
    size = np.concatenate([np.diff(begin, append=len(points)), np.zeros(len(empty), np.int64)])
    begin = np.concatenate([begin, start[empty]])
    order = np.argsort(word, kind="stable")
    word, begin, size = word[order], begin[order], size[order]
    return word, begin, size, begin - start[word]


def _in_bytes(flat: np.ndarray, begin: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Characters that no piece spells, as byte pieces."""
    strange = flat >= _CHARACTER
    if not strange.any():
        return flat, begin
    kinds, which = np.unique(flat[strange], return_inverse=True)
    spelled = [[v.byte_ids[b] for b in chr(k - _CHARACTER).encode()] for k in kinds.tolist()]
    length = np.array([len(x) for x in spelled])
    size = np.ones(len(flat), np.int64)
    size[strange] = length[which]
    place = np.concatenate([[0], np.cumsum(size)])
    out = np.repeat(flat, size)
    # Each occurrence takes the bytes of its kind, which stand one after the other.
    n = length[which]
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    first = (np.cumsum(length) - length)[which]
    out[np.repeat(place[:-1][strange], n) + step] = np.concatenate(spelled)[np.repeat(first, n) + step]
    return out, place[begin]


# A word is a run of spaces with what follows; a block character of the text's own stands alone.
_WORDS = re.compile(rf"{SPACE}|[ ]+[^ {SPACE}]*|[^ {SPACE}]+")


class Encoder:
    """Encodes texts: each occurrence of a word with draws of its own, or, where ``variants`` are given, each
    different (word, variant) of a call once."""

    def __init__(self, model_file: str, dropout: float = 0.0, seed: int = 0, variants: int | None = None):
        self.v, self.dropout, self.seed = vocabulary(model_file), dropout, seed
        self.variants = variants if 0 < dropout < 1 else 1
        self.own_space = np.array([self.v.byte_ids[b] for b in SPACE.encode()], np.int32)

    def _variants(self, documents: list, counts: list[int]) -> np.ndarray:
        """The draw of every word, or its variant: a hash of the seed, the document's id and the word's place."""
        if self.variants == 1:
            return np.zeros(sum(counts), np.int64)
        u = np.uint64
        keys = np.array([xxhash.xxh64_intdigest(f"{self.seed}:{d}".encode()) for d in documents], u)
        counts = np.array(counts, np.int64)
        place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        x = place.astype(u) * u(0x9E3779B97F4A7C15) + np.repeat(keys, counts)
        x = (x ^ (x >> u(30))) * u(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> u(27))) * u(0x94D049BB133111EB)
        return x ^ (x >> u(31)) if self.variants is None else (x % u(self.variants)).astype(np.int64)

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
        """Pieces of words without dropout and where each word's begin; where the merges of each word begin, and
        these. Words that are segmented alone count as one that is always skipped."""
        taken: list[tuple] = []
        flat, begin = segment_many(words, np.zeros(len(words), np.int64), self.v, 0.0, self.seed, taken)
        alone = np.flatnonzero(np.fromiter(map(len, words), np.int64, len(words)) > _WIDTHS[-1])
        lost = np.full(len(alone), -1)
        word, *rest = (np.concatenate(x) for x in zip(*taken, (alone, lost, lost, lost), strict=True))
        order = np.argsort(word, kind="stable")
        return flat, begin, np.searchsorted(word[order], np.arange(len(words) + 1)), tuple(x[order] for x in rest)

    def _varied(self, kind: np.ndarray, draw: np.ndarray, first: np.ndarray, merges: tuple[np.ndarray, ...]) -> np.ndarray:
        """Numbers of the occurrences that skip a merge of their plain segmentation."""
        found = []
        for at in range(0, len(kind), TOGETHER):
            which = kind[at: at + TOGETHER]
            n = first[which + 1] - first[which]
            row = np.repeat(np.arange(len(which)), n)
            place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[which], n)
            to, left, column = (x[place] for x in merges)
            found.append(np.unique(row[(to < 0) | _skips(self.seed, draw[at + row], to, left, column, self.dropout)]) + at)
        return np.concatenate([np.empty(0, np.int64), *found])

    def encode(self, texts: list[str | None], documents: list) -> pa.ListArray:
        words, counts = [], []
        for text in texts:
            found = _WORDS.findall(" " + text) if text else []
            words += found
            counts.append(len(found))
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        kinds = coded.dictionary.to_pylist()
        if self.variants is None:
            return self._put_together(texts, offsets, *self._each(kinds, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), self._variants(documents, counts)))
        both = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * self.variants + self._variants(documents, counts)
        different, inverse = np.unique(both, return_inverse=True)
        flats, sizes = [], []
        for at in range(0, len(different), TOGETHER):
            part = different[at: at + TOGETHER]
            spelled = [kinds[i].replace(" ", SPACE) for i in (part // self.variants).tolist()]
            flat, begin = segment_many(spelled, part % self.variants, self.v, self.dropout, self.seed)
            flats.append(flat)
            sizes.append(np.diff(begin))
        flat = np.concatenate([*flats, self.own_space]) if flats else self.own_space
        size = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
        start = np.cumsum(size) - size
        if SPACE in kinds:  # a block character of the text's own is spelled in bytes
            own = different // self.variants == kinds.index(SPACE)
            start[own], size[own] = len(flat) - len(self.own_space), len(self.own_space)
        return self._put_together(texts, offsets, flat, start, size, inverse)

    def _each(self, kinds: list[str], kind: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pieces, where each segmentation begins and its size, and the segmentation of each occurrence."""
        spelled = [w.replace(" ", SPACE) for w in kinds]
        flat, begin, first, merges = self._plain(spelled)
        flats, start, size = [flat], [begin[:-1]], [np.diff(begin)]
        if SPACE in kinds:  # a block character of the text's own is spelled in bytes
            own = kinds.index(SPACE)
            flats.append(self.own_space)
            start[0], size[0] = start[0].copy(), size[0].copy()
            start[0][own], size[0][own] = len(flat), len(self.own_space)
        varied, which = self._varied(kind, draw, first, merges), kind.copy()
        for at in range(0, len(varied), TOGETHER):
            some = varied[at: at + TOGETHER]
            which[some] = sum(map(len, size)) + np.arange(len(some))
            more, begin = segment_many([spelled[i] for i in kind[some].tolist()], draw[some], self.v, self.dropout, self.seed)
            start.append(begin[:-1] + sum(map(len, flats)))
            size.append(np.diff(begin))
            flats.append(more)
        return np.concatenate(flats), np.concatenate(start), np.concatenate(size), which

    @staticmethod
    def _put_together(texts: list, offsets: np.ndarray, flat: np.ndarray, start: np.ndarray, size: np.ndarray, inverse: np.ndarray) -> pa.ListArray:
        n = size[inverse]
        ends = np.concatenate([[0], np.cumsum(n)])
        values = flat[np.arange(ends[-1]) - np.repeat(ends[:-1], n) + np.repeat(start[inverse], n)]
        missing = np.array([t is None for t in texts], bool)
        return pa.ListArray.from_arrays(
            pa.array(ends[offsets].astype(np.int32)), pa.array(values, pa.int32()), mask=pa.array(missing) if len(texts) else None
        )


def decode_ids(ids, v: Vocabulary) -> str:
    text = b"".join(map(v.spelled.__getitem__, ids)).decode()
    return text[1:] if text[:1] == " " else text


def decode_lists(pieces: pa.ListArray, v: Vocabulary) -> pa.Array:
    """The texts of many lists of ids, put together from the bytes of the pieces."""
    n = np.diff(pieces.offsets.to_numpy()).astype(np.int64)
    ids = pieces.flatten().to_numpy(zero_copy_only=False)
    valid = pieces.is_valid().to_numpy(zero_copy_only=False)
    n[~valid] = 0
    size = np.fromiter(map(len, v.spelled), np.int64, len(v.spelled))
    start = np.cumsum(size) - size
    spelled = np.frombuffer(b"".join(v.spelled), np.uint8)
    ends = np.concatenate([[0], np.cumsum(size[ids])])
    out = spelled[np.arange(ends[-1]) - np.repeat(ends[:-1], size[ids]) + np.repeat(start[ids], size[ids])]
    edge = ends[np.concatenate([[0], np.cumsum(n)])]
    # The space that was put before a text does not belong to it.
    first = edge[:-1][(np.diff(edge) > 0)]
    keep = np.ones(len(out), bool)
    keep[first[out[first] == 0x20]] = False
    lost = np.concatenate([[0], np.cumsum(~keep)])
    offsets = (edge - lost[edge]).astype(np.int64)
    mask = np.packbits(valid, bitorder="little").tobytes()
    return pa.LargeStringArray.from_buffers(len(pieces), pa.py_buffer(offsets.tobytes()), pa.py_buffer(out[keep].tobytes()), pa.py_buffer(mask))


def encode(
    docs: DataFrame, model_file: str, dropout: float = 0.1, seed: int = 1, variants: int | None = None
) -> DataFrame:
    """``doc_id`` and ``pieces`` (array of ids) of every row. ``model_file`` must be readable on every node."""
    if not 0 <= dropout <= 1 or (variants is not None and variants < 1):
        raise ValueError("dropout lies between 0 and 1, and there is at least one variant")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model_file, dropout, seed, variants)
        for batch in batches:
            at = 0
            for texts in chunks(plain(batch.column("text")), BYTES):
                ids = batch.column("doc_id").slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays([ids, encoder.encode(texts.to_pylist(), ids.to_pylist())], names=["doc_id", "pieces"])

    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, pieces array<int>")


def decoded(model_file: str) -> Callable[..., Column]:
    """A function from a column of piece ids to the text."""

    @F.arrow_udf("string")
    def run(pieces: pa.Array) -> pa.Array:
        v, parts, at = vocabulary(model_file), [], 0
        ends = np.cumsum(pc.fill_null(pc.list_value_length(pieces), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        while at < len(pieces):  # lists of bounded length together
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 1_000_000, side="right")))
            parts.append(decode_lists(pieces.take(pa.array(np.arange(at, to))), v).cast(pa.string()))
            at = to
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return run
