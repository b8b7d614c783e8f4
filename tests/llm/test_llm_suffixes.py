"""Suffix orders and the removal of repeated bytes against plain Python."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from partloom.llm import suffix_dedup
from partloom.llm.lyndon_order import suffix_orders


def test_orders_equal_sorted_suffixes():
    pick = random.Random(4)
    for trial in range(120):
        letters = b"abc"[: pick.randint(1, 3)]
        strings = [bytes(pick.choice(letters) for _ in range(pick.randint(0, 40))) * pick.randint(1, 4) for _ in range(pick.randint(1, 9))]
        strings += [b"", b"a" * 70, b"ab" * 30, b"ba" * 30, bytes(range(60, 0, -1)), bytes(range(60))]
        places = np.cumsum([0] + [len(s) for s in strings])
        order = suffix_orders(np.frombuffer(b"".join(strings), np.uint8), places)
        for text, a, b in zip(strings, places, places[1:]):
            assert (order[a:b] - a).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_no_strings():
    assert len(suffix_orders(np.empty(0, np.uint8), np.array([0]))) == 0
    assert len(suffix_orders(np.empty(0, np.uint8), np.array([0, 0, 0]))) == 0


def brute(rows, width):
    texts = [(text or "").encode() for _, text in rows]
    seen = Counter(t[i: i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts):
        gone = [False] * len(t)
        for i in range(len(t) - width + 1):
            if seen[t[i: i + width]] > 1:
                gone[i: i + width] = [True] * width
        spans, at = [], 0
        while at < len(t):
            stop = at
            while stop < len(t) and gone[stop]:
                stop += 1
            if stop > at:
                spans.append((at, stop))
            at = max(stop, at + 1)
        out.append((doc_id, len(t), spans, bytes(c for c, g in zip(t, gone) if not g)))
    return sorted(map(repr, out))


def result(frame):
    assert frame.columns == ["doc_id", "n_bytes", "spans", "kept"]
    return sorted(repr((r[0], r[1], [tuple(s) for s in r[2]], bytes(r[3]))) for r in frame.collect())


def made(seed, width):
    """Texts with shared passages around and above the width, runs of one letter, and copies."""
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice("abcdeéß日 \n") for _ in range(pick.randint(2, 9)))
    passages = ["".join(word() for _ in range(n)) for n in (3, 8, 12, 20, 40)]
    passages += ["x" * (width - 1), "x" * width, "x" * (3 * width), "xy" * width]
    rows = []
    for i in range(60):
        parts = [pick.choice(passages) if pick.random() < 0.4 else "".join(word() for _ in range(pick.randint(1, 30))) for _ in range(pick.randint(1, 5))]
        rows.append((i, "".join(parts)))
    return rows + [(None, rows[3][1]), (3, rows[3][1]), (3, rows[4][1]), (70, None), (71, ""), (72, None), (73, "z" * (width - 1)), (74, "y" * (width + 1))]


@pytest.mark.parametrize("width,gram,most", [(60, 20, 64), (60, 20, 1), (50, 49, 2), (33, 8, 3)])
def test_equals_plain_python(spark, width, gram, most):
    rows = made(width + most, width)
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *(F.lit("mine").alias(c) for c in "key content at n spans kept found".split()))
    assert result(suffix_dedup.remove_repeats(docs.repartition(4), width, gram, most)) == brute(rows, width)


def test_one_passage_in_many_texts(spark):
    """A hot key: the passage's surroundings differ in every text."""
    pick = random.Random(8)
    letters = lambda n: "".join(pick.choice("abcdefgh ") for _ in range(n))
    passage = letters(150)
    rows = [(i, letters(pick.randint(0, 80)) + passage + letters(pick.randint(0, 80))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (64, 1000):
        assert result(suffix_dedup.remove_repeats(docs, 100, 30, most)) == brute(rows, 100)


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_PIECE", 500)
    pick = random.Random(2)
    text = "".join(pick.choice("abcd") for _ in range(1700))
    rows = [(1, text + "e" + text[200:900]), (2, text[100:1650]), (3, "aé" * 900)]
    found = suffix_dedup.pieces(pa.array([r[1] for r in rows]), 100)
    assert sum(len(p[1]) > 500 + 99 for p in found) == 0
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(suffix_dedup.remove_repeats(docs, 100, 30)) == brute(rows, 100)


def test_documents_equal_plain_python(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert result(suffix_dedup.remove_repeats(docs)) == brute(rows, 200)


def test_empty_table_and_options(spark):
    none = spark.createDataFrame([], "doc_id string, text string")
    assert suffix_dedup.remove_repeats(none).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(none, min_bytes=20, gram=20)


def test_ids_may_be_strings(spark):
    docs = spark.createDataFrame([("a", "q" * 300), ("b", "q" * 250), ("c", "other")], "doc_id string, text string")
    assert result(suffix_dedup.remove_repeats(docs)) == brute([("a", "q" * 300), ("b", "q" * 250), ("c", "other")], 200)


def test_lone_classes_are_not_ordered(monkeypatch):
    ordered = []
    repeats_in = suffix_dedup.repeats_in
    monkeypatch.setattr(suffix_dedup, "repeats_in", lambda shards, width: ordered.extend(shards) or repeats_in(shards, width))
    text = bytes(range(30))
    held = [(1, [10], [(text, 21, 2)]), (2, [20], [(text, 21, 1)]), (3, [30, 31], [(text, 21, 1), (text[5:], 16, 1)])]
    rows = [tuple(row.values()) for batch in suffix_dedup.answers(held, 10) for row in batch.to_pylist()]
    assert sorted(rows) == [(1, 10, 0, 21), (3, 30, 5, 21), (3, 31, 0, 16)]
    assert ordered == [held[2][2]]
    assert not list(suffix_dedup.answers(held[1:2], 10))


def test_windows_of_an_occurrence_differ():
    pick = random.Random(8)
    for _ in range(200):  # periodic bytes, of which a text has the same windows at many places
        parts = [bytes(pick.choices(b"ab", k=pick.randint(1, 9))) * pick.randint(1, 30) for _ in range(5)]
        data = np.frombuffer(b"".join(parts), np.uint8)
        for at, n in zip(*suffix_dedup.occurrences(data, np.array([0, len(data)]), 20, 9)[1:3]):
            windows = [data[i: i + 20].tobytes() for i in range(at, at + n)]
            assert len(set(windows)) == n
