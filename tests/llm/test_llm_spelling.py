"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from partloom.llm import spelling_variants


def vocabulary_of(rows, least_letters=6, least_count=5, drop_one_in=199):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % drop_one_in == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= least_letters and n >= least_count}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, **options):
    words = vocabulary_of(rows, **options)
    forms, counted = {}, {}
    for word, n in words.items():
        others = [o for o in words if near(word, o)]
        counted[word] = len(others)
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best is not None and words[best] >= 5 * n:
            forms[word] = best
    out = []
    for word, n in words.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        out.append((word, n, counted[word], form, words.get(form), root))
    return sorted(out, key=repr)


def found(frame):
    assert frame.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def made(seed):
    """Words with chains of variants, repeated letters and letters beyond ASCII."""
    pick = random.Random(seed)
    base = ["banana", "aaaaaa", "abcdefgh", "straßen", "Éclair", "naïveté", "ÿÿÿÿÿÿ", "zyxwvuts", "short"]
    weighted = []
    for word in base:
        for times in (240, 45, 8, 6):
            weighted += [word] * times
            at = pick.randrange(len(word))
            word = pick.choice([word[:at] + word[at + 1:], word[:at] + pick.choice("axzéÿ") + word[at:], word[:at] + pick.choice("bqÀ") + word[at + 1:]])
    pick.shuffle(weighted)
    return [(i // 7 if i % 11 else None, " ".join(weighted[i: i + 9]) + " 日本 x9") for i in range(0, len(weighted), 9)] + [
        (3, None), (4, ""), (5, "×÷" * 4 + "-Ħello"), (6, "y" * 60_000), (6, ("y" * 60_000 + " ") * 5)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_python(spark, seed):
    rows = made(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'mine' AS word", "1 AS n", "2 AS form", "3 AS root")
    expected = brute(rows)
    assert found(spelling_variants.groups(docs.repartition(3))) == expected
    assert any(r[3] for r in expected) and any(r[5] != r[3] and r[3] for r in expected)


def test_filters_that_are_too_small_change_nothing(spark):
    rows = made(9)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(spelling_variants.groups(docs, filter_bytes=8)) == brute(rows)


def test_deleted_letters(spark):
    rows = [(i, f"letters{'ab'[i % 2]}x wordléss another") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(spelling_variants.groups(docs, drop_one_in=3))
    assert got == brute(rows, drop_one_in=3) and any(r[3] for r in got)


def test_empty_table(spark):
    assert spelling_variants.groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_documents_equal_plain_python(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    assert found(spelling_variants.groups(docs)) == brute([tuple(r) for r in docs.collect()])


def test_filters_hold_every_word(spark):
    words = spark.createDataFrame([(f"wörd{i:05d}é",) for i in range(3000)], "word string")
    shape = spelling_variants.Blocks({10: 3000, 11: 1}, 1 << 20)
    bits = spelling_variants.filled(words, shape)
    codes = np.stack([np.array([ord(c) for c in r[0]], np.uint32) for r in words.collect()])
    hashed = (spelling_variants._term(codes) * spelling_variants._powers(10)).sum(axis=1, dtype=np.uint64)
    block, mask = shape.place(10, hashed)
    assert (bits[block] & mask == mask).all()
    block, mask = shape.place(10, hashed + np.uint64(1))
    assert (bits[block] & mask == mask).mean() < 0.02
