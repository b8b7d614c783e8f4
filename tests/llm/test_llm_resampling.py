"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from partloom.llm import crc_resampling
from partloom.llm.runs import LONGEST, crcs

ROWS = [
    (1, None), (2, ""), (3, " \t "), (4, "One ONE one two-three é 日本語 x9"), (5, "w" * 70_000), (None, "alpha beta " * 15),
    (7, "alpha beta " * 15), (7, "alpha beta " * 15), (8, "\x7f`{|}~ [\\]^_ @ / :"),
    *((100 + i, " ".join(f"w{(i * j) % 17}" for j in range(5 + i))) for i in range(60)),
]
TARGET = [(1, "alpha beta gamma w1 w2 w3 one"), (2, None), (3, "é w16 w16")]


def found_in(text, max_words):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, [" ".join(words[i: i + m]) for m in range(1, max_words + 1) for i in range(len(words) - m + 1)]


def brute(rows, target, percent, least, n_buckets, max_words, seed):
    bucket = lambda f: zlib.crc32(f.encode()) % n_buckets
    counts = []
    for side in (rows, target):
        counts.append([0] * n_buckets)
        for _, text in side:
            for f in found_in(text, max_words)[1]:
                counts[-1][bucket(f)] += 1
    held, wanted = (sum(c) + n_buckets for c in counts)
    gain = [math.floor(1000 * math.log(((t + 1) * held) / ((s + 1) * wanted))) for s, t in zip(*counts)]
    out = []
    for doc_id, text in rows:
        words, feats = found_in(text, max_words)
        weight = sum(gain[bucket(f)] for f in feats) // len(feats) if feats else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(feats), weight, score, None, len(words) >= least])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is not None, r[0]))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = rank
    return sorted(map(repr, (tuple(r[:5]) for r in out)))


@pytest.mark.parametrize("options", [(10, 20, 10_000, 1, 2024), (55, 3, 7, 3, 5), (100, 0, 100, 2, 1), (0, 20, 10, 1, 1)])
def test_equals_plain_python(spark, options):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "'mine' AS score", "1 AS rank", "2 AS part", "3 AS bucket")
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    got = crc_resampling.resample(docs.repartition(5), target, *options)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(ROWS, TARGET, *options)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert crc_resampling.resample(none, some).count() == 0
    got = crc_resampling.resample(some, none.select("text"), percent=50)
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(ROWS, [], 50, 20, 10_000, 1, 2024)


def test_matrices_give_the_crc_of_every_range():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    length = np.concatenate([np.arange(40), [LONGEST - 1, LONGEST, LONGEST + 1, 2000]])
    start = rng.integers(0, 3000, len(length))
    ranges = [data[s: s + n].tobytes() for s, n in zip(start, length)]
    assert crcs(data, start, length).tolist() == [zlib.crc32(r) for r in ranges]
    heads = [zlib.crc32(bytes([i])) for i in range(len(length))]
    assert crcs(data, start, length, np.array(heads)).tolist() == [zlib.crc32(bytes([i]) + r) for i, r in enumerate(ranges)]
    assert len(crcs(data, start[:0], length[:0])) == 0


def test_documents_equal_plain_python(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    target = spark.read.parquet(f"{sf}/benchmark.parquet")
    rows, wanted = [tuple(r) for r in docs.collect()], [tuple(r) for r in target.select("item_id", "text").collect()]
    got = crc_resampling.resample(docs, target)
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(rows, wanted, 10, 20, 10_000, 1, 2024)


def test_sliced_input():
    texts = pa.array(["skip", "a b", None, "c"]).slice(1)
    (owner, bucket), = crc_resampling.features(texts, 10_000, 1)
    assert owner.tolist() == [0, 0, 2] and bucket.tolist() == [zlib.crc32(w) % 10_000 for w in (b"a", b"b", b"c")]
