"""The stages, one after the other, against plain Python on each stage's own input."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from partloom.llm import compression_toxicity, quality_rules, simhash_trie
from partloom.llm.common import stored, work_folder
from test_llm_brute import brute_measures, brute_print, grams, least_by_reach

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(
        [(10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0), (None, "no id " * 40, "en", "s", 1), (10**6 + 2, "x" * 50_000, None, "s", 2)], docs.schema
    )
    folder = work_folder(spark)
    frames = [stored(docs.unionByName(odd).withColumn("removed_spans", F.lit("mine")), folder, "docs")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], SF), folder, name.replace(" ", "-")))
    return frames


def pairs(frame):
    return sorted(((r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()), key=repr)


def test_stages_keep_the_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "simhash near-dedup", "substring dedup", "best-fit packing"]
    for frame in steps[1:5]:
        assert frame.schema.simpleString() == steps[0].schema.simpleString()


def test_toxicity(spark, steps):
    model = compression_toxicity.fit(steps[0], spark.read.parquet(f"{SF}/labels.parquet"))
    expected = [(d, t) for d, t in pairs(steps[0]) if compression_toxicity.score_text(t, model) < 0.7]
    assert pairs(steps[1]) == expected


def test_quality(steps):
    def kept(text):
        words, chars, symbols, dup_lines, repeated = brute_measures(text)
        return words >= 10 and 100 * repeated <= 20 * words

    passed = pairs(steps[2])
    assert set(map(repr, passed)) <= set(map(repr, filter(lambda p: kept(p[1]), pairs(steps[1]))))
    ledger = {r.doc_id: r.failed for r in quality_rules.measure(steps[1]).collect()}
    assert [d for d, _ in passed] == [d for d, _ in pairs(steps[1]) if ledger[d] & quality_rules.STANDARD.mask() == 0]


def test_near_copies(steps):
    rows = [p for p in pairs(steps[2]) if p[0] is not None]
    prints = np.array([brute_print(t) for _, t in rows], dtype=np.uint64)
    near = [np.flatnonzero(np.bitwise_count(prints ^ p) <= 2) for p in prints]
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    place = {i: k for k, i in enumerate(order)}
    label = least_by_reach(len(rows), lambda k: [place[j] for j in near[order[k]]])
    first = [rows[order[k]] for k in range(len(rows)) if label[k] == k]
    assert sorted(p for p in pairs(steps[3]) if p[0] is not None) == sorted(first)


def test_one_id_with_several_texts(spark):
    """Rows of one id that are not near copies stay, whatever the order they come in."""
    other = " ".join(f"other{i}" for i in range(60))
    long = " ".join(f"word{i}" for i in range(90))
    rows = [(7, long), (7, other), (7, other), (8, other), (9, long), (None, long), (10, None), (11, ""), (10, "lone text of its own")]
    for turn in range(10):
        docs = spark.createDataFrame(rows[turn:] + rows[:turn], "doc_id long, text string").selectExpr("*", "'mine' AS text_hash").repartition(3)
        kept = simhash_trie.keep_first(docs)
        assert kept.columns == docs.columns
        assert pairs(kept) == sorted([(7, long), (7, other), (None, long), (10, None), (10, "lone text of its own")], key=repr)


def test_repeats(steps):
    before, after = pairs(steps[3]), pairs(steps[4])
    assert [d for d, _ in before] == [d for d, _ in after]
    old, new = grams(before, 51), grams(after, 51)
    repeated = {g for g, at in old.items() if len({d for d, _ in at}) > 1}
    assert all(len({d for d, _ in new.get(g, [])}) <= 1 for g in repeated)
    dirty = {d for g, at in old.items() if len(at) > 1 for d, _ in at}
    assert sum(a != b and a[0] not in dirty for a, b in zip(before, after, strict=True)) <= 0.05 * len(before)


def test_packing(steps):
    words = defaultdict(int)
    for r in steps[5].collect():
        words[r.doc_id] += r.n_words
        assert r.position + r.n_words + 1 <= r.bin_tokens <= r.bin_size
    assert words == {d: len((t or "").encode().split()) for d, t in pairs(steps[4])}


def test_run_and_empty_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    whole = corpus_pipeline.run(spark, SF)
    assert whole.agg(F.sum("n_words")).first()[0] > 0
