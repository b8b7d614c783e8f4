"""Nulls, empty and very long texts, repeated rows, empty tables and clashing column names, for every operator on documents."""

import pytest
from pyspark.sql import functions as F

from partloom.llm import (
    best_fit_packing,
    compression_toxicity,
    license_scan,
    paragraph_minhash,
    quality_rules,
    sentencepiece_dropout,
    simhash_trie,
)
from partloom.llm.queries import MODEL_FILE

LONG = " ".join(f"word{i % 5003}" for i in range(120_000))
ROWS = [
    (1, None), (2, ""), (3, " \t\r\n\x0b\x0c "), (4, "one"), (5, "x" * 300_000), (6, LONG), (6, LONG), (7, "a b c d e f"),
    (8, "a b c d e f"), (None, "a b c d e f"), (None, None), (9, "\x00 ▁ ퟿ \U0001f600 é è  <|im_end|> \\"),
]
CLASH = "score fp spans removed_spans pieces measured failed words row shard piece first kind labels fingerprint held_out node start"


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string")
    return frame.select("*", *(F.lit("mine").alias(name) for name in CLASH.split()))


@pytest.fixture(scope="module")
def no_docs(docs):
    return docs.where("false")


def model():
    texts = [(True, c, [b" you idiot and loser here "]) for c in (False, True)] * 30
    return compression_toxicity.train(texts + [(False, c, [b" what a fine day this is "]) for c in (False, True)] * 60)


RUNS = {
    "pieces": lambda d: sentencepiece_dropout.encode(d, MODEL_FILE, dropout=0.2),
    "simhash": simhash_trie.near_duplicates,
    "license": license_scan.scan,
    "packing": best_fit_packing.pack,
    "toxicity": lambda d: compression_toxicity.score(d, model()),
    "repeats": paragraph_minhash.remove_repeats,
    "ledger": quality_rules.measure,
    "kept": quality_rules.keep_rows,
    "first": simhash_trie.keep_first,
    "rejected": lambda d: compression_toxicity.reject(d, model()),
}


@pytest.mark.parametrize("name", RUNS)
def test_empty_table(no_docs, name):
    assert RUNS[name](no_docs).count() == 0


def test_pieces_give_every_text_back(docs):
    found = RUNS["pieces"](docs).select("doc_id", sentencepiece_dropout.decoded(MODEL_FILE)("pieces").alias("text")).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, ROWS))


def test_simhash_rows(docs):
    found = RUNS["simhash"](docs).collect()
    assert len(found) == len(ROWS)
    zero = {r.doc_id for r in found if r.fingerprint == "0" * 16}
    assert zero == {1, 2, 3, None}
    assert {r.component_id for r in found if r.doc_id in (7, 8)} == {7}
    assert {r.component_id for r in found if r.doc_id in (1, 2, 3)} == {1}


def test_first_of_each_group(docs):
    kept = RUNS["first"](docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(x for x in ids if x is not None) == [1, 4, 5, 6, 7, 9]


def test_license_rows(docs):
    found = {r.doc_id: r for r in RUNS["license"](docs).collect()}
    assert len(RUNS["license"](docs).collect()) == len(ROWS)
    assert (found[1].n_words, found[2].n_words, found[6].n_words, found[5].n_words) == (0, 0, 120_000, 1)
    assert found[1].first_word is None and found[1].labels == "" and found[1].score == 0


def test_packing_covers_every_word_once(docs):
    found = RUNS["packing"](docs)
    total = found.agg(F.sum("n_words")).first()[0]
    words = sum(len(text.encode().split()) for _, text in ROWS if text)
    assert total == words
    assert found.where("bin_tokens > bin_size OR position + n_words + 1 > bin_tokens").count() == 0


def test_toxicity_rows(docs):
    found = RUNS["toxicity"](docs).collect()
    assert len(found) == len(ROWS)
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in found)
    assert RUNS["rejected"](docs).columns == docs.columns
    nothing = compression_toxicity.score(docs, compression_toxicity.Model()).collect()
    assert {r.score for r in nothing} == {0.0}


def test_repeats_rows(docs):
    found = RUNS["repeats"](docs)
    assert found.count() == len(ROWS)
    texts = [(r.doc_id, r.text) for r in found.collect()]
    assert [t for t in texts if t[0] not in (6,)] and (1, None) in texts and (2, "") in texts


def test_ledger_rows(docs):
    found = RUNS["ledger"](docs).collect()
    assert len(found) == len(ROWS)
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].n_words == by_id[2].n_words == by_id[3].n_words == 0 and by_id[1].failed & 1
    assert by_id[6].n_words == 120_000 and by_id[6].n_repeat_words == 120_000
    kept = RUNS["kept"](docs)
    assert kept.columns == docs.columns
    passing = [r.doc_id for r in found if r.failed & quality_rules.STANDARD.mask() == 0]
    assert sorted(map(str, (r.doc_id for r in kept.select("doc_id").collect()))) == sorted(map(str, passing))
