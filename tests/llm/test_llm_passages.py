"""Repeated passages around phrases that are frequent in themselves, held against plain Python."""

import random

import xxhash

from partloom.llm import paragraph_minhash


def fresh(rng, n):
    return [f"w{rng.randrange(10**7):07d}" for _ in range(n)]


def cut_by_brute(rows, n=50):
    """The texts without the words of passages that an earlier one (by document and place) equals."""
    first, kept = {}, {}
    for doc_id, words in sorted(rows):
        gone = set()
        for k in range(len(words) - n + 1):
            at = first.setdefault(tuple(words[k: k + n]), (doc_id, k))
            if at != (doc_id, k):
                gone |= set(range(max(k, at[1] + n) if at[0] == doc_id else k, k + n))
        kept[doc_id] = [w for i, w in enumerate(words) if i not in gone]
    return kept


def cut(spark, rows):
    frame = spark.createDataFrame([(i, " ".join(words)) for i, words in rows], "doc_id long, text string")
    return {r.doc_id: r.text.split() for r in paragraph_minhash.remove_repeats(frame).collect()}


def test_phrase_in_the_lowest_document(spark):
    rng = random.Random(11)
    rows = [(0, fresh(rng, 150))]
    for n in range(8):  # a phrase that document 0 has alone lies within passages of two others
        phrase, at = fresh(rng, 40), rng.randrange(5, 35)
        rows[0][1].extend(phrase + fresh(rng, 60))
        passage = fresh(rng, at) + phrase + fresh(rng, 40 - at)
        rows += [(10 * n + k, fresh(rng, 150) + passage + fresh(rng, 150)) for k in (1, 2)]
    kept = cut(spark, rows)
    assert kept == cut_by_brute(rows)
    assert all(len(kept[10 * n + 2]) == 300 and len(kept[10 * n + 1]) == 380 for n in range(8)) and kept[0] == rows[0][1]


def test_short_matches_with_two_documents_stay(spark):
    rng = random.Random(12)
    left, right = fresh(rng, 40), fresh(rng, 40)
    rows = [(0, fresh(rng, 80) + left + fresh(rng, 80)), (1, fresh(rng, 80) + right + fresh(rng, 80)), (2, fresh(rng, 80) + left + right + fresh(rng, 80))]
    assert cut(spark, rows) == dict(rows)


def test_phrase_alone_and_again_in_a_shared_passage(spark):
    rng = random.Random(13)
    rows = []
    for n in range(8):
        phrase, at = fresh(rng, 40), rng.randrange(5, 35)
        passage = fresh(rng, at) + phrase + fresh(rng, 40 - at)
        rows += [(10 * n, fresh(rng, 150) + passage + fresh(rng, 150)), (10 * n + 1, fresh(rng, 60) + phrase + fresh(rng, 60) + passage + fresh(rng, 60))]
        # The same within one document, and a passage of which another document has the second occurrence only.
        rows += [(10 * n + 2, fresh(rng, 60) + phrase + fresh(rng, 60)), (10 * n + 3, passage * 2 + phrase[:20] * 6)]
    kept = cut(spark, rows)
    assert all(len(kept[10 * n + 1]) == 220 for n in range(8))
    brute = cut_by_brute(rows)
    assert {i: w for i, w in kept.items() if i % 10 < 3} == {i: w for i, w in brute.items() if i % 10 < 3}
    left = [tuple(w[k: k + 50]) for w in kept.values() for k in range(len(w) - 49)]
    assert len(left) == len(set(left))


def test_one_id_with_two_texts(spark):
    rng = random.Random(14)
    passage, other = fresh(rng, 70), fresh(rng, 60)
    texts = [(0, fresh(rng, 30) + passage), (5, fresh(rng, 300) + passage + fresh(rng, 20)), (5, fresh(rng, 90)), (5, other), (6, other + fresh(rng, 60))]
    rows = [(i, " ".join(words)) for i, words in [*texts, texts[1]]]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'mine' AS text_key")
    done = paragraph_minhash.remove_repeats(frame, spans_column="removed")
    assert done.columns == ["doc_id", "text", "text_key", "removed"]
    found = sorted((r.doc_id, r.text.split(), r.text_key) for r in done.collect())
    kept = [texts[0], (5, texts[1][1][:300] + texts[1][1][370:]), texts[2], texts[3], (6, texts[4][1][60:])]
    assert found == sorted((i, words, "mine") for i, words in [*kept, kept[1]])


def test_borders_are_told_by_whole_words(spark):
    rng = random.Random(15)
    by_byte = {}
    for w in fresh(rng, 3000):
        by_byte.setdefault(xxhash.xxh3_64_intdigest(w, paragraph_minhash.Options().seed) % 255, []).append(w)
    alike = [same[:2] for same in by_byte.values() if len(same) > 1]
    rows = []
    for n in range(20):  # words beside a passage that differ but have the same byte
        (a, b), (c, d) = alike[2 * n: 2 * n + 2]
        passage = fresh(rng, 49 if n % 2 else 55)
        rows += [(2 * n, [*fresh(rng, 90), a, *passage, c, *fresh(rng, 90)]), (2 * n + 1, [*fresh(rng, 90), b, *passage, d, *fresh(rng, 90)])]
    kept = cut(spark, rows)
    assert kept == cut_by_brute(rows) and {len(kept[2 * n + 1]) for n in range(20)} == {182, 231}


def test_shared_passages_at_every_place_of_a_window(spark):
    rng = random.Random(16)
    rows = []
    for n in range(35):  # one phrase, and 49 to 51 equal words around it that begin at every place before it
        phrase, around = fresh(rng, 16), fresh(rng, 35)
        passage = (around[:n] + phrase + around[n:])[: 49 + n % 3]
        rows += [(10 * n + k, fresh(rng, 40) + passage + fresh(rng, 40)) for k in range(2)]
        rows += [(10 * n + k, fresh(rng, 60) + phrase + fresh(rng, 60)) for k in range(2, 5)]
    assert cut(spark, rows) == cut_by_brute(rows)


def test_passages_around_a_frequent_phrase_are_not_written(spark, tmp_path):
    rng = random.Random(17)
    phrase = fresh(rng, 40)
    rows = [(n, " ".join(fresh(rng, 60) + phrase + fresh(rng, 60))) for n in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert not paragraph_minhash.repeated_spans(frame, folder=f"file:{tmp_path}/").collect()
    # About 30 passages around each phrase hold words that no other text has.
    assert spark.read.parquet(f"file:{tmp_path}/again").where("kind = 0 AND length(hashes) > 80").count() == 0
    assert paragraph_minhash._passages(spark.read.parquet(f"file:{tmp_path}/members-of-windows")).count() == 0
