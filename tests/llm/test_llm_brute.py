"""Results held against plain Python on tables of the driver and on small ones made to be awkward."""

import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import xxhash

from partloom.llm import (
    best_fit_packing,
    common,
    compression_toxicity,
    embedding_blocks,
    license_scan,
    paragraph_minhash,
    quality_rules,
    sentencepiece_dropout,
    simhash_trie,
)
from partloom.llm.queries import MODEL_FILE, QUERIES


@pytest.fixture(scope="module")
def texts(spark):
    import os

    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r.doc_id, r.text) for r in rows)


# Pieces ---------------------------------------------------------------------------------------


def test_without_dropout_pieces_are_the_librarys(texts):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE)
    some = [t for _, t in texts[:120]] + ["  two  spaces ", "a\tb\n", "日本語テスト", "x" * 700, "<s> </s>"]
    found = sentencepiece_dropout.Encoder(MODEL_FILE).encode(some, list(range(len(some)))).to_pylist()
    assert found == [model.encode(t) for t in some]


def test_dropout_table_equals_agenda():
    v = sentencepiece_dropout.vocabulary(MODEL_FILE)
    rng = random.Random(4)
    words = ["▁" + "".join(rng.choice("abcdeinrstéß日x") for _ in range(rng.randrange(0, 40))) for _ in range(600)]
    variants = np.array([rng.randrange(8) for _ in words])
    for dropout in (0.0, 0.1, 0.6, 1.0):
        flat, begin = sentencepiece_dropout.segment_many(words, variants, v, dropout, 3)
        for i, word in enumerate(words):
            ids = sentencepiece_dropout.segment(word, v, dropout, 3, int(variants[i]))
            expected, _ = sentencepiece_dropout._in_bytes(np.array(ids, np.int32), np.array([0, len(ids)]), v)
            assert flat[begin[i]: begin[i + 1]].tolist() == expected.tolist()


def test_dropout_varies_and_repeats(texts):
    some = [t for _, t in texts[:40]]
    ids = list(range(len(some)))
    one, same, other = (sentencepiece_dropout.Encoder(MODEL_FILE, 0.1, s, 8).encode(some, ids).to_pylist() for s in (1, 1, 2))
    plain = sentencepiece_dropout.Encoder(MODEL_FILE).encode(some, ids).to_pylist()
    assert one == same and one != other and sum(map(len, one)) > sum(map(len, plain))
    v = sentencepiece_dropout.vocabulary(MODEL_FILE)
    assert [sentencepiece_dropout.decode_ids(x, v) for x in one] == some


# Embeddings -----------------------------------------------------------------------------------


def brute_links(vectors, similarity=0.9):
    good = {i: np.array(v, float) for i, v in vectors.items() if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    links = defaultdict(set)
    for i, a in good.items():
        for j, b in good.items():
            if i < j and len(a) == len(b) and a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= similarity:
                links[i].add(j)
                links[j].add(i)
    component = {}
    for i in sorted(vectors):
        if i not in component:
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in component:
                    component[x] = i
                    todo += links[x]
    return {i: (len(links[i]), component[i]) for i in vectors}


@pytest.mark.parametrize("side", [4096, 7])
def test_embedding_links(spark, monkeypatch, side):
    # The small side makes several groups of every cell with more rows.
    monkeypatch.setattr(embedding_blocks, "SIDE", side)
    monkeypatch.setattr(embedding_blocks, "CELL", 20)
    rng = np.random.default_rng(3)
    vectors, at = {}, 100
    for dims in (64, 10, 1):
        for _ in range(40):
            center = rng.normal(size=dims)
            for _ in range(int(rng.integers(1, 9))):
                vectors[at] = (center + rng.normal(size=dims) * rng.choice([0, 0.05, 0.2, 0.4])).tolist()
                at += 1
    same = rng.normal(size=64).tolist()
    vectors |= {at + i: same for i in range(30)}
    vectors |= {1: None, 2: [], 3: [0.0] * 64, 4: [float("nan")] + [1.0] * 63, 5: [1.0, None] + [1.0] * 62, 6: [float("inf")] * 64}
    rows = [*vectors.items(), (100, vectors[100]), (None, [1.0] * 64)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS cell", "1 AS dims")
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_blocks.near_duplicates(frame).collect()}
    expected = {i: (n, c, i == c) for i, (n, c) in brute_links(vectors).items()}
    assert found == expected


def test_embedding_empty(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_blocks.near_duplicates(frame).count() == 0


# SimHash --------------------------------------------------------------------------------------


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i: i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_by_reach(n, linked):
    label = list(range(n))
    for i in range(n):
        if label[i] == i:
            todo = [i]
            seen = {i}
            while todo:
                x = todo.pop()
                label[x] = i
                for y in linked(x):
                    if y not in seen:
                        seen.add(y)
                        todo.append(y)
    return label


@pytest.mark.parametrize("subtree", [2048, 4])
def test_simhash_components(spark, texts, monkeypatch, subtree):
    monkeypatch.setattr(simhash_trie, "SUBTREE", subtree)
    rows = [*texts, (10**6, "Ä B\tc"), (10**6 + 1, "ä b c"), (10**6 + 2, "")]
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_trie.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    prints = np.array([brute_print(t) for _, t in rows], dtype=np.uint64)
    near = [np.flatnonzero(np.bitwise_count(prints ^ p) <= 2) for p in prints]
    label = least_by_reach(len(rows), lambda i: near[i])
    assert found == {d: (f"{int(p):016x}", rows[label[i]][0]) for i, ((d, _), p) in enumerate(zip(rows, prints, strict=True))}


def test_walk_finds_all_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**64, 300, dtype=np.uint64)
    crowd = base[0] ^ (np.uint64(1) << rng.integers(0, 6, 400).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64))
    v = np.unique(np.concatenate([base, crowd]))
    found = Counter(tuple(sorted((int(x), int(y)))) for a, b in simhash_trie.walk(v, v, 0, 2, True) for x, y in zip(a, b, strict=True))
    i, j = np.nonzero(np.triu(np.bitwise_count(v[:, None] ^ v[None, :]) <= 2, 1))
    assert found == Counter(zip(i.tolist(), j.tolist(), strict=True))


def test_components_of_odd_shapes(spark):
    path = [(i, i + 1) for i in range(1, 300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    rows = [*path, *star, (5000, 5001), (5001, 5000), (6000, 6000)]
    frame = spark.createDataFrame(rows, "a long, b long")
    found = {r.node: r.component for r in common.components(frame, common.work_folder(spark)).collect()}
    assert found == {i: 1 for i in range(1, 301)} | {1000 + i: 1000 for i in range(200)} | {5000: 5000, 5001: 5000}


# License scans --------------------------------------------------------------------------------


def regex_of(template):
    parts = re.split(r"(\[\[|\]\]|\{\{\d+\}\})", template)
    out = ""
    for part in parts:
        if part == "[[":
            out += "(?:"
        elif part == "]]":
            out += ")?"
        elif part.startswith("{{"):
            out += rf"(?:[^ ]+ ){{0,{part[2:-2]}}}"
        else:
            out += "".join(re.escape(w.decode()) + " " for w in license_scan.words_of(part))
    return re.compile("(?<= )" + out)


def brute_scan(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = {}
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        if at := [i for i in range(len(words)) if words[i: i + len(p)] == p]:
            places[label] = at
    line = " " + "".join(w + " " for w in words)
    matched, opened = (
        {label for label, several in given.items() if any(regex_of(t).search(line) for t in several)}
        for given in (license_scan.TEMPLATES, license_scan.OPENINGS)
    )
    every = sum(places.values(), [])
    return (
        len(words), len(every), min(every, default=None), max(every, default=None), ",".join(sorted(places)),
        ",".join(sorted(set(places) | matched | opened)), 1.0 if matched else 0.75 if opened else 0.5 if places else 0.0,
    )


def test_license_scan(spark, texts):
    made = [
        "cc by cc by-CC.BY", "All rights reserved. All rights all rights reserved", "Licensed under CC BY-NC 4.0.", "Released under the MIT License.",
        "This work is licensed under the GNU General Public License, version 3 of the License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this small tool to deal in the Work without restriction,"
        " including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Work",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this one two three four five six seven eight nine to deal in the Work",
        "under the terms of the MIT license", "under the terms of MIT license", "licensed under the gnu general public license version 4", "Äcc by", "a cc by",
    ]
    rows = [*texts, *((10**6 + i, t) for i, t in enumerate(made))]
    found = {r.doc_id: tuple(r)[1:] for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {d: brute_scan(t) for d, t in rows}
    assert {r[5] for r in found.values()} >= {"mit", "gpl,gpl-3.0", "cc-by", "reserved", "gpl", "cc-by,cc-by-nc-4.0"}


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
%s
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""


def spelled(template):
    """A text that a template stands for: optional parts in, free words given."""
    return re.sub(r"\{\{\d+\}\}", "Example Holders", template).replace("[[", "").replace("]]", "")


def test_whole_wordings_are_told_apart(spark):
    rows = {
        "mit": MIT % "", "json": MIT % "The Software shall be used for Good, not Evil.", "mit-opening": MIT[:420], "changed": MIT % "But only on Mondays.",
        "no words": MIT.replace("hereby", "") % "", **{label: spelled(license_scan.TEMPLATES[label][-1]) for label in ("isc", "bsd-2-clause", "bsd-3-clause", "bsd-4-clause")},
        "bsd-opening": spelled(license_scan.OPENINGS["bsd-opening"][0]) + " you like it", "isc-opening": spelled(license_scan.OPENINGS["isc-opening"][0]),
    }
    found = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(spark.createDataFrame(list(rows.items()), "doc_id string, text string")).collect()}
    for label in ("mit", "json"):
        assert found[label] == (f"{label},mit-opening", 1.0)
    for n in "234":
        assert found[f"bsd-{n}-clause"] == (f"bsd-{n}-clause,bsd-opening", 1.0)
    assert found["isc"] == ("isc,isc-opening", 1.0)
    assert found["changed"] == found["mit-opening"] == ("mit-opening", 0.75) and found["no words"] == ("", 0.0)
    assert found["bsd-opening"] == ("bsd-opening", 0.75) and found["isc-opening"] == ("isc-opening", 0.75)


def test_many_anchors_take_linear_time():
    matchers = [license_scan.Matcher.of(t) for given in (license_scan.TEMPLATES, license_scan.OPENINGS) for several in given.values() for t in several]
    words = license_scan.words_of("sold under the mit license terms or not under the usual terms cc by nc " * 28_000)
    line = b" " + b" ".join(words) + b" "
    assert len(line) > 1_900_000
    anchor = license_scan.Matcher.of("[[ x ]] under the y")
    started = time.perf_counter()
    assert sum(1 for _ in license_scan._places(line, b" under the ")) == 56_000 and not anchor.found(line, words)
    assert [m for m in matchers if m.found(line, words)]
    assert time.perf_counter() - started < 4


def test_license_markup_errors():
    for bad in ("a [[ b", "a ]] b", "[[ a ]]", "{{3}}"):
        with pytest.raises(ValueError):
            license_scan.Matcher.of(bad)


# Packing --------------------------------------------------------------------------------------


def naive_best_fit(lengths, allowed):
    waiting, bins = Counter(lengths), []
    for length in lengths:
        waiting[length] -= 1
        fitting = [b for b in bins if b[0] - sum(b[1]) >= length]
        if fitting:
            room = min(b[0] - sum(b[1]) for b in fitting)
            chosen = [b for b in fitting if b[0] - sum(b[1]) == room]
        else:
            best = None
            for size in allowed.sizes:
                if size >= length:
                    filled, left = length, Counter(waiting)
                    for kind in sorted(left, reverse=True):
                        take = min(left[kind], (size - filled) // kind)
                        filled += take * kind
                    rate = allowed.cost(size) / filled
                    if best is None or rate <= best[0]:
                        best = (rate, size)
            chosen = [[best[1], []]]
            bins += chosen
        chosen[-1][1].append(length)
    return Counter((min(s for s in allowed.sizes if s >= sum(b)), sum(b)) for _, b in bins)


def test_packing_is_best_fit():
    rng = np.random.default_rng(2)
    for allowed in (best_fit_packing.Lengths((8, 16, 64)), best_fit_packing.Lengths((10, 30), costs={10: 1, 30: 5})):
        for n in (0, 1, 7, 200):
            lengths = np.sort(rng.integers(1, allowed.sizes[-1] + 1, n))[::-1]
            bins, places, sizes = best_fit_packing.pack_lengths(lengths, allowed)
            contents = np.bincount(bins, weights=lengths, minlength=len(sizes)).astype(int)
            assert Counter(zip(sizes.tolist(), contents.tolist(), strict=True)) == naive_best_fit(lengths.tolist(), allowed)
            for b in range(len(sizes)):
                at = np.argsort(places[bins == b])
                assert (np.cumsum(lengths[bins == b][at]) - lengths[bins == b][at] == places[bins == b][at]).all()


def test_packing_pieces(spark, texts):
    allowed = best_fit_packing.Lengths((32, 64))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    rows = best_fit_packing.pack(frame, allowed, per_shard=50).collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.first_word, r.n_words))
    for doc_id, text in texts:
        n, at = len((text or "").encode().split()), 0
        for first, words in sorted(by_doc[doc_id]):
            assert first == at and words <= 63
            at += words
        assert at == n
    whole = best_fit_packing.sequences(best_fit_packing.pack(frame, allowed, per_shard=50)).collect()
    assert sum(len(r.doc_ids) for r in whole) == len(rows)


# Toxicity -------------------------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    found = QUERIES["op7_compression_toxicity"](spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [(r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    caught, wrong = sum(p for p, y in held if y), sum(p for p, y in held if not y)
    assert caught >= 0.7 * sum(y for _, y in held) and wrong <= 0.02 * len(held)


def test_toxicity_never_sees_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.withColumn("toxic", (~compression_toxicity.is_held_out(labels.doc_id)).cast("int") * labels.toxic)
    assert compression_toxicity.fit(docs, labels) == compression_toxicity.fit(docs, turned)


# Repeats --------------------------------------------------------------------------------------


def grams(rows, n):
    found = defaultdict(list)
    for doc_id, text in rows:
        words = (text or "").lower().split()
        for k in range(len(words) - n + 1):
            found[tuple(words[k: k + n])].append((doc_id, k))
    return found


def test_planted_passages_go_and_the_rest_stays(spark):
    rng = random.Random(5)
    fresh = lambda n: " ".join("w%06d" % rng.randrange(10**6) for _ in range(n))
    passages = [fresh(n) for n in (51, 60, 90, 140)]
    line = fresh(120)
    near = " ".join(w if i not in (20, 80) else "changed" for i, w in enumerate(line.split()))
    rows, planted = [], defaultdict(list)
    for i in range(60):
        parts = [fresh(rng.randrange(20, 200)) for _ in range(3)]
        if i % 3 == 0:
            which = (i // 3) % 4
            parts[1] = f"{fresh(10)} {passages[which]} {fresh(10)}"
            planted[which].append(i)
        if i in (41, 43):
            parts[2] = line if i == 41 else near
        rows.append((i, "\n".join(parts)))
    rows += [(100, rows[10][1]), (None, rows[10][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {(r.doc_id): r.text for r in paragraph_minhash.remove_repeats(frame).collect() if r.doc_id is not None}
    for which, holders in planted.items():
        assert [i for i in holders if passages[which] in kept[i]] == holders[:1]
        for i in holders[1:]:
            before, after = rows[i][1].split(), kept[i].split()
            assert len(before) - len(after) == len(passages[which].split()) and set(after) <= set(before)
    assert line in kept[41] and "changed" not in kept[43] and kept[100].strip() == ""
    touched = {i for holders in planted.values() for i in holders[1:]} | {43, 100}
    assert all(kept[i] == text for i, text in rows if i is not None and i not in touched)


def test_repeats_of_the_tables(spark, texts):
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in paragraph_minhash.remove_repeats(frame).collect()]
    before, after = grams(texts, 51), grams(kept, 51)
    repeated = {g for g, at in before.items() if len(at) > 1}
    # What stays twice overlaps itself within one text.
    assert all(len({d for d, _ in at}) == 1 for g, at in after.items() if len(at) > 1 and g in repeated)
    dirty = {d for g in repeated for d, _ in before[g]}
    lines = Counter()
    changed = {d for (d, t) in kept if t != dict(texts)[d]}
    near = changed - dirty
    assert len(near) <= 0.05 * len(texts), lines


def test_results_do_not_depend_on_chunks(spark, texts, monkeypatch):
    rows = [(i, (t or "").replace("e", "à")) for i, t in texts]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)

    def results():
        spans = paragraph_minhash.repeated_spans(frame).collect()
        return sorted((r.doc_id, r.spans) for r in spans), sorted(map(tuple, quality_rules.measure(frame).collect()))

    whole = results()
    monkeypatch.setattr(common, "_CHUNK", 5_000)
    for name, value in (("BLOCK", 2), ("SMALL", 1), ("TOGETHER", 3), ("BYTES", 5_000), ("ROWS", 7)):
        monkeypatch.setattr(paragraph_minhash, name, value)
    assert results() == whole and dict((r[0], r[1:6]) for r in whole[1]) == {i: brute_measures(t) for i, t in rows}


def test_similar_links_join_what_is_similar():
    rng = np.random.default_rng(8)
    for n, kinds, similarity in ((60, 40, 0.5), (80, 12, 0.6), (40, 200, 0.3), (1, 5, 0.5), (0, 5, 0.5)):
        sets = [np.unique(rng.integers(0, kinds, rng.integers(1, 30), dtype=np.uint64)) for _ in range(n)]
        near = [[j for j in range(n) if j != i and len(set(s) & set(sets[j])) >= similarity * len(set(s) | set(sets[j]))] for i, s in enumerate(sets)]
        x, y = paragraph_minhash.similar_links(sets, similarity)
        assert all(j in near[i] for i, j in zip(x.tolist(), y.tolist(), strict=True))
        joined = defaultdict(set)
        for i, j in zip(x.tolist(), y.tolist(), strict=True):
            joined[i].add(j)
            joined[j].add(i)
        assert least_by_reach(n, lambda i: joined[i]) == least_by_reach(n, lambda i: near[i])  # noqa: B023


def test_similar_twos():
    rng = np.random.default_rng(9)
    left, right = ([np.unique(rng.integers(0, 30, rng.integers(1, 25), dtype=np.uint64)) for _ in range(200)] for _ in range(2))
    expected = [len(set(a) & set(b)) >= 0.5 * len(set(a) | set(b)) for a, b in zip(left, right, strict=True)]
    assert paragraph_minhash.similar_twos(left, right, 0.5).tolist() == expected


def test_bands_reach_their_recall():
    for similarity in (0.7, 0.8, 0.9):
        bands, rows = paragraph_minhash.tuned_bands(similarity, 0.999)
        assert bands * rows <= 64 and 1 - (1 - similarity**rows) ** bands >= 0.999


# Quality rules --------------------------------------------------------------------------------


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i: i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i: i + 5])] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_measures(spark, texts):
    rng = random.Random(3)
    made = [" ".join(rng.choice("ab") for _ in range(rng.randrange(40))) + "\n" * rng.randrange(3) + "a b\x85c \x1c" for _ in range(200)]
    rows = [*texts, *((10**6 + i, t) for i, t in enumerate(made))]
    found = {r.doc_id: tuple(r)[1:6] for r in quality_rules.measure(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {d: brute_measures(t) for d, t in rows}


def test_ablation_counts(spark, texts):
    ledger = quality_rules.measure(spark.createDataFrame(texts, "doc_id long, text string")).cache()
    bits = [r.failed & quality_rules.STANDARD.mask() for r in ledger.collect()]
    place = {rule.name: 1 << i for i, rule in enumerate(quality_rules.RULES)}
    found = {r.rule: tuple(r)[1:] for r in quality_rules.ablation(ledger).collect()}
    none = sum(b == 0 for b in bits)
    assert found == {
        name: (sum(b & place[name] != 0 for b in bits), sum(b == place[name] for b in bits), none, none + sum(b == place[name] for b in bits))
        for name in quality_rules.STANDARD.rules
    }
    ledger.unpersist()


def test_unknown_rule():
    with pytest.raises(ValueError):
        quality_rules.Policy("p", 1, ("nothing",)).mask()
