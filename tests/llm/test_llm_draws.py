"""Every occurrence of a word skips merges by draws of its own, at the rate that was asked for."""

import time

import numpy as np

from partloom.llm import sentencepiece_dropout
from partloom.llm.queries import MODEL_FILE


def test_each_occurrence_has_its_own_draws():
    v = sentencepiece_dropout.vocabulary(MODEL_FILE)
    words = ["information", "ab", "ß日x", "the", "x" * 300]
    texts = [" ".join(words) for _ in range(400)] + [None, "", "▁ a▁b  c"]
    ids = list(range(len(texts)))
    encoder = sentencepiece_dropout.Encoder(MODEL_FILE, 0.1, 1)
    found = encoder.encode(texts, ids).to_pylist()
    assert [x if x is None else sentencepiece_dropout.decode_ids(x, v) for x in found] == texts
    # The same as the agenda of each occurrence alone.
    draws = encoder._variants(ids[:20], [len(words)] * 20)
    for i in range(20):
        expected = []
        for k, word in enumerate(words):
            some = np.array(sentencepiece_dropout.segment(sentencepiece_dropout.SPACE + word, v, 0.1, 1, int(draws[i * len(words) + k])), np.int32)
            expected += sentencepiece_dropout._in_bytes(some, np.array([0, len(some)]), v)[0].tolist()
        assert found[i] == expected


def test_every_merge_is_skipped_at_the_rate():
    plain = sentencepiece_dropout.Encoder(MODEL_FILE)
    for word in ("ab", "the", "information", "people"):
        n = len(sentencepiece_dropout.Encoder(MODEL_FILE)._plain([sentencepiece_dropout.SPACE + word])[3][0])
        found = sentencepiece_dropout.Encoder(MODEL_FILE, 0.1, 3).encode([word] * 4000, list(range(4000))).to_pylist()
        same = sum(x == plain.encode([word], [0]).to_pylist()[0] for x in found) / 4000
        # Another order of merges may give the same piece, but its last merge must not be skipped.
        assert n and 0.9**n - 0.03 < same < 0.92
    found = sentencepiece_dropout.Encoder(MODEL_FILE, 0.1, 3).encode(["information"] * 4000, list(range(4000))).to_pylist()
    assert len(set(map(tuple, found))) > 8


def random_text(seed, n, letters):
    pick = np.random.default_rng(seed)
    return "".join(letters[i] for i in pick.integers(0, len(letters), n))


def test_long_words_equal_one_agenda():
    """Cut or not, in arrays or alone: a word has the segmentation of its one agenda."""
    v = sentencepiece_dropout.vocabulary(MODEL_FILE)
    kinds = ["abcdefghijklmnopqrstuvwxyz", "etaoinshr", "\u4e00\u4e8c\u4e09\u5341\u767e\u5343\u4e07", "ab\u4e00\u0e01\U0001f600", "x"]
    words = [sentencepiece_dropout.SPACE + random_text(i, n, k) for i, k in enumerate(kinds) for n in (3, 255, 256, 700)]
    words = ["", words[1], "", *words[2:], ""]
    draws = np.arange(len(words), dtype=np.int64) * 977
    for dropout in (0.0, 0.3):
        flat, begin = sentencepiece_dropout.segment_many(words, draws, v, dropout, 3)
        for i, word in enumerate(words):
            alone = np.array(sentencepiece_dropout.segment(word, v, dropout, 3, int(draws[i])), np.int32)
            expected, _ = sentencepiece_dropout._in_bytes(alone, np.array([0, len(alone)]), v)
            assert flat[begin[i]: begin[i + 1]].tolist() == expected.tolist(), (i, dropout)


def test_one_draw_and_many_agree():
    pick = np.random.default_rng(1)
    merged, left, place = pick.integers(0, 1 << 20, (3, 2000))
    variant = pick.integers(0, 1 << 63, 2000).astype(np.uint64)
    for dropout in (0.1, 0.5):
        many = sentencepiece_dropout._skips(7, variant, merged, left, place, dropout)
        one = [sentencepiece_dropout._skips_one(7, int(d), int(m), int(a), int(p), dropout) for d, m, a, p in zip(variant, merged, left, place)]
        assert many.tolist() == one and 0 < sum(one) < 2000


def test_texts_without_spaces_are_fast():
    """Characters that no piece joins are as fast as words; letters that any piece may join stay linear."""
    encoder = sentencepiece_dropout.Encoder(MODEL_FILE, 0.1, 1)
    spaced = " ".join(random_text(i, 5, "abcdefghij") for i in range(6_700))
    encoder.encode([spaced], [0])

    def seconds(text):
        started = time.perf_counter()
        encoder.encode([text], [1])
        return time.perf_counter() - started

    base = min(seconds(spaced) for _ in range(3))
    han = "".join(chr(0x4E00 + i % 20_000) for i in range(0, 400_000, 10))
    assert min(seconds(han) for _ in range(3)) < 5 * base + 0.1
    letters = random_text(5, 40_000, "abcdefghijklmnopqrstuvwxyz")
    assert min(seconds(letters) for _ in range(2)) < 1.5
