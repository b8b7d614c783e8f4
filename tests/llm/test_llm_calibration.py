"""Calibration sees texts as scoring does: all windows of them."""

import numpy as np

from partloom.llm import compression_toxicity as toxicity


def test_calibration_takes_every_window(spark):
    rng = np.random.default_rng(5)
    words = [f"word{i}" for i in range(400)]
    vile = ["vilething", "nastyword", "hatefulbit", "grimslur"]

    def text(toxic: bool, windows: int) -> str:
        found = list(rng.choice(words, windows * toxicity.WINDOW))
        if toxic:  # only in the second window, which every other window of 49 or more leaves out
            found[toxicity.WINDOW: 2 * toxicity.WINDOW] = rng.choice(vile, toxicity.WINDOW)
        return " ".join(found)

    rows = [(i, text(i % 3 == 0, 2 if i % 2 else 60), int(i % 3 == 0)) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    chosen = docs.where(toxicity.for_calibration(docs.doc_id) & ~toxicity.is_held_out(docs.doc_id)).collect()
    x = np.array([toxicity._features(toxicity.gains(toxicity.windows_of(r.text), toxicity._compressors(model))) for r in chosen])
    assert len({r.toxic for r in chosen}) == 2
    assert np.allclose([m for m, _ in model.scale], x.mean(axis=0))
    assert all((toxicity.score_text(r.text, model) >= toxicity.CUT) == r.toxic for r in chosen)
