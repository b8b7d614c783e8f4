"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

A window of words is compressed twice: with a dictionary of ordinary text, and with the same one that
a dictionary of toxic text stands before. How many bytes the toxic one saves is the window's gain.
The toxic dictionary is trained on words that labelled toxic texts hold far more often than ordinary
ones do (likelihood ratio), so ordinary windows gain next to nothing. Gains are cut at fixed
thresholds, and the shares and counts of windows above them are calibrated to a probability on
labelled texts that no dictionary saw. The score is moved so that 0.7 is the cut with the best F1 there.

The dictionaries are trained on the driver from at most ``Sample`` labelled texts and windows of them.
Calibration, like scoring, takes every window of its texts, in the tasks; eight numbers a text come back.

Defined results: a null text is empty; an empty text has one empty window; without labelled texts of
both kinds every score is 0; ids may be null or repeat (a row each; a doc_id labelled twice is toxic if
either says so); extra columns are ignored by ``score`` and kept by ``reject``; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partloom.llm.common import give_back, plain

#: Words of a window, compression level, and the gains in bytes at which windows are counted.
WINDOW, LEVEL, GAINS = 32, 6, (1, 2, 3, 4)
#: The score from which a text is predicted toxic.
CUT = 0.7


@dataclass(frozen=True)
class Sample:
    """Bounds of what the model is fitted on: texts of each kind, and windows of a text that the dictionaries are
    trained on (evenly spaced over all of it)."""

    toxic: int = 2500
    ordinary: int = 5000
    windows: int = 48


@dataclass(frozen=True)
class Model:
    ordinary: bytes = b""
    toxic: bytes = b""
    weights: tuple[float, ...] = ()
    #: Mean and deviation of each feature, from calibration.
    scale: tuple[tuple[float, float], ...] = ()
    shift: float = 0.0
    key: str = field(default="", compare=False)


def windows_of(text: str | None) -> list[bytes]:
    words = (text or "").encode().lower().split()
    return [b" " + b" ".join(words[i: i + WINDOW]) + b" " for i in range(0, max(1, len(words)), WINDOW)]


def _spread(windows: list[bytes], most: int) -> list[bytes]:
    step = max(1, -(-len(windows) // most))
    return windows[::step]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)


_READY: dict[str, tuple] = {}


def _compressors(model: Model) -> tuple:
    """The two compressors; a Python worker that serves many tasks prepares them once."""
    if model.key not in _READY:
        _READY.clear()
        _READY[model.key] = (_compressor(model.toxic + model.ordinary), _compressor(model.ordinary))
    return _READY[model.key]


def gains(windows: list[bytes], compressors: tuple) -> np.ndarray:
    toxic, ordinary = compressors
    return np.fromiter((len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows), np.float64, len(windows))


def _features(gain: np.ndarray) -> list[float]:
    over = [int((gain >= g).sum()) for g in GAINS]
    return [*(math.log1p(n) for n in over), *(math.sqrt(n / len(gain)) for n in over)]


def _trained(samples: list[bytes], size: int, **options) -> bytes:
    """Dictionary content; what the trainer refuses as too little is taken as it is."""
    joined = b"".join(samples)
    if len(joined) <= size or len(samples) < 16:
        return joined[-size:]
    try:
        return zstandard.train_dictionary(size, samples, **options).as_bytes()
    except zstandard.ZstdError:
        return joined[-size:]


_EDGES = b".,;:!?\"'()[]{}*#"


def _telling(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> set[bytes]:
    """Words in far more toxic texts than ordinary ones: four times the share, likelihood ratio of 20 or more."""
    kinds = [Counter(w.strip(_EDGES) for text in texts for w in set(b" ".join(text).split())) for texts in (toxic, ordinary)]
    n, m = len(toxic), len(ordinary)
    found = set()
    for word, a in kinds[0].items():
        b = kinds[1][word]
        part = lambda x, share: x * math.log(x / ((a + b) * share / (n + m))) if x else 0.0  # noqa: B023, E731
        if word and a / n > 4 * b / m and 2 * (part(a, n) + part(b, m)) >= 20:
            found.add(word)
    return found


def train(texts: list[tuple[bool, bool, list[bytes]]], seed: int = 1) -> Model:
    """The model from (toxic, for calibration, windows) of labelled texts."""
    kind = lambda toxic, calibrate: [w for t, c, w in texts if t == toxic and c == calibrate]
    check = [(t, w) for t, c, w in texts if c]
    model = _dictionaries(kind(True, False), kind(False, False), seed)
    if not model.key:
        return Model()
    compressors = _compressors(model)
    return _calibrated(model, [(t, _features(gains(w, compressors))) for t, w in check])


def _dictionaries(toxic: list[list[bytes]], ordinary: list[list[bytes]], seed: int = 1) -> Model:
    """The model before calibration; an empty one without texts of both kinds."""
    if not toxic or not ordinary:
        return Model()
    rng = np.random.default_rng(seed)
    telling = _telling(toxic, ordinary)
    marked = [b" " + w.strip(_EDGES) + b" " for text in toxic for w in b" ".join(text).split() if w.strip(_EDGES) in telling]
    rng.shuffle(marked)
    joined = [b"".join(marked[i: i + 4]) for i in range(0, len(marked), 4)]
    plain_windows = [w for text in ordinary for w in text]
    rng.shuffle(plain_windows)
    size = sum(map(len, plain_windows))
    common = _trained(plain_windows, max(4096, min(1 << 20, size // 4)), level=LEVEL, d=8, k=64)
    rare = _trained(joined, 1 << 14, d=6, k=16)
    return Model(common, rare, key=hashlib.sha256(rare + common).hexdigest())


def _calibrated(model: Model, check: list[tuple[bool, list[float]]]) -> Model:
    """``model`` with the weights of (toxic, features) of texts; an empty one without texts of both kinds."""
    if len({t for t, _ in check}) < 2:
        return Model()
    x = np.array([found for _, found in check])
    y = np.array([t for t, _ in check], dtype=float)
    mean, deviation = x.mean(axis=0), x.std(axis=0) + 1e-6
    design = np.column_stack([np.ones(len(x)), (x - mean) / deviation])
    weights = _logistic(design, y)
    z = design @ weights
    shift = math.log(CUT / (1 - CUT)) - _best_cut(z, y)
    return Model(model.ordinary, model.toxic, tuple(weights), tuple(zip(mean, deviation, strict=True)), shift, model.key)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _best_cut(z: np.ndarray, y: np.ndarray) -> float:
    """The value of ``z`` between two texts at which F1 is best."""
    rank = np.argsort(-z, kind="stable")
    hits = np.cumsum(y[rank])
    f1 = 2 * hits / (np.arange(1, len(z) + 1) + y.sum())
    s = z[rank]
    last = np.append(s[1:] != s[:-1], True)  # equal values are on one side
    best = int(np.argmax(np.where(last, f1, -1)))
    return float((s[best] + s[best + 1]) / 2 if best + 1 < len(s) else s[best] - 1)


def score_text(text: str | None, model: Model) -> float:
    if not model.weights:
        return 0.0
    found = _features(gains(windows_of(text), _compressors(model)))
    z = model.weights[0] + sum(w * (x - m) / d for w, x, (m, d) in zip(model.weights[1:], found, model.scale, strict=True))
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, z + model.shift))))


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def for_calibration(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit(1)), F.lit(4)) == 0


def fit(docs: DataFrame, labels: DataFrame, sample: Sample | None = None) -> Model:
    """The model of ``labels`` (doc_id, toxic) over ``docs``, without the held-out rows."""
    sample = sample or Sample()
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic") > 0).alias("is_toxic"))
    known = known.where(~is_held_out(F.col("doc_id")))
    order = F.xxhash64("doc_id")
    taken = known.where("is_toxic").orderBy(order, "doc_id").limit(sample.toxic).unionAll(
        known.where("NOT is_toxic").orderBy(order, "doc_id").limit(sample.ordinary)
    )
    most = sample.windows

    def run(found, name: str, kind: pa.DataType):
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = pa.array([found(t.as_py()) for t in batch.column("text")], kind)
                yield pa.RecordBatch.from_arrays([*(plain(batch.column(c)) for c in ("doc_id", "is_toxic")), values], names=["doc_id", "is_toxic", name])

        return each

    slim = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    # At most the sample's few thousand ids, so this side is small whatever the corpus.
    joined = slim.join(F.broadcast(taken), "doc_id")
    calibrate = for_calibration(F.col("doc_id"))
    kind = joined.schema["doc_id"].dataType.simpleString()

    def collected(rows: DataFrame, found, name: str, of: str, arrow: pa.DataType) -> list:
        rows = rows.mapInArrow(run(found, name, pa.list_(arrow)), f"doc_id {kind}, is_toxic boolean, {name} array<{of}>").collect()
        texts = {row["doc_id"]: (row["is_toxic"], list(row[name])) for row in sorted(rows, key=lambda r: (r["doc_id"], r[name]))}
        return list(texts.values())

    rows = collected(joined.where(~calibrate), lambda text: _spread(windows_of(text), most), "windows", "binary", pa.binary())
    texts = [(toxic, [bytes(w) for w in windows]) for toxic, windows in rows]
    model = _dictionaries([w for toxic, w in texts if toxic], [w for toxic, w in texts if not toxic])
    if not model.key:
        return Model()
    features = lambda text: _features(gains(windows_of(text), _compressors(model)))
    return _calibrated(model, collected(joined.where(calibrate), features, "features", "double", pa.float64()))


def _scored(model: Model):
    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        found = pa.array([score_text(t.as_py(), model) for t in texts], pa.float64())
        give_back()
        return found

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from CUT on) of every row."""
    found = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), _scored(model)(F.col("text").cast("string")).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def reject(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    return docs.where(_scored(model)(F.col("text").cast("string")) < CUT)
