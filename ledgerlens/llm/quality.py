"""Quality by compression (operator 8).

One zstandard dictionary is built from text labelled good, one from text labelled bad.
A document is compressed with each; it costs fewer bytes with the dictionary of the text it
is like. The difference over the sum of the two sizes, with the compression rate beside
it, becomes a probability by a logistic calibration on labelled documents that the
dictionaries have not seen.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import with_arrow_columns

#: Labelled documents of each class, and pieces of their text, that the fit may take at most.
SAMPLE_DOCS = 6000
SAMPLE_PIECES = 8192
#: Characters that are compressed as one; with longer pieces a text would outgrow its dictionary.
PIECE_CHARS = 2048
DICTIONARY_BYTES = 1 << 18
LEVEL = 3

SIZES = T.StructType([
    T.StructField("good_bytes", T.LongType()), T.StructField("bad_bytes", T.LongType()),
    T.StructField("plain_bytes", T.LongType()), T.StructField("score", T.DoubleType()),
])


@dataclass
class QualityModel:
    good: bytes = b""
    bad: bytes = b""
    mean: list = field(default_factory=lambda: [0.0] * 8)
    scale: list = field(default_factory=lambda: [1.0] * 8)
    weights: list = field(default_factory=lambda: [0.0] * 9)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the crc32 of the id as text falls into the fold that no label is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def _by_document(labels: DataFrame, label: str) -> DataFrame:
    """One label a document; with both it counts as 0."""
    return labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))


def class_sizes(labels: DataFrame, label: str) -> dict[int, int]:
    return {0: 1, 1: 1} | dict(_by_document(labels, label).groupBy("label").count().collect())


def labelled_ids(labels: DataFrame, label: str, per_class: int = SAMPLE_DOCS) -> DataFrame:
    """At most ``per_class`` documents of each class, picked by the hash of their id."""
    known = _by_document(labels, label).withColumn("_h", F.xxhash64("doc_id"))
    picked = [known.where(F.col("label") == v).orderBy("_h", "doc_id").limit(per_class) for v in (0, 1)]
    return picked[0].unionByName(picked[1])


def _dictionary(pieces: list[bytes]) -> bytes:
    import zstandard

    room = min(DICTIONARY_BYTES, sum(map(len, pieces)) // 8)
    try:
        return zstandard.train_dictionary(room, pieces).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself serves
        return b"".join(pieces)[:DICTIONARY_BYTES]


def _features(good: np.ndarray, bad: np.ndarray, plain: np.ndarray) -> np.ndarray:
    difference = (bad - good) / np.maximum(bad + good, 1)
    rate = np.log((good + bad + 1) / (2 * plain + 1))
    length = np.log1p(plain)
    return np.stack([
        difference, rate, length, difference * difference, difference * rate, rate * rate, difference * length, rate * length
    ], axis=1)


def _probability(model: QualityModel, good, bad, plain) -> np.ndarray:
    x = (_features(good, bad, plain) - model.mean) / model.scale
    z = np.clip(x @ np.array(model.weights[1:]) + model.weights[0], -30, 30)
    return 1 / (1 + np.exp(-z))


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (bias first) of a logistic regression, by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, damp = np.zeros(x.shape[1]), np.eye(x.shape[1]) * ridge
    damp[0, 0] = 1e-3
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + damp, x.T @ (y - p) - damp @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, model: QualityModel, column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the compressed sizes of the whole text and its ``score`` (0 to 1, higher is better).

    Null texts are scored as empty ones.
    """
    def make():
        import zstandard

        def compressor(data: bytes):
            given = {"dict_data": zstandard.ZstdCompressionDict(data)} if data else {}
            return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, **given)

        good, bad = compressor(model.good), compressor(model.bad)

        def run(texts: pa.Array) -> list[pa.Array]:
            sizes = np.zeros((len(texts), 3), dtype=np.int64)
            for row, text in enumerate(texts.to_pylist()):
                text = text or ""
                for at in range(0, len(text), PIECE_CHARS):
                    piece = text[at:at + PIECE_CHARS].encode("utf-8")
                    sizes[row] += (len(good.compress(piece)), len(bad.compress(piece)), len(piece))
            g, b, n = sizes.T
            return [pa.array(g), pa.array(b), pa.array(n), pa.array(_probability(model, g, b, n))]

        return run

    return with_arrow_columns(docs, column, SIZES, make, keep)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> QualityModel:
    """Learns from the given labels: dictionaries from one half of the sampled documents, the calibration from the other.

    With too few labels of a class the score is their share.
    """
    ids = labelled_ids(labels, label)
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most 2 * SAMPLE_DOCS ids
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2))
    cut = sample.where((half == 0) & (F.length("text") > 0)).select(
        "label", "doc_id", F.posexplode(F.expr(
            f"transform(sequence(0, cast((length(text) - 1) div {PIECE_CHARS} as int)), i -> substring(text, i * {PIECE_CHARS} + 1, {PIECE_CHARS}))"
        )).alias("at", "piece")
    ).withColumn("_h", F.xxhash64("doc_id", "at"))
    model = QualityModel()
    dictionaries = []
    for value in (1, 0):
        rows = cut.where(F.col("label") == value).orderBy("_h", "doc_id", "at").limit(SAMPLE_PIECES).select("piece").collect()
        dictionaries.append(_dictionary([r[0].encode("utf-8") for r in rows]) if rows else b"")
    model.good, model.bad = dictionaries
    known = score(sample.where(half == 1), model, keep=["label"]).select("label", "good_bytes", "bad_bytes", "plain_bytes").limit(4 * SAMPLE_DOCS).toPandas()
    y = known["label"].to_numpy(dtype=float)
    if not (model.good and model.bad) or len(set(y)) < 2:
        model.good = model.bad = b""
        share = (y.sum() + 1) / (len(y) + 2)
        model.weights = [float(np.log(share / (1 - share))), *[0.0] * 8]
        return model
    x = _features(*[known[n].to_numpy(dtype=np.int64) for n in ("good_bytes", "bad_bytes", "plain_bytes")])
    model.mean, model.scale = x.mean(axis=0).tolist(), np.maximum(x.std(axis=0), 1e-9).tolist()
    w = logistic_fit((x - model.mean) / model.scale, y)
    sizes = class_sizes(labels, label)
    w[0] += np.log(sizes[1] / sizes[0]) - np.log(y.sum() / (len(y) - y.sum()))  # the sample has classes of other sizes
    model.weights = w.tolist()
    return model


def predicted(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
