"""Language identification by nearest centroid (operator 11).

A text becomes a TF-IDF vector of its character n-grams (one to three letters, a gap between
words counts as one sign), of length 1. The learnt texts of a language are clustered into
several centroids. A text gets the language of the centroid with the largest cosine; it is
rejected if it is further from that centroid than any text the centroid was learnt from, with
some room.

Document frequencies are counted over all texts to learn from. The centroids are learnt from
a sample of them, picked by hash, about ``PER_LANGUAGE`` for each language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import with_arrow_columns

#: Buckets that n-grams are hashed to, longest n-gram, centroids of a language.
BUCKETS_LOG2, LONGEST, CENTROIDS = 14, 3, 4
BUCKETS = 1 << BUCKETS_LOG2
#: Sampled texts of a language, the most frequent languages that are learnt, rounds of the clustering.
PER_LANGUAGE, MOST_LANGUAGES, ROUNDS = 1000, 512, 12
#: A text is rejected below this share of the smallest cosine that its centroid was learnt from.
ROOM = 0.8
UNKNOWN = "und"
_SAMPLE = 1 << 40


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def gram_counts(text: str | None) -> np.ndarray | None:
    """How often the n-grams of each bucket occur in the whole text, in lower case; None if it has no letter."""
    if not text:
        return None
    signs = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    letter = _letters()[signs]
    if not letter.any():
        return None
    # every run of other signs is one gap, and there is one at both ends
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    line = np.concatenate(([0], np.where(letter, signs, 0)[keep], [0])).astype(np.uint32)
    out = np.zeros(BUCKETS, dtype=np.int64)
    mixed = np.full(len(line), 0x9E3779B1, dtype=np.uint32)
    for n in range(1, LONGEST + 1):
        size = len(line) - n + 1
        if size <= 0:
            break
        mixed = (mixed[:size] ^ line[n - 1:]) * np.uint32(0x85EBCA6B)
        mixed ^= mixed >> np.uint32(13)
        spread = (mixed * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BUCKETS_LOG2)
        out += np.bincount(spread[line[:size] > 0] if n == 1 else spread, minlength=BUCKETS)
    return out


def vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights of a text: (1 + ln tf) * idf, scaled to length 1."""
    at = np.flatnonzero(counts)
    weights = (1 + np.log(counts[at])) * idf[at]
    return at, weights / np.sqrt(weights @ weights)


@dataclass
class LanguageModel:
    idf: np.ndarray = field(default_factory=lambda: np.ones(BUCKETS))
    languages: list[str] = field(default_factory=list)
    #: A row per centroid, those of more frequent languages first.
    centroids: np.ndarray = field(default_factory=lambda: np.zeros((0, BUCKETS), dtype=np.float32))
    least: np.ndarray = field(default_factory=lambda: np.zeros(0))


def clustered(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of length 1 of the rows of ``x`` by cosine, and the smallest cosine of each one's rows.

    Starts from rows at even steps in the order of their cosine with the mean; empty clusters go.
    """
    order = np.argsort(x @ x.mean(axis=0), kind="stable")
    steps = ((np.arange(min(k, len(x))) + 0.5) * len(x) / min(k, len(x))).astype(np.int64)
    centres, own = x[order[steps]], None
    for _ in range(ROUNDS):
        new = (x @ centres.T).argmax(axis=1)
        if own is not None and (new == own).all():
            break
        own = new
        sums = [x[own == i].sum(axis=0) for i in range(len(centres)) if (own == i).any()]
        centres = np.stack([s / max(float(np.sqrt(s @ s)), 1e-12) for s in sums])
    cosines = x @ centres.T
    own = cosines.argmax(axis=1)
    return centres, np.array([cosines[own == i, i].min() if (own == i).any() else 1.0 for i in range(len(centres))])


def _document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and the number of texts with letters. Tasks add up theirs."""
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS + 1, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                counts = gram_counts(text.as_py())
                if counts is not None:
                    seen[:-1] += counts > 0
                    seen[-1] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())], names=schema.names)

    out = np.zeros(BUCKETS + 1, dtype=np.int64)
    for r in texts.select("text").mapInArrow(run, schema).groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row per bucket
        out[r.bucket] = r.n
    return out[:-1], int(out[-1])


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> LanguageModel:
    """Learns from the rows of ``docs`` that have a text with letters and a language.

    The id only picks the sample. Rows that repeat count as often as they occur; of languages
    learnt from equally many rows the smaller name comes first, and wins ties. Beyond
    ``MOST_LANGUAGES`` languages the rarest are not learnt. Without any row the model knows
    no language.
    """
    known = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(doc_id).alias("doc_id")).where(
        F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    per_lang = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    if not per_lang:
        return LanguageModel()
    df, n = _document_frequencies(known)
    idf = np.log((n + 1) / (df + 1)) + 1
    shares = docs.sparkSession.createDataFrame(
        [(r.lang, min(_SAMPLE, _SAMPLE * PER_LANGUAGE // r.n + 1)) for r in per_lang], "lang string, below long")
    picked = F.pmod(F.xxhash64("doc_id", "text"), F.lit(_SAMPLE)) < F.col("below")
    sample = known.join(F.broadcast(shares), "lang").where(picked).select("lang", "text")  # MOST_LANGUAGES rows at most

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros((len(rows), BUCKETS), dtype=np.float32)
        used = 0
        for one in rows["text"]:
            counts = gram_counts(one)
            if counts is not None:
                at, weights = vector(counts, idf)
                x[used, at] = weights
                used += 1
        if not used:
            return pd.DataFrame({"lang": [], "centroid": [], "least": []})
        x = x[:used]
        # rows in an order of their own, so that the start does not depend on the shuffle
        x = x[np.lexsort((x @ np.cos(np.arange(BUCKETS)).astype(np.float32), x.sum(axis=1)))]
        centres, least = clustered(x, CENTROIDS)
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "centroid": [c.astype("<f4").tobytes() for c in centres], "least": least})

    rows = sample.groupBy("lang").applyInPandas(learn, "lang string, centroid binary, least double").collect()  # CENTROIDS of a language
    place = {r.lang: i for i, r in enumerate(per_lang)}
    rows.sort(key=lambda r: (place[r.lang], bytes(r.centroid)))
    return LanguageModel(
        idf, [r.lang for r in rows], np.stack([np.frombuffer(r.centroid, "<f4") for r in rows]) if rows else np.zeros((0, BUCKETS), np.float32),
        np.array([r.least for r in rows]))


PREDICTED = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None, reject: bool = False) -> DataFrame:
    """``docs`` with the language of the whole text, the cosine with its nearest centroid (0 to 1) and whether that is too small.

    Null texts and texts without letters are ``und`` with score 0, as all are for a model
    without languages; with ``reject`` rejected ones are, too. Ties go to the more frequent
    language. Every row of ``docs`` stays, with the columns to ``keep`` (all if none are
    given); columns called like the new ones are replaced.
    """
    def make():
        centroids = np.ascontiguousarray(model.centroids.T)  # a row per bucket

        def run(texts: pa.Array) -> list[pa.Array]:
            names, scores, far = [], [], []
            for one in texts.to_pylist():
                counts = gram_counts(one) if model.languages else None
                if counts is None:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    far.append(True)
                    continue
                at, weights = vector(counts, model.idf)
                cosines = weights.astype(np.float32) @ centroids[at]
                best = int(cosines.argmax())
                scores.append(min(max(float(cosines[best]), 0.0), 1.0))
                far.append(bool(cosines[best] < ROOM * model.least[best]))
                names.append(UNKNOWN if reject and far[-1] else model.languages[best])
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(far, pa.bool_())]

        return run

    return with_arrow_columns(docs, text, PREDICTED, make, keep)
