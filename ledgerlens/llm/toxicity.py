"""Toxicity after deobfuscation (operator 5).

Noisy channel: somebody writes a word and disguises it with look-alike characters, spaced
letters or repeated letters. Each disguised stretch becomes a lattice: a character stands
for itself, for the letters it looks like, or for nothing; a run of one letter for one or
two of it; a gap between single letters for a word border or for nothing. The cheapest
path under a character trigram model is the restored text. The model's counts come from
all documents. A stretch that shows no sign of disguise has one path and stays as it is.

The restored words are scored with weights learnt from labelled documents, and the score
is calibrated on labelled documents that gave no weights.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import with_arrow_columns
from ledgerlens.llm.quality import class_sizes, labelled_ids, logistic_fit

#: Labelled documents of each class that the fit may take at most; words that it may keep.
SAMPLE_DOCS, LEXICON_WORDS = 6000, 20_000
#: A word needs this many labelled documents to get a weight.
LEAST_DOCS = 5
#: Words that a worker remembers; it starts anew beyond them.
REMEMBERED = 400_000
# Letters that digits and signs are written for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "£": "l",
}
#: Costs (negative log probabilities) of what the channel does.
AS_LETTER, SIGN_DROPPED, DIGIT_DROPPED, RUN_TO_TWO = 1.0, 2.0, 5.0, 0.7
_FRONT, _BACK = "\"'([{<*#%&-_.,;:?~=/\\", "\"')]}>*#%&-_.,;:!?~=/\\$"
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_SPACED = re.compile(r"(?<!\S)[^\W_](?:[ .\-_*][^\W_]){2,}(?!\S)")
SYMBOLS = 27  # a-z and the border of a word


def _classes() -> np.ndarray:
    """The symbol of every code point below 0x250; accents count as their letter."""
    out = np.zeros(0x250, dtype=np.int64)
    for i in range(0x250):
        base = unicodedata.normalize("NFD", chr(i).lower())[:1]
        if "a" <= base <= "z":
            out[i] = ord(base) - 96
    return out


def symbols(text: str, classes: np.ndarray) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(points < 0x250, classes[np.minimum(points, 0x24F)], 0)


def count_trigrams(docs: DataFrame, column: str = "text") -> np.ndarray:
    """Trigrams of symbols over the whole texts of all documents: ``SYMBOLS ** 3`` numbers whatever the input."""
    schema = T.StructType([T.StructField("gram", T.IntegerType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, total = _classes(), np.zeros(SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                s = symbols("  ".join(t or "" for t in batch.column(0).slice(at, 256).to_pylist()), classes)
                if len(s) > 2:
                    total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=len(total))
        grams = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(grams.astype(np.int32)), pa.array(total[grams])], names=schema.names)

    rows = docs.select(column).mapInArrow(run, schema).groupBy("gram").agg(F.sum("n").alias("n")).collect()  # SYMBOLS ** 3 at most
    out = np.zeros(SYMBOLS**3)
    for gram, n in rows:
        out[gram] = n
    return out


def trigram_costs(counts: np.ndarray) -> np.ndarray:
    """Negative log probability of a symbol after two others, smoothed with the shorter contexts."""
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + SYMBOLS)
    p2 = (two + 50 * p1) / (two.sum(axis=1, keepdims=True) + 50)
    p3 = (three + 50 * p2[None]) / (three.sum(axis=2, keepdims=True) + 50)
    return -np.log(p3)


class Restorer:
    """Viterbi decoding of disguised words under the trigram costs."""

    def __init__(self, costs: np.ndarray):
        self.costs = costs.tolist()
        self.classes = _classes()

    def _letter(self, c: str) -> int:
        return int(self.classes[ord(c)]) if ord(c) < 0x250 else 0

    def _choices(self, word: str) -> list[list[tuple[tuple[int, ...], float]]]:
        """For each position of the lattice what it may be, with the channel's cost."""
        out, at = [], 0
        while at < len(word):
            c = word[at]
            run = at
            while run < len(word) and word[run] == c:
                run += 1
            letter, n, at = self._letter(c), run - at, run
            if c == " ":
                out.append([((), 0.0), ((0,), 0.0)])
            elif letter and n > 2:
                out.append([((letter,), 0.0), ((letter, letter), RUN_TO_TWO)])
            elif letter:
                out.extend([[((letter,), 0.0)]] * n)
            elif n > 2:  # a run of one sign or digit counts once
                out.append([((), SIGN_DROPPED)] + [((ord(x) - 96,), AS_LETTER) for x in LOOKS_LIKE.get(c, "")])
            else:
                drop = DIGIT_DROPPED if c.isdigit() else SIGN_DROPPED
                out.extend([[((), drop)] + [((ord(x) - 96,), AS_LETTER) for x in LOOKS_LIKE.get(c, "")]] * n)
        return out

    def decode(self, word: str) -> str:
        """The restored letters of a disguised stretch (in lower case), words parted by spaces."""
        costs = self.costs
        paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for choices in self._choices(word) + [[((0,), 0.0)]]:
            following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, trail) in paths.items():
                for letters, channel in choices:
                    x, y, total, path = a, b, cost + channel, trail
                    for s in letters:
                        if s or y:  # no empty words
                            total += costs[x][y][s]
                            x, y, path = y, s, (s, path)
                    if (x, y) not in following or total < following[x, y][0]:
                        following[x, y] = (total, path)
            paths = following
        _, trail = min(paths.values(), key=lambda v: v[0])
        out = []
        while trail:
            out.append(chr(trail[0] + 96) if trail[0] else " ")
            trail = trail[1]
        return "".join(reversed(out)).strip()

    def word(self, word: str) -> str:
        """A word of the text (lower case, no white space) without its disguise."""
        if word.isalpha() and not _TRIPLE.search(word):
            return word
        bare = word.rstrip(_BACK)
        if (bare.lstrip(_FRONT).isalpha() or not bare) and not _TRIPLE.search(bare):
            return bare.lstrip(_FRONT)
        if not any(c.isalpha() for c in bare) and not any(c in LOOKS_LIKE for c in bare):
            return ""
        return self.decode(bare.lstrip(_FRONT))


class Restored(dict):
    """Restored words met so far; bounded."""

    def __init__(self, restorer: Restorer):
        super().__init__()
        self.restorer = restorer

    def __missing__(self, word: str) -> str:
        if len(self) >= REMEMBERED:
            self.clear()
        out = self.restorer.word(word)
        if len(word) < 64:
            self[word] = out
        return out

    def text(self, text: str | None) -> str:
        low = (text or "").lower()
        if _SPACED.search(low):
            low = _SPACED.sub(lambda m: self.restorer.decode(re.sub(r"[.\-_*]", " ", m[0])), low)
        return " ".join(map(self.__getitem__, low.split()))


def restore(docs: DataFrame, costs: np.ndarray, column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``restored``: the whole text in lower case, words parted by single spaces, disguises undone."""

    def make():
        known = Restored(Restorer(costs))
        return lambda texts: [pa.array([known.text(t) for t in texts.to_pylist()], pa.string())]

    return with_arrow_columns(docs, column, T.StructType([T.StructField("restored", T.StringType())]), make, keep)


@dataclass
class ToxicityModel:
    costs: np.ndarray
    lexicon: dict = field(default_factory=dict)
    mean: list = field(default_factory=lambda: [0.0] * 4)
    scale: list = field(default_factory=lambda: [1.0] * 4)
    weights: list = field(default_factory=lambda: [0.0] * 5)


FEATURES = T.StructType([T.StructField("features", T.ArrayType(T.DoubleType())), T.StructField("score", T.DoubleType())])


def _features(words: set[str], lexicon: dict) -> list[float]:
    found = sorted((lexicon[w] for w in words if w in lexicon), reverse=True)
    high = [w for w in found if w > 0]
    return [high[0] if high else 0.0, sum(high[1:4]), float(np.log1p(len(words))), sum(found) / (1 + len(words))]


def score(docs: DataFrame, model: ToxicityModel, column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: rather toxic) of the restored whole text, and the ``features`` behind it.

    Null texts are scored as empty ones.
    """
    def make():
        known = Restored(Restorer(model.costs))
        mean, scale, weights = (np.array(x) for x in (model.mean, model.scale, model.weights))

        def run(texts: pa.Array) -> list[pa.Array]:
            rows = [_features(set(known.text(t).split(" ")), model.lexicon) for t in texts.to_pylist()]
            z = ((np.array(rows).reshape(-1, 4) - mean) / scale) @ weights[1:] + weights[0]
            return [pa.array(rows, pa.list_(pa.float64())), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))]

        return run

    return with_arrow_columns(docs, column, FEATURES, make, keep)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> ToxicityModel:
    """Counts trigrams over all documents; learns word weights from one half of the sampled labels, the calibration from the other.

    With too few labels of a class the score is their share.
    """
    model = ToxicityModel(trigram_costs(count_trigrams(docs)))
    ids = labelled_ids(labels, label, SAMPLE_DOCS)
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most 2 * SAMPLE_DOCS ids
    half = F.pmod(F.xxhash64("text"), F.lit(2))  # copies of a text count once, and in one half
    sample = sample.dropDuplicates(["label", "text"]).select("text", "label", half.alias("half"))
    restored = restore(sample.where("half = 0"), model.costs)
    seen = restored.select("label", F.explode(F.array_distinct(F.split("restored", " "))).alias("word")).where(F.length("word") > 0)
    n = dict(restored.groupBy("label").count().collect())
    if len(n) == 2:
        a, b = F.sum("label"), F.sum(1 - F.col("label"))
        words = seen.groupBy("word").agg(a.alias("p"), b.alias("q")).where(F.col("p") + F.col("q") >= LEAST_DOCS)
        odds = F.log((F.col("p") + 0.5) / (n[1] + 1)) - F.log((F.col("q") + 0.5) / (n[0] + 1))
        z = odds / F.sqrt(1 / (F.col("p") + 0.5) + 1 / (F.col("q") + 0.5))
        kept = words.select("word", (odds * F.least(F.abs(z) / 4, F.lit(1.0))).alias("w"), F.abs(z).alias("z"))
        model.lexicon = {w: x for w, x, _ in kept.orderBy(F.desc("z"), "word").limit(LEXICON_WORDS).collect()}
    known = score(sample.where("half = 1"), model, keep=["label"]).select("label", "features").limit(4 * SAMPLE_DOCS).toPandas()
    y = known["label"].to_numpy(dtype=float)
    if not model.lexicon or len(set(y)) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        model.weights = [float(np.log(share / (1 - share))), *[0.0] * 4]
        return model
    x = np.array(known["features"].tolist())
    model.mean, model.scale = x.mean(axis=0).tolist(), np.maximum(x.std(axis=0), 1e-9).tolist()
    w = logistic_fit((x - model.mean) / model.scale, y)
    sizes = class_sizes(labels, label)
    w[0] += np.log(sizes[1] / sizes[0]) - np.log(y.sum() / (len(y) - y.sum()))  # the sample has classes of other sizes
    model.weights = w.tolist()
    return model
