"""Benchmark decontamination with an inverted index and block-max WAND (operator 4).

The test items are indexed with BM25 weights, scaled so that an item scores 1 against
itself. Every training text is read in overlapping passages, long enough that an item
lies whole inside one. Each passage queries the index: the block maxima of its words are
summed for every block of items, and only if a block can reach the threshold does block-max
WAND walk the postings, skipping items by the same maxima. All items above the threshold are then verified: the
five-word shingles of question and answer must both be in the passage.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import staged, with_arrow_columns

K1, B = 1.2, 0.75
#: Postings of one block; characters of items in one index.
BLOCK, SHARD_CHARS = 4, 32 << 20
#: Share of an item's own score that a passage must reach, and share of shingles that must be found.
THRESHOLD, OVERLAP, SHINGLE = 0.6, 0.8, 5
_WORD = re.compile(r"\w+")
_END = re.compile(r"[.!?:]\s+|\n+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The words of an item before its last sentence or line, and of that; an item of one sentence is all answer."""
    ends = [m.end() for m in _END.finditer(text.rstrip())]
    cut = ends[-1] if ends else 0
    return words_of(text[:cut]), words_of(text[cut:])


def found_share(part: list[str], passage: list[str], grams: dict[int, set]) -> float:
    """Share of the part's shingles that the passage holds; a short part is one shingle, an empty one is there."""
    if not part:
        return 1.0
    n = min(SHINGLE, len(part))
    if n not in grams:
        grams[n] = set(zip(*(passage[i:] for i in range(n))))
    own = set(zip(*(part[i:] for i in range(n))))
    return len(own & grams[n]) / len(own)


@dataclass
class Statistics:
    """Of all items: how many have words, their words in all, the words of the longest, and how many items hold each word."""

    items: int
    words: int
    longest: int
    holding: dict[str, int]

    @staticmethod
    def of(texts: list[list[str]]) -> Statistics:
        sizes = [len(words) for words in texts]
        return Statistics(len(texts), sum(sizes), max(sizes, default=0), dict(Counter(w for words in texts for w in set(words))))


class ImpactIndex:
    """Postings with scaled BM25 weights, in order of item, with the largest weight of every block."""

    def __init__(self, items: list[tuple[int | None, str]], statistics: Statistics | None = None):
        """``statistics`` are those of all items where ``items`` are a part of them."""
        texts = [(i, t, words_of(t)) for i, t in items]
        texts = sorted((x for x in texts if x[2]), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        self.item_ids = [i for i, _, _ in texts]
        self.parts = [question_and_answer(t) for _, t, _ in texts]
        of_all = statistics or Statistics.of([w for _, _, w in texts])
        self.longest = of_all.longest
        mean, seen = of_all.words / of_all.items if of_all.items else 1, of_all.holding
        if statistics:
            own = {w for _, _, words in texts for w in words}
            seen = {w: n for w, n in seen.items() if w in own}
        idf = {w: log(1 + (of_all.items - n + 0.5) / (n + 0.5)) for w, n in seen.items()}
        lists: dict[str, tuple[list[int], list[float]]] = {w: ([], []) for w in sorted(seen)}
        for at, (_, _, words) in enumerate(texts):
            weight = {}
            for w in words:
                weight[w] = weight.get(w, 0) + 1
            for w, n in weight.items():
                weight[w] = idf[w] * n * (K1 + 1) / (n + K1 * (1 - B + B * len(words) / mean))
            whole = sum(weight.values())
            for w, x in weight.items():
                lists[w][0].append(at)
                lists[w][1].append(x / whole)
        self.terms = {w: i for i, w in enumerate(lists)}
        self.postings = []
        for places, weights in lists.values():
            cuts = range(0, len(places), BLOCK)
            self.postings.append((places, weights, [max(weights[i:i + BLOCK]) for i in cuts], max(weights)))
        # for whole passages at once: each term's largest weight in every block of items it occurs in
        entries = [(t, at // BLOCK, w) for t, (places, weights, _, _) in enumerate(self.postings) for at, w in zip(places, weights)]
        term, block, weight = (np.array(x, dtype=k) for x, k in zip(zip(*entries) if entries else ((), (), ()), (np.int64, np.int64, float)))
        first = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])))) if len(term) else np.zeros(0, np.int64)
        self.item_blocks = block[first]
        self.block_most = np.maximum.reduceat(weight, first) if len(first) else weight
        self.block_count = np.bincount(term[first], minlength=len(self.postings))
        self.block_start = np.cumsum(self.block_count) - self.block_count

    def can_reach(self, terms: np.ndarray, threshold: float) -> bool:
        """Whether the distinct terms could score the threshold against an item of some block."""
        count = self.block_count[terms]
        total = int(count.sum())
        if not total:
            return False
        skipped = self.block_start[terms] - (np.cumsum(count) - count)
        at = np.arange(total) + np.repeat(skipped, count)
        return np.bincount(self.item_blocks[at], weights=self.block_most[at]).max() >= threshold - 1e-6

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """Place and score of every item that scores at least the threshold against the distinct terms."""
        least, out = threshold - 1e-9, []
        cursors = [[*self.postings[t], 0] for t in terms]  # places, weights, block maxima, maximum, position
        while True:
            cursors = sorted((c for c in cursors if c[4] < len(c[0])), key=lambda c: c[0][c[4]])
            bound, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                bound += c[3]
                if bound >= least:
                    pivot = i
                    break
            if pivot < 0:
                return out
            item = cursors[pivot][0][cursors[pivot][4]]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0][cursors[pivot + 1][4]] == item:
                pivot += 1
            bound, ends = 0.0, len(self.item_ids)
            for c in cursors[:pivot + 1]:
                block = self._forward(c, item)
                if block < len(c[2]):
                    bound += c[2][block]
                    ends = min(ends, c[0][min((block + 1) * BLOCK, len(c[0])) - 1] + 1)
            if bound >= least:
                at = [c for c in cursors[:pivot + 1] if c[4] < len(c[0]) and c[0][c[4]] == item]
                score = sum(c[1][c[4]] for c in at)
                if score >= least:
                    out.append((item, score))
                target = item + 1
            else:
                after = cursors[pivot + 1][0][cursors[pivot + 1][4]] if pivot + 1 < len(cursors) else len(self.item_ids)
                target = max(item + 1, min(ends, after))
            for c in cursors[:pivot + 1]:
                self._forward(c, target)

    @staticmethod
    def _forward(c: list, item: int) -> int:
        """Moves a cursor to the first place from ``item`` on, whole blocks first; returns its block."""
        places, at = c[0], c[4]
        while at < len(places) and places[at] < item:
            ahead = (at // BLOCK + 1) * BLOCK
            at = ahead if ahead <= len(places) and places[ahead - 1] < item else at + 1
        c[4] = at
        return at // BLOCK if at < len(places) else len(c[2])

    def matches(self, text: str | None) -> list[tuple[int, float, float, float]]:
        """Item, score, question overlap and answer overlap of every verified item of a whole text; the best passage of each."""
        words = words_of(text)
        if not words or not self.item_ids:
            return []
        get = self.terms.get
        terms = np.fromiter(map(get, words, repeat(len(self.terms))), dtype=np.int64, count=len(words))
        starts = np.arange(0, max(len(words) - self.longest, 1), self.longest)
        ends = np.minimum(starts + 2 * self.longest, len(words))
        best: dict[int, tuple[float, float, float]] = {}
        for i in range(len(starts)):
            known = np.unique(terms[starts[i]:ends[i]])
            if known[-1] == len(self.terms):  # words of no item
                known = known[:-1]
            if not self.can_reach(known, THRESHOLD):
                continue
            passage, grams = words[starts[i]:ends[i]], {}
            for at, score in self.search(known.tolist(), THRESHOLD):
                question, answer = (found_share(p, passage, grams) for p in self.parts[at])
                if question >= OVERLAP and answer >= OVERLAP:
                    best[at] = max(best.get(at, (0.0, 0.0, 0.0)), (score, question, answer))
        return [(self.item_ids[at], *best[at]) for at in sorted(best)]


_MATCH = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()),
    T.StructField("question_overlap", T.DoubleType()), T.StructField("answer_overlap", T.DoubleType()),
])
MATCHES = T.StructType([T.StructField("matches", T.ArrayType(_MATCH))])
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())]))


def _counted(items: DataFrame) -> DataFrame:
    """``word, n, words, longest``: the items that hold each word; the null word has the figures of all items together."""
    schema = T.StructType([T.StructField("word", T.StringType())] + [T.StructField(n, T.LongType()) for n in ("n", "words", "longest")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Statistics.of([w for w in map(words_of, batch.column(0).to_pylist()) if w])
            yield pa.RecordBatch.from_arrays([
                pa.array([None, *found.holding], pa.string()), pa.array([found.items, *found.holding.values()], pa.int64()),
                *[pa.array([x] + [0] * len(found.holding), pa.int64()) for x in (found.words, found.longest)]], names=schema.names)

    return items.select("text").mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"), F.sum("words").alias("words"), F.max("longest").alias("longest"))


def _indexes(items: DataFrame) -> Iterator[tuple[ImpactIndex, bool]]:
    """The items in indexes of about ``SHARD_CHARS`` characters, one after the other, and whether one is the last.

    Weights come from the statistics of all items, so they do not depend on how items are dealt.
    The driver holds one index at a time, and the counts of its words.
    """
    clean = items.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    chars = clean.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // SHARD_CHARS) or 1
    if n == 1:
        yield ImpactIndex([tuple(r) for r in clean.collect()]), True
        return
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    clean = staged(clean.withColumn("shard", shard), "items")
    counts = staged(_counted(clean), "item-words")
    total = counts.where("word IS NULL").agg(*[F.coalesce(F.max(x), F.lit(0)).alias(x) for x in ("n", "words", "longest")]).first()
    for i in range(n):
        own = [tuple(r) for r in clean.where(F.col("shard") == i).select("item_id", "text").collect()]
        here = _counted(clean.where(F.col("shard") == i)).where("word IS NOT NULL").select("word")
        holding = dict(counts.join(here, "word", "left_semi").select("word", "n").collect())
        yield ImpactIndex(own, Statistics(total.n, total.words, total.longest, holding)), i == n - 1


def with_matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` with ``matches``: item, score and overlaps of every item found in the whole text.

    Every column and row of ``docs`` stays (one called ``matches`` is replaced). Null and
    empty texts, and items without words, match nothing; rows of one item id with different
    texts are separate items, and items without an id are found under a null one. Empty tables
    give no matches.
    """
    out = None
    for index, last in _indexes(items):
        def make(index=index):
            return lambda texts: [pa.array([
                [dict(zip(_MATCH.names, m)) for m in index.matches(t)] for t in texts.to_pylist()], _ARROW)]

        if out is None:
            out = with_arrow_columns(docs, "text", MATCHES, make)
        else:  # a further index: its matches join those before
            more = with_arrow_columns(out.withColumnRenamed("matches", "__before"), "text", MATCHES, make)
            out = more.withColumn("matches", F.concat("__before", "matches")).drop("__before")
        if not last:
            out = staged(out, "matched")
    return out


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap``: a row per document and item found in it."""
    return with_matches(docs.select("doc_id", "text"), items).select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which no item was found, with their columns."""
    return with_matches(docs, items).where(F.size("matches") == 0).select(*docs.columns)
