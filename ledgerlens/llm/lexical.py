"""Ranked lexical search over a length-stratified index (operator 13).

A document's score depends on its length only through its normaliser ``m``, so documents with
the same ``m`` form a stratum. In a stratum the postings of a term are grouped by ``tf``, and
all documents of such a group have the same impact: it is computed once per ``tf``. The
largest ``tf`` of its terms bounds what a stratum can give a query. Strata are visited by
falling bounds, until the bound falls below the query's k-th best score; what ties with it is
still read.

The index holds every document, and of its terms those that the queries hold. Queries are a
stated set and are taken in blocks of bounded size; all tasks search their strata at once,
and the k best of each task meet in a last ranking.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import SLICE_ROWS, staged

#: Normaliser: percent of it that follows the length, and factor of it beside 1000 * tf.
SLOPE, PIVOT_WEIGHT = 90, 8
#: Documents of a task's strata, and of one stratum that are scored at once.
PART_DOCS, CHUNK_DOCS = 8192, 4096
#: Characters of queries that are searched for in one block.
BLOCK_CHARS = 16 << 20
_NO_ID = (1 << 63) - 1

#: ASCII letters and digits (A-Z as a-z) and all bytes of other characters are kept, the rest parts terms.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text, in order, in UTF-8."""
    return (text or "").encode("utf-8").translate(_BYTES).split()


@dataclass
class Queries:
    """A block of queries: their terms numbered, and the numbers of each."""

    ids: list
    terms: dict[bytes, int]
    wanted: list[list[int]]

    @staticmethod
    def of(rows: list[tuple]) -> Queries:
        """Rows of one id are one query with the terms of all."""
        own: dict = {}
        for item, text in rows:
            own.setdefault(item, set()).update(terms_of(text))
        ids = sorted((i for i in own if own[i]), key=lambda i: (i is None, i or 0))
        terms = {t: n for n, t in enumerate(sorted(set().union(*own.values()) if own else ()))}
        return Queries(ids, terms, [sorted(terms[t] for t in own[i]) for i in ids])


COUNTED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.LongType())),
])


def counted(docs: DataFrame, queries: Queries) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every document with a term: its length, and its terms that the queries hold."""
    known = queries.terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                ids, lengths, ends, terms, tfs = [], [], [0], [], []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    words = terms_of(text)
                    if not words:
                        continue
                    seen = Counter(words)
                    shared = seen.keys() & known.keys()
                    ids.append(doc_id)
                    lengths.append(len(words))
                    terms.extend(known[w] for w in shared)
                    tfs.extend(seen[w] for w in shared)
                    ends.append(len(terms))
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64())),
                ], names=COUNTED.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, COUNTED)


class Stratum:
    """Documents with one normaliser: postings by term, then by tf, the largest first."""

    def __init__(self, m: int, docs: np.ndarray, owners: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weighed: np.ndarray):
        self.docs = docs
        order = np.lexsort((owners, -tfs, terms))
        self.places, terms, tfs = owners[order], terms[order], tfs[order]
        new_term = np.flatnonzero(np.concatenate(([True], terms[1:] != terms[:-1]))) if len(terms) else np.zeros(0, np.int64)
        self.terms, self.starts, self.ends = terms[new_term], new_term, np.append(new_term, len(terms))[1:]
        new_tf = np.concatenate(([True], (terms[1:] != terms[:-1]) | (tfs[1:] != tfs[:-1]))) if len(terms) else np.zeros(0, bool)
        once = np.flatnonzero(new_tf)
        impact = (1_000_000_000 * tfs[once]) // (1000 * tfs[once] + PIVOT_WEIGHT * m)
        part = weighed[terms[once]] * impact  # what every posting of a tf group adds
        self.adds = np.repeat(part, np.diff(np.append(once, len(terms))))
        self.most = self.adds[self.starts]  # the largest tf of a term comes first

    def scores(self, wanted: np.ndarray, exact_doubles: bool) -> np.ndarray:
        """Scores of all documents for the places of a query's terms."""
        starts, counts = self.starts[wanted], self.ends[wanted] - self.starts[wanted]
        total = int(counts.sum())
        at = np.arange(total) + np.repeat(starts - (np.cumsum(counts) - counts), counts)
        if exact_doubles:
            return np.bincount(self.places[at], weights=self.adds[at], minlength=len(self.docs)).astype(np.int64)
        out = np.zeros(len(self.docs), dtype=np.int64)
        np.add.at(out, self.places[at], self.adds[at])
        return out


class Best:
    """The k best documents of a query so far, ties to the smaller id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """A score below this cannot enter."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        take = np.flatnonzero(scores >= self.least)
        if not len(take):
            return
        scores, ids = np.concatenate([self.scores, scores[take]]), np.concatenate([self.ids, ids[take]])
        top = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[top], ids[top]


def search_strata(strata: list[Stratum], wanted: list[list[int]], weights: np.ndarray, k: int) -> list[Best]:
    """The k best documents of all strata for every query (lists of term numbers)."""
    exact = max((int(weights[q].sum()) for q in wanted if len(q)), default=0) * 1_000_000 < 1 << 53
    column = np.full(len(weights), -1, dtype=np.int64)
    bounds = np.zeros((len(wanted), len(strata)), dtype=np.int64)
    lists = [np.array(q, dtype=np.int64) for q in wanted]
    for s, stratum in enumerate(strata):
        most = np.zeros(len(weights), dtype=np.int64)
        most[stratum.terms] = stratum.most
        bounds[:, s] = [most[q].sum() for q in lists]
    out = []
    for q, bound in zip(lists, bounds):
        best = Best(k)
        for s in np.argsort(-bound, kind="stable"):
            if bound[s] < best.least:  # nor can any that follows
                break
            stratum = strata[s]
            column[stratum.terms] = np.arange(len(stratum.terms))
            places = column[q]
            column[stratum.terms] = -1
            best.offer(stratum.scores(places[places >= 0], exact), stratum.docs)
        out.append(best)
    return out


FOUND = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])


def _search_block(docs: DataFrame, rows: list[tuple], k: int) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents for the queries of one block."""
    spark, queries = docs.sparkSession, Queries.of(rows)
    table = staged(counted(docs, queries), "counted")
    total = table.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = np.zeros(len(queries.terms), dtype=np.int64)
    for r in table.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():  # the terms of a block
        df[r.term] = r.df
    weights = np.array([floor(1000 * log((2 * total.docs + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)
    wanted = queries.wanted
    normaliser = F.expr(f"{100 - SLOPE} + ({SLOPE} * n * {total.docs}L) div {max(total.terms, 1)}L")
    parts = max(-(-total.docs // PART_DOCS), min(total.docs // 256, 2 * spark.sparkContext.defaultParallelism), 1)
    # a stratum that many documents share is cut by the hash of their ids
    index = table.withColumn("m", normaliser).repartitionByRange(parts, "m", F.xxhash64("doc_id", "terms")).sortWithinPartitions("m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strata: list[Stratum] = []
        held: list[tuple[np.ndarray, ...]] = []
        now, count = None, 0

        def close() -> None:
            ids, sizes, terms, tfs = (np.concatenate([h[i] for h in held]) for i in range(4))
            for at in range(0, len(ids), CHUNK_DOCS):
                own = sizes[at:at + CHUNK_DOCS]
                a, b = int(sizes[:at].sum()), int(sizes[:at].sum() + own.sum())
                strata.append(Stratum(now, ids[at:at + CHUNK_DOCS], np.repeat(np.arange(len(own)), own), terms[a:b], tfs[a:b], weights))

        for batch in batches:
            ids = batch.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False)  # null ids come last
            ms = batch.column(4).to_numpy(zero_copy_only=False)
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            terms, tfs = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (2, 3))
            ends = np.concatenate(([0], np.cumsum(sizes)))
            cuts = np.flatnonzero(np.concatenate(([True], ms[1:] != ms[:-1]))) if len(ms) else np.zeros(0, np.int64)
            for a, b in zip(cuts, np.append(cuts, len(ms))[1:]):
                if held and (ms[a] != now or count >= CHUNK_DOCS):
                    close()
                    held, count = [], 0
                now, count = int(ms[a]), count + int(b - a)
                held.append((ids[a:b], sizes[a:b], terms[ends[a]:ends[b]].astype(np.int64), tfs[ends[a]:ends[b]]))
        if held:
            close()
        for at, best in enumerate(search_strata(strata, wanted, weights, k) if strata else []):
            if len(best.ids):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(best.ids), at), pa.int32()),
                    pa.array(best.ids, pa.int64(), mask=best.ids == _NO_ID), pa.array(best.scores, pa.int64())], names=FOUND.names)

    ranked = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    found = index.select("doc_id", "n", "terms", "tfs", "m").mapInArrow(run, FOUND).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    names = spark.createDataFrame(list(enumerate(queries.ids)), "query int, item_id long")
    return found.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")  # ids of one block


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents (``doc_id, text``) for every item (``item_id, text``).

    Documents without a term are not counted and never found; nor are scores of 0. Ties go to
    the smaller ``doc_id``, null ids last; rows that repeat an id are separate documents.
    Items of one id are one query with the terms of all their texts; null and empty texts add
    none, and an item without terms gives no rows. Extra columns are not carried. Empty
    tables give an empty result. Items beyond ``block_chars`` characters are searched for in
    several blocks, one after the other; statistics are those of all documents in each.
    """
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull()).distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // block_chars) or 1
    docs, out = docs.select("doc_id", "text"), None
    for block in range(blocks):
        rows = [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()]
        found = _search_block(docs, rows, k)
        if blocks > 1:
            found = staged(found, "found")  # the driver holds one block at a time
        out = found if out is None else out.unionByName(found)
    return out
