"""Exact top-k search by inner product (operator 3): columnar branch and bound.

Candidates of a part lie in vertical layout, a row per dimension. For a query the scores of
all candidates grow one block of dimensions at a time, the heaviest blocks of the query
first. What the remaining dimensions can still add is at most the product of the remaining
lengths of the two vectors; candidates whose bound falls below the k-th best lower bound
leave, and the arrays are compacted to those that survive.

Queries are a stated set. Each part of the candidates meets them all; the k best of every
part meet in a last ranking, so nothing is approximate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Candidates that one part holds at most on average (components as doubles, so 64 dimensions take 512 bytes each, and twice as much again while searched).
PART_ROWS = 100_000
BLOCK_DIMS = 8
_MOST = (1 << 63) - 1

#: ``beyond`` orders scores that 64 bits cannot hold; it is null for all others.
FOUND = T.StructType([
    T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.LongType()), T.StructField("beyond", T.BinaryType())])


def _beyond(score: int) -> bytes | None:
    """Bytes in the order of the scores (products of doubles lie within 2^2200), for a score outside 64 bits."""
    return None if -_MOST < score < _MOST else (score + (1 << 2200)).to_bytes(280, "big")


class Candidates:
    """Vectors of one length, transposed, with the squared length of every block of dimensions."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.columns = ids[order], np.ascontiguousarray(rows[order].T.astype(np.float64))
        dims = self.columns.shape[0]
        self.blocks = [slice(i, min(i + BLOCK_DIMS, dims)) for i in range(0, dims, BLOCK_DIMS)]
        self.masses = [np.einsum("ij,ij->j", self.columns[b], self.columns[b]) for b in self.blocks]
        self.mass = sum(self.masses) if self.masses else np.zeros(len(ids))
        self.largest = float(np.abs(self.columns).max()) if self.columns.size else 0.0

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best, ties to the smaller id; the query's own id takes no part."""
        alive = np.flatnonzero(self.ids != query_id)
        exact = self.largest * (np.abs(query).max() if len(query) else 0) * max(len(query), 1) < 2**53
        score = np.zeros(len(alive))
        q = query.astype(np.float64)
        weights = [float(q[b] @ q[b]) for b in self.blocks]
        left, query_left = self.mass[alive], sum(weights)
        noise = np.sqrt(self.mass * query_left) * 1e-12
        for i in sorted(range(len(self.blocks)), key=lambda i: -weights[i]):
            b = self.blocks[i]
            score += q[b] @ (self.columns[b] if len(alive) == len(self.ids) else self.columns[b][:, alive])
            query_left = max(query_left - weights[i], 0.0)
            left = left - self.masses[i][alive]
            if len(alive) > k:
                reach = np.sqrt(query_left * np.maximum(left, 0.0)) * (1 + 1e-9) + 1e-6 + noise[alive]
                low = score - reach
                bar = np.partition(low, len(low) - k)[len(low) - k]
                stay = score + reach >= bar
                if not stay.all():
                    alive, score, left = alive[stay], score[stay], left[stay]
        if not exact and self.largest * (np.abs(query).max() if len(query) else 0) * max(len(query), 1) >= 2**62:
            # products beyond 64 bits: integers of any size for those that are left
            ints = [int(x) for x in query]
            sums = [sum(int(x) * y for x, y in zip(row, ints)) for row in self.columns[:, alive].T]
            top = sorted(range(len(alive)), key=lambda i: (-sums[i], self.ids[alive[i]]))[:k]
            return self.ids[alive][top], np.array([sums[i] for i in top], dtype=object)
        if exact:
            whole = np.rint(score).astype(np.int64)
        else:
            whole = self.columns[:, alive].T.astype(np.int64) @ query.astype(np.int64)
        top = np.lexsort((self.ids[alive], -whole))[:k]
        return self.ids[alive][top], whole[top]


def whole_components(vectors: DataFrame, vec_id: str, column: str, scale: int) -> DataFrame:
    """``id, v``: components as floor(scale * x), integers held as doubles, of the vectors that can take part."""
    x = F.col(column)
    usable = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e.cast("double") * scale) < F.lit(float("inf"))), F.lit(False)))
    # a 64-bit floor would overflow: what is beyond 2^52 has no fraction
    floored = lambda y: F.when(F.abs(y) < float(1 << 52), F.floor(y).cast("double")).otherwise(y)
    return vectors.where(x.isNotNull() & usable & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("id"),
        F.transform(x, lambda e: floored(e.cast("double") * scale)).alias("v"),
    )


def search(vectors: DataFrame, k: int = 10, every: int = 100, vec_id: str = "vec_id", column: str = "embedding", scale: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best candidates of each query.

    Queries are the ids divisible by ``every`` (of rows that share such an id, the smallest
    vector asks), candidates all rows with another id. Vectors that are null, hold null or
    non-finite components or components beyond 2^26 when scaled take no part, nor do null
    ids; only vectors of the same length meet. Rows that repeat an id are separate
    candidates. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    known = whole_components(vectors, vec_id, column, scale)
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-known.count() // PART_ROWS))
    queries = known.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    meet = known.select(F.pmod(F.xxhash64("id", "v"), F.lit(parts)).cast("int").alias("part"), F.lit(0).alias("kind"), "id", "v").unionByName(
        queries.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(1).alias("kind"), "id", "v"))
    dealt = meet.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        ready: dict[int, Candidates] | None = None
        part = None
        for batch in batches:
            parts_, kinds = (batch.column(i).to_numpy() for i in (0, 1))
            ids = batch.column(2).to_numpy()
            lists = batch.column(3)
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            found: list[tuple[int, np.ndarray, np.ndarray]] = []
            for row in range(batch.num_rows):
                if parts_[row] != part:
                    part, held, ready = parts_[row], {}, None
                v = flat[ends[row]:ends[row + 1]]
                if kinds[row] == 0:
                    held.setdefault(len(v), []).append((ids[row], v))
                    continue
                if ready is None:
                    ready = {n: Candidates(np.array([i for i, _ in rows]), np.stack([x for _, x in rows])) for n, rows in held.items()}
                    held = {}
                if len(v) in ready:
                    found.append((ids[row], *ready[len(v)].best(ids[row], v, k)))
            if found:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat([q for q, _, _ in found], [len(i) for _, i, _ in found]).astype(np.int64)),
                    pa.array(np.concatenate([i for _, i, _ in found]).astype(np.int64)),
                    pa.array(np.concatenate([np.clip(s, -_MOST, _MOST).astype(np.int64) for _, _, s in found])),
                    pa.array([_beyond(x) if s.dtype == object else None for _, _, s in found for x in s], pa.binary()),
                ], names=FOUND.names)

    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc_nulls_last("beyond"), "vec_id")
    return dealt.mapInArrow(run, FOUND).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
