"""Vector code compression (operator 12): product codes by exact k-means with Drake-Hamerly bounds.

Vectors are cut into parts; every part gets the index of its codebook's nearest entry. Each
part keeps, beside its code, an upper bound of the distance to its entry, its ``b`` closest
other entries with ordered lower bounds, and one outer bound for all the rest. When entries
move, the bounds move with them. Where the upper bound lies below all lower ones, nothing is
computed; else the entries up to the first bound that rules out the rest are compared, and
all entries only if none does. What bounds leave open is decided by integer distances, so the
codes are those of the plain algorithm. After each round ``b`` follows the depth that the
parts needed.

The state of a round is a written table; sums per entry are added up by Spark, and only the
codebooks come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import discard, staged

#: Parts of a vector, entries of a codebook, rounds that move the entries, factor of the components.
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Closest entries that a part keeps at first, at least and at most.
FIRST_B, LEAST_B, MOST_B = 16, 4, 64
#: Share of parts that the kept entries must settle; full scans beyond the other share double ``b``.
SETTLED, SCANNED = 0.99, 0.02
#: Rows computed at once: ``ROWS`` times ``ENTRIES`` distances are held.
ROWS = 2048
#: Distinct labels that are broadcast with their totals; more are joined by shuffle, hot labels over ``SALTS`` tasks.
BROADCAST_LABELS, SALTS = 100_000, 64
_LIMB = 40
_LONGEST = (1 << 63) - 1


def record(b: int) -> np.dtype:
    """The bounds of one part."""
    return np.dtype([("code", "u1"), ("upper", "<f4"), ("outer", "<f4"), ("ids", "u1", (b,)), ("low", "<f4", (b,))])


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype("<f4"), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    near = np.maximum(np.nextafter(x.astype("<f4"), np.float32(-np.inf)), np.float32(0))
    return np.where(np.isinf(x), np.float32(np.inf), near)


def _whole(x: np.ndarray, width: int) -> np.ndarray:
    """Integer-valued doubles as integers: of 64 bits where squared distances fit them, else of any size."""
    if not x.size or np.abs(x).max() <= isqrt((1 << 61) // max(width, 1)) // 2:
        return x.astype(np.int64)
    return np.array([int(e) for e in x.ravel()], dtype=object).reshape(x.shape)


def _roots(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2.astype(np.float64))


class Codebook:
    """The entries of one part position, and how far each moved in the round before."""

    def __init__(self, entries: list[list[int]], moves: list[float] | None = None):
        small = all(abs(x) <= isqrt((1 << 61) // max(len(e), 1)) // 2 for e in entries for x in e)
        self.entries = np.array(entries, dtype=np.int64 if small else object).reshape(len(entries), -1)
        self.moves = np.array(moves if moves is not None else [0.0] * len(entries))
        self.width = self.entries.shape[1]
        self.squares = (self.entries * self.entries).sum(axis=1) if self.width else np.zeros(len(entries), dtype=np.int64)
        self.largest = int(np.abs(self.entries).max()) if self.entries.size else 0

    def all(self, x: np.ndarray) -> np.ndarray:
        """Exact squared distances of every row to every entry."""
        if x.dtype != object and self.entries.dtype != object:
            largest = max(self.largest, int(np.abs(x).max()) if x.size else 0)
            if 4 * max(self.width, 1) * largest * largest < 1 << 53:  # exact in doubles, and much faster there
                inner = x.astype(np.float64) @ self.entries.T.astype(np.float64)
                return ((x * x).sum(axis=1)[:, None] + self.squares[None, :]) - 2 * inner.astype(np.int64)
        out = [((x - e) ** 2).sum(axis=1) if self.width else np.zeros(len(x), np.int64) for e in self.entries]
        return np.stack(out, axis=1)

    def some(self, x: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Exact squared distances of every row to its own choice of entries."""
        if not self.width:
            return np.zeros(ids.shape, np.int64)
        return ((x[:, None, :] - self.entries[ids]) ** 2).sum(axis=2)


def scan(x: np.ndarray, book: Codebook, b: int) -> np.ndarray:
    """Fresh bounds from the distances to all entries."""
    out = np.zeros(len(x), dtype=record(b))
    d2, k = book.all(x), len(book.entries)
    best = np.argmin(d2, axis=1)  # the first of equals
    rows = np.arange(len(x))
    roots = _roots(d2)
    out["code"], out["upper"] = best, _up(roots[rows, best])
    out["outer"], out["low"], out["ids"] = np.inf, np.inf, best[:, None]
    roots[rows, best] = -1.0
    if k > b + 1:
        near = np.argpartition(roots, (b, b + 1), axis=1)
        out["outer"] = _down(np.take_along_axis(roots, near[:, b + 1:b + 2], axis=1)[:, 0])
        near = near[:, :b + 1]
    else:
        near = np.broadcast_to(np.arange(k), (len(x), k))
    reach = np.take_along_axis(roots, near, axis=1)
    order = np.argsort(reach, axis=1)[:, 1:]  # the entry itself comes first
    out["ids"][:, :order.shape[1]] = np.take_along_axis(near, order, axis=1)
    out["low"][:, :order.shape[1]] = _down(np.take_along_axis(reach, order, axis=1))
    return out


def fitted(state: np.ndarray, b: int) -> np.ndarray:
    """The bounds with room for another number of closest entries; those that leave lower the outer bound."""
    had = state["low"].shape[1]
    if had == b:
        return state.copy()
    out = np.zeros(len(state), dtype=record(b))
    out["code"], out["upper"], out["outer"] = state["code"], state["upper"], state["outer"]
    keep = min(had, b)
    out["ids"], out["low"] = state["code"][:, None], np.inf
    out["ids"][:, :keep], out["low"][:, :keep] = state["ids"][:, :keep], state["low"][:, :keep]
    if had > b:
        out["outer"] = np.minimum(out["outer"], state["low"][:, b:].min(axis=1))
    return out


def moved(x: np.ndarray, state: np.ndarray, book: Codebook, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The bounds after the entries moved, and the depth that each row needed (``b + 1``: all entries)."""
    out = fitted(state, b)
    upper = out["upper"] + book.moves[out["code"]]
    low = out["low"] - book.moves[out["ids"]]
    outer = out["outer"] - book.moves.max()
    order = np.argsort(low, axis=1, kind="stable")
    low, out["ids"] = np.take_along_axis(low, order, axis=1), np.take_along_axis(out["ids"], order, axis=1)
    rest = np.minimum(np.concatenate([low, outer[:, None]], axis=1), outer[:, None])  # of all entries from a place on
    rest -= 1e-9 * np.abs(np.where(np.isfinite(rest), rest, 0.0))
    depth = np.zeros(len(x), dtype=np.int64)
    open_ = np.flatnonzero(upper * (1 + 1e-9) >= rest[:, 0])
    if len(open_):  # a tight upper bound may do
        upper[open_] = _up(_roots(book.some(x[open_], out["code"][open_, None].astype(np.int64))[:, 0]))
        open_ = open_[upper[open_] * (1 + 1e-9) >= rest[open_, 0]]
    out["upper"], out["low"], out["outer"] = _up(upper), _down(low), _down(outer)
    if not len(open_):
        return out, depth
    sure = upper[open_, None] * (1 + 1e-9) < rest[open_]
    depth[open_] = np.where(sure.any(axis=1), sure.argmax(axis=1), b + 1)
    listed, all_ = open_[depth[open_] <= b], open_[depth[open_] > b]
    if len(listed):
        deep = int(depth[listed].max())
        ids = np.concatenate([out["code"][listed, None], out["ids"][listed, :deep]], axis=1).astype(np.int64)
        d2 = book.some(x[listed], ids)
        # rows need no more than their own depth, but all distances that were computed serve as bounds
        rank = np.lexsort((ids, d2)) if d2.dtype != object else np.array([sorted(range(deep + 1), key=lambda j: (d[j], i[j])) for d, i in zip(d2, ids)])
        ids, roots = np.take_along_axis(ids, rank, axis=1), _roots(np.take_along_axis(d2, rank, axis=1))
        out["code"][listed], out["upper"][listed] = ids[:, 0], _up(roots[:, 0])
        out["ids"][listed, :deep], out["low"][listed, :deep] = ids[:, 1:], _down(roots[:, 1:])
    if len(all_):
        out[all_] = scan(x[all_], book, b)
    return out, depth


@dataclass
class Codebooks:
    """Codebooks of all parts: integer components by part, entry and position."""

    entries: list[list[list[int]]]

    def digest(self) -> str:
        return sha256(",".join(str(x) for part in self.entries for e in part for x in e).encode()).hexdigest()

    def after(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> tuple[Codebooks, list[list[float]]]:
        """The entries replaced by the floored means of their parts, and how far each moved, rounded up."""
        new, moves = [], []
        for part, book in enumerate(self.entries):
            new.append([[s // sums[part, i][0] for s in sums[part, i][1]] if (part, i) in sums else e for i, e in enumerate(book)])
            moves.append([float(np.sqrt(float(sum((x - y) ** 2 for x, y in zip(a, e))))) * (1 + 1e-9) for a, e in zip(new[-1], book)])
        return Codebooks(new), moves


def usable(vectors: DataFrame, vec_id: str = "vec_id", column: str = "embedding", label: str = "label") -> DataFrame:
    """``id, v, label`` of the vectors whose scaled components are all finite; ``label`` is null where there is no such column."""
    fine = F.forall(column, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e.cast("double") * SCALE) < F.lit(float("inf"))), F.lit(False)))
    kept = vectors.where(F.col(column).isNotNull() & fine)
    named = F.col(label) if label in vectors.columns else F.lit(None).cast("int")
    return kept.select(F.col(vec_id).cast("long").alias("id"), F.col(column).alias("v"), named.alias("label"))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors of a batch as integer-valued doubles, padded with zeros to parts of ``width``."""
    rows = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.floor(flat.reshape(rows, -1) * SCALE) if rows else np.zeros((0, 0))
    out = np.zeros((rows, PARTS * width))
    out[:, :x.shape[1]] = x
    return out


def _initial(known: DataFrame) -> tuple[Codebooks, int, int]:
    """The codebooks of the smallest ids, the length of vectors, and the width of a part."""
    first = known.orderBy(F.col("id").asc_nulls_last(), "v").limit(ENTRIES).select("v").collect()
    size = len(first[0].v) if first else 0
    width = -(-size // PARTS)
    rows = [[int(np.floor(float(x) * SCALE)) for x in r.v] + [0] * (PARTS * width - size) for r in first if len(r.v) == size]
    return Codebooks([[r[p * width:(p + 1) * width] for r in rows] for p in range(PARTS)]), size, width


def _assign(state: DataFrame, books: Codebooks, moves, b_before: int | None, b: int, width: int, last: bool = False) -> DataFrame:
    """The next state: ``id, label, v, bounds, deepest, scans``; with ``last`` the codes and exact errors instead."""
    kinds = {f.name: f for f in state.schema.fields}
    head = [T.StructField("id", T.LongType()), T.StructField("label", kinds["label"].dataType)]
    schema = T.StructType(head + ([T.StructField("code", T.StringType()), T.StructField("error", T.LongType())] if last else [
        kinds["v"], T.StructField("bounds", T.BinaryType()), T.StructField("deepest", T.IntegerType()), T.StructField("scans", T.IntegerType())]))
    entries, moves = books.entries, moves or [None] * PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = [Codebook(e, m) for e, m in zip(entries, moves)]
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                n, columns = batch.num_rows, dict(zip(batch.schema.names, batch.columns))
                x = _matrix(columns["v"], width)
                if b_before is not None:
                    before = np.frombuffer(b"".join(columns["bounds"].to_pylist()), dtype=record(b_before)).reshape(n, PARTS)
                after, deepest, scans = np.zeros((n, PARTS), dtype=record(b)), np.zeros(n, np.int32), np.zeros(n, np.int32)
                error = np.zeros(n, dtype=object)
                for p, book in enumerate(made):
                    part = _whole(x[:, p * width:(p + 1) * width], width)
                    if b_before is None:
                        after[:, p] = scan(part, book, b)
                        continue
                    after[:, p], depth = moved(part, before[:, p], book, b)
                    deepest, scans = np.maximum(deepest, np.where(depth <= b, depth, 0)), scans + (depth > b)
                    if last:
                        error += book.some(part, after["code"][:, p, None].astype(np.int64))[:, 0]
                if last:
                    codes = [c.tobytes().hex() for c in np.ascontiguousarray(after["code"])]
                    tail = [pa.array(codes, pa.string()), pa.array([min(int(e), _LONGEST) for e in error], pa.int64())]
                else:
                    flat = after.reshape(n, PARTS)
                    tail = [columns["v"], pa.array([r.tobytes() for r in flat], pa.binary()), pa.array(deepest, pa.int32()), pa.array(scans, pa.int32())]
                yield pa.RecordBatch.from_arrays([columns["id"], columns["label"], *tail], names=schema.names)

    return state.mapInArrow(run, schema)


def _sums(state: DataFrame, b: int, width: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Number and componentwise sum of the parts of every entry. Tasks add up their rows; values beyond 2^40 go in limbs."""
    names = [f"s{i}" for i in range(width)]
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("part", "entry", "limb", "n", *names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int, int], np.ndarray] = {}

        def add(key, row):
            counts[key] = counts[key] + row if key in counts else row

        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                x = _matrix(batch.column(0), width)
                codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=record(b)).reshape(batch.num_rows, PARTS)["code"]
                for p in range(PARTS):
                    part = x[:, p * width:(p + 1) * width]
                    order = np.argsort(codes[:, p], kind="stable")
                    own = codes[order, p]
                    cuts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.zeros(0, np.int64)
                    n = np.diff(np.append(cuts, len(own)))
                    if not part.size or np.abs(part).max() < 1 << _LIMB:
                        sums = np.add.reduceat(part[order].astype(np.int64), cuts, axis=0)
                        for i, c in enumerate(cuts):
                            add((p, int(own[c]), 0), np.concatenate(([n[i]], sums[i])))
                        continue
                    for i, c in enumerate(cuts):
                        total = [sum(int(v) for v in col) for col in part[order[c:c + n[i]]].T]
                        limb, count = 0, int(n[i])
                        while limb == 0 or any(total):
                            low = [t & ((1 << _LIMB) - 1) for t in total]
                            total = [t >> _LIMB for t in total]
                            if all(t == -1 for t in total if t) and any(total):  # the sign of negative sums stays with their last limb
                                low, total = [v + (t << _LIMB) for v, t in zip(low, total)], [0] * len(total)
                            add((p, int(own[c]), limb), np.array([count, *low], dtype=np.int64))
                            limb, count = limb + 1, 0
        if counts:
            keys = sorted(counts)
            rows = np.array([[*k, *counts[k]] for k in keys], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows.T], names=schema.names)

    added = state.select("v", "bounds").mapInArrow(run, schema).groupBy("part", "entry", "limb").agg(*[F.sum(n).alias(n) for n in ("n", *names)])
    out: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for r in added.collect():  # at most PARTS * ENTRIES rows and a few limbs
        n, total = out.get((r.part, r.entry), (0, [0] * width))
        out[r.part, r.entry] = n + r.n, [t + (r[i] << (_LIMB * r.limb)) for t, i in zip(total, names)]
    return out


def _next_b(state: DataFrame, b: int) -> int:
    """The number of closest entries that settles ``SETTLED`` of the rows; twice as many if too many parts saw all entries."""
    depths = {r.deepest: (r.n, r.scans) for r in state.groupBy("deepest").agg(F.count(F.lit(1)).alias("n"), F.sum("scans").alias("scans")).collect()}
    rows = sum(n for n, _ in depths.values())
    if sum(s for _, s in depths.values()) > SCANNED * PARTS * rows:
        return min(2 * b, MOST_B)
    seen = 0
    for depth in sorted(depths):
        seen += depths[depth][0]
        if seen >= SETTLED * rows:
            return max(LEAST_B, min(depth + 1, b))
    return b


def compress(vectors: DataFrame, vec_id: str = "vec_id", column: str = "embedding", label: str = "label") -> tuple[DataFrame, Codebooks]:
    """``id, label, code, error`` for every usable vector, and the final codebooks.

    Components become ``floor(SCALE * x)``. Vectors that are null or hold null or non-finite
    components take no part (nor do components that leave the range of doubles when scaled),
    nor do those of another length than the vector with the smallest id. Vectors whose length
    is no multiple of ``PARTS`` are padded with zeros. The first entries are the parts of the
    ``ENTRIES`` rows with the smallest ids (null ids last, of equal ids the smaller vector), of
    all rows if there are fewer. Ties go to the lower index; rows that repeat stay and get the
    same code. Errors beyond 64 bits are given as the largest number. An empty table gives an
    empty result and empty codebooks.
    """
    known = usable(vectors, vec_id, column, label)
    books, size, width = _initial(known)
    if not books.entries[0]:
        empty = known.where(F.lit(False)).select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty, Codebooks([[] for _ in range(PARTS)])
    known = known.where(F.size("v") == size)
    b, b_before, moves, state = FIRST_B, None, None, known
    for _ in range(ROUNDS):
        new = staged(_assign(state, books, moves, b_before, b, width), "codes")
        if b_before is not None:
            discard(state)
        state = new
        books, moves = books.after(_sums(state, b, width))
        b_before, b = b, b if b_before is None else _next_b(state, b)
    done = staged(_assign(state, books, moves, b_before, b, width, last=True), "codes")
    discard(state)
    return done, books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``: the errors summed over equal labels, nulls together; sums beyond 64 bits give the largest number."""
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    totals = coded.groupBy("label").agg(F.least(total, F.lit(_LONGEST).cast("decimal(38,0)")).cast("long").alias("label_error"))
    totals = staged(totals.withColumnRenamed("label", "_label"), "label-errors")
    if totals.count() <= BROADCAST_LABELS:
        return coded.join(F.broadcast(totals), F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
    salted = coded.withColumn("_salt", F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)).cast("int"))
    spread = totals.withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(spread, F.col("label").eqNullSafe(F.col("_label")) & (F.col("_salt") == F.col("_at"))).drop("_label", "_salt", "_at")
