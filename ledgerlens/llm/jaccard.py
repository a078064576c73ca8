"""Jaccard join of shingle sets with a count-vector R-tree (operator 6).

Texts with one set are one class, named by a hash of the set. Two sets that link differ in
few shingles, so when shingles are hashed into more groups than may differ, some group is
the same in both: classes meet in buckets, one per group content. Inside a bucket the
numbers of shingles in ``DIMS`` other groups are points of an R-tree. The sum of the
coordinate minima of two points bounds the overlap of the sets, and that of a point and the
upper corner of a node bounds it for the whole node. What passes is verified on the sets.

Not all links of a large group are listed: a class proposes its best neighbour in another
component, proposals are verified, components grow, and only in the last round everything
that still lies in different components and passes the bound is verified. No link between
components can be missing then.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import discard, staged, with_arrow_columns
from ledgerlens.llm.components import connected
from ledgerlens.llm.hashing import mix, shingle_set

#: Coordinates of a point; points of a leaf; members of a bucket that one task compares with as many others.
DIMS, LEAF, BLOCK = 128, 32, 4096
#: Rounds in which classes propose one neighbour each before all that is left is verified.
ROUNDS = 2
_U = np.uint64


class Sizes:
    """Classes of set sizes: sets that can link lie in one class or in neighbouring ones."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.upper = [0]

    def of(self, n: int) -> int:
        while self.upper[-1] < n:
            low = self.upper[-1] + 1
            self.upper.append(max(low, low * self.den // self.num))
        return int(np.searchsorted(self.upper, n))

    def groups(self, size_class: int) -> tuple[int, int]:
        """Groups for pairs whose larger set is in the class, and how many may be empty.

        ``differ`` bounds the symmetric difference, so ``empty + 1`` groups at least are
        alike. A set with no more than ``empty`` empty groups need not offer those: one of
        the groups alike is not empty. Sets with more offer their empty groups too.
        """
        while len(self.upper) <= size_class:
            self.of(self.upper[-1] + 1)
        differ = 2 * self.upper[size_class] * (self.den - self.num) // (self.den + self.num)
        if differ == 0:
            return 0, 0
        empty = 2 + differ // 16
        return differ + 1 + empty, empty


def set_key(hashes: np.ndarray) -> int | None:
    """The class of a set: one number, the same for equal sets; None for the empty set."""
    if not len(hashes):
        return None
    total = np.add.reduce(mix(hashes), keepdims=True) + np.array([len(hashes)], dtype=_U)
    folded = np.bitwise_xor.reduce(mix(hashes + _U(7)), keepdims=True)
    return int(mix(total + mix(folded)).view(np.int64)[0])


def group_signatures(hashes: np.ndarray, sizes: Sizes) -> np.ndarray:
    """The contents of the groups of a set, for its own size class and the next one."""
    own, out = sizes.of(len(hashes)), []
    mixed = mix(hashes ^ _U(0x5851F42D4C957F2D))
    low, high = (mixed & _U(0xFFFFFFFF)).astype(np.float64), (mixed >> _U(32)).astype(np.float64)
    for size_class in (own, own + 1):
        groups, may_be_empty = sizes.groups(size_class)
        if not groups:
            continue
        at = (hashes % _U(groups)).astype(np.int64)
        count = np.bincount(at, minlength=groups)
        sums = [np.bincount(at, weights=x, minlength=groups).astype(_U) for x in (low, high)]
        where = mix(np.arange(groups, dtype=_U) + _U(size_class << 32))
        content = mix(mix(sums[0] + where) + sums[1] * _U(0x2545F4914F6CDD1D) + count.astype(_U))
        out.append(content if (count == 0).sum() > may_be_empty else content[count > 0])
    return np.concatenate(out) if out else np.zeros(0, dtype=_U)


def point(hashes: np.ndarray) -> bytes:
    return np.bincount(((hashes >> _U(20)) % _U(DIMS)).astype(np.int64), minlength=DIMS).astype("<u4").tobytes()


class CountTree:
    """An R-tree over count vectors: leaves of near points in order of size, then two levels of upper corners."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, num: int, den: int):
        self.num, self.den = num, den
        lead = np.argsort(-points.sum(axis=0))[:2] if len(points) else [0, 0]
        self.order = np.lexsort((points[:, lead[1]], points[:, lead[0]] // 4, sizes))
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels = []
        corners, least = self.points, self.sizes
        for _ in range(2):
            cuts = np.arange(0, len(corners), LEAF)
            corners, least = np.maximum.reduceat(corners, cuts, axis=0), np.minimum.reduceat(least, cuts)
            self.levels.append((corners, least))

    def _possible(self, p: np.ndarray, n: int, corners: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bound = np.minimum(corners, p).sum(axis=1)
        return bound * (self.num + self.den) >= self.num * (n + least), bound

    def near(self, p: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the points that may link with a point, and the bounds of their overlaps."""
        nodes = np.flatnonzero(self._possible(p, n, *self.levels[1])[0])
        for level in (self.levels[0], (self.points, self.sizes)):
            below = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
            below = below[below < len(level[0])]
            if not len(below):
                return below, below
            passed, bound = self._possible(p, n, level[0][below], level[1][below])
            nodes, bounds = below[passed], bound[passed]
        return self.order[nodes], bounds


def bucket_pairs(keys, components, sizes, points, sides, num: int, den: int, best_only: bool) -> set[tuple[int, int]]:
    """Pairs of a bucket in different components that pass the bound; with ``best_only`` one for each member."""
    tree, out = CountTree(points, sizes, num, den), set()
    for i in range(len(keys)):
        near, bounds = tree.near(points[i], int(sizes[i]))
        apart = components[near] != components[i]
        if sides[i] >= 0:
            apart &= sides[near] != sides[i]  # pairs of one side belong to another task
        near, bounds = near[apart], bounds[apart]
        if not len(near):
            continue
        if best_only:
            # the most alike by bound over size; of equals the smallest key
            rank = np.lexsort((keys[near], -bounds * 2.0 / (sizes[near] + sizes[i])))
            near = near[rank[:1]]
        for j in near:
            a, b = int(keys[i]), int(keys[j])
            out.add((a, b) if a < b else (b, a))
    return out


PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _propose(members: DataFrame, points: DataFrame, components: DataFrame | None, num: int, den: int, best_only: bool) -> DataFrame:
    """Pairs that the trees of all buckets propose. A bucket of more than ``BLOCK`` members is compared block by block."""
    if components is None:
        members = members.withColumn("component", F.col("key"))
    else:
        members = members.join(components.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    sizes = members.groupBy("sig").agg(F.count(F.lit(1)).alias("n_members"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    open_ = members.join(sizes.where(F.col("lo") != F.col("hi")).select("sig", "n_members"), "sig").join(points, "key")
    blocks = F.ceil(F.col("n_members") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    cut = open_.withColumn("blocks", blocks).withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = cut.select(
        "sig", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"),
        F.when(F.col("mine") == F.col("other"), F.lit(-1)).otherwise(F.col("mine")).alias("side"), "key", "component", "n", "point",
    ).repartition("sig", "x", "y").sortWithinPartitions("sig", "x", "y", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now = None

        def close() -> pa.RecordBatch:
            _, _, _, side, keys, comps, n, p = zip(*held)
            found = sorted(bucket_pairs(
                np.array(keys), np.array(comps), np.array(n), np.frombuffer(b"".join(p), "<u4").reshape(-1, DIMS).astype(np.int64),
                np.array(side), num, den, best_only))
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=PAIR.names)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != now:
                    if held:
                        yield close()
                    held, now = [], row[:3]
                held.append(row)
        if held:
            yield close()

    return dealt.mapInArrow(run, PAIR).distinct()


def low_part(hashes: np.ndarray, num: int, den: int) -> np.ndarray:
    """The lowest hashes of a set: of one half more of all than sets that link can lack, so that sets with nothing in common are told by them."""
    share = min(1.0, 1.5 * (den - num) / (den + num))
    return hashes[:np.searchsorted(hashes, _U(min(int(share * 2.0 ** 64), 2 ** 64 - 1)))]


def _compared(pairs: DataFrame, sets: DataFrame, column: str, num: int, den: int) -> DataFrame:
    """The pairs whose sets may link, as all or the lowest of their hashes say: what is not compared counts as common as far as sizes allow."""
    left = sets.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col(column).alias("ha"))
    right = sets.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col(column).alias("hb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb, ha, hb = batch.columns
            keep = []
            for i, (n, m) in enumerate(zip(na.to_pylist(), nb.to_pylist())):
                x, y = (np.frombuffer(h[i].as_buffer(), dtype=_U) for h in (ha, hb))
                common = len(np.intersect1d(x, y, assume_unique=True)) + min(n - len(x), m - len(y))
                keep.append(den * common >= num * (n + m - common))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], names=PAIR.names)

    return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "ha", "hb").mapInArrow(run, PAIR)


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose sets link, staged. Large sets that met by chance part on their lowest hashes: their whole sets are not moved."""
    possible = staged(_compared(pairs, sets, "low", num, den), "possible")
    found = staged(_compared(possible, sets, "hashes", num, den), "verified")
    discard(possible)
    return found


def classes(docs: DataFrame, words: int = 3, num: int = 90, den: int = 100, carry: list[str] | None = None) -> DataFrame:
    """``doc_id, n_shingles, key, component, component_id`` for each row of ``docs`` (``doc_id, text``), and the columns to ``carry``.

    Two documents link when ``den * |intersection| >= num * |union|`` of their sets of
    ``words``-word shingles (A-Z in lower case); a text with fewer words has its whole
    sequence as one shingle. ``component_id`` is the smallest ``doc_id`` reachable by links.
    Null and empty texts, and texts of white space, have the empty set and link with nothing;
    their component is their own id. Repeated rows stay, each with the component of its text;
    null ids take part and never name a component unless all ids of it are null. ``key`` names
    the class of equal sets, ``component`` the group by its smallest key. An empty table gives an empty result.
    """
    def sketch():
        sizes, seen = Sizes(num, den), set()

        def run(texts: pa.Array) -> list[pa.Array]:
            n, keys, sigs = [], [], []
            for text in texts.to_pylist():
                hashes = shingle_set(text, words)
                key = set_key(hashes)
                n.append(len(hashes))
                keys.append(key)
                if key is None or key in seen:  # a copy in the same task need not offer its groups again
                    sigs.append(np.zeros(0, dtype=np.int64))
                    continue
                if len(seen) < 1_000_000:
                    seen.add(key)
                sigs.append(group_signatures(hashes, sizes).view(np.int64))
            ends = np.cumsum([0] + [len(s) for s in sigs]).astype(np.int32)
            return [pa.array(n, pa.int64()), pa.array(keys, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sigs) if sigs else np.zeros(0, np.int64)))]

        return run

    made = T.StructType([T.StructField("n_shingles", T.LongType()), T.StructField("key", T.LongType()), T.StructField("sigs", T.ArrayType(T.LongType()))])
    carry = carry or []
    sketched = staged(with_arrow_columns(docs.select("doc_id", "text", *carry), "text", made, sketch, keep=["doc_id", *carry]), "sketched")
    by_sig = Window.partitionBy("sig")
    offered = sketched.select("key", F.explode("sigs").alias("sig"))
    shared = offered.withColumns({"lo": F.min("key").over(by_sig), "hi": F.max("key").over(by_sig)}).where(F.col("lo") != F.col("hi"))
    shared = staged(shared.select("sig", "key").distinct(), "shared")
    wide, sketched = sketched, staged(sketched.drop("sigs"), "keys")
    discard(wide)
    # buckets with the same members say the same: one of them is kept
    same = shared.groupBy("sig").agg(F.bit_xor(F.xxhash64("key")).alias("x"), F.count(F.lit(1)).alias("n")).groupBy("x", "n").agg(F.min("sig").alias("sig"))
    members = staged(shared.join(same.select("sig"), "sig"), "members")
    discard(shared)

    named = sketched.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    wanted = named.join(members.select("key").distinct(), "key").withColumnRenamed("doc_id", "of")

    def rebuild():
        def run(texts: pa.Array) -> list[pa.Array]:
            sets = [shingle_set(t, words) for t in texts.to_pylist()]
            return [pa.array([set_key(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([point(s) for s in sets], pa.binary()), pa.array([low_part(s, num, den).tobytes() for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary())]

        return run

    rebuilt = T.StructType([
        T.StructField("got", T.LongType()), T.StructField("n", T.LongType()), T.StructField("point", T.BinaryType()),
        T.StructField("low", T.BinaryType()), T.StructField("hashes", T.BinaryType())])
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("of"))).select("key", "text")
    sets = with_arrow_columns(texts, "text", rebuilt, rebuild, keep=["key"]).where(F.col("got") == F.col("key"))
    sets = staged(sets.drop("got").dropDuplicates(["key"]), "sets")
    points = sets.select("key", "n", "point")

    links, components = None, None
    for best_only in [True] * ROUNDS + [False]:
        # the shuffles of members and points can go before the sets are shuffled
        proposed = staged(_propose(members, points, components, num, den, best_only), "proposed")
        found = _verified(proposed, sets, num, den)
        discard(proposed)
        if found.isEmpty():
            if best_only:
                continue
            break
        links = found if links is None else links.unionByName(found)
        components = connected(links)
    discard(members, sets)
    linked = named.withColumn("component", F.col("key"))
    if components is not None:
        linked = named.join(components.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    least = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = linked.join(least, "component").select("key", "component", "component_id")
    return sketched.select("doc_id", "n_shingles", "key", *carry).join(linked, "key", "left").select(
        "doc_id", "n_shingles", "key", "component",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), *carry)
