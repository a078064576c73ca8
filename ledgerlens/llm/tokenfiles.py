"""Token-ID output in directly addressable codes (operator 10).

A sequence of ids is split into levels of ``CHUNK_BITS`` bits. Level 0 has the low chunk
of every id; a bitmap says which ids go on, and the next level holds a chunk of those
alone. A rank directory over each bitmap (ones before every block of ``BLOCK`` bits) turns
the place of an id in one level into its place in the next, so any id can be read by
itself, without decoding its neighbours.

A file set is a Parquet folder. Each row is a segment: whole documents in ascending
``doc_id`` order, their lengths, and the coded ids as one binary value. Spark's writer
commits the files, so a lost task leaves nothing behind.
"""

from __future__ import annotations

import os
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import SLICE_ROWS, new_path

#: Letters whose lower case is one letter, wherever they stand and however they are composed.
_EARLY = re.compile("[\x00-\u012f\u0131-\u024f]*")
#: A stop or comma beside another sign: the tokenizer takes signs that touch as one word.
_IN_RUN = re.compile(r"[.,](?:(?=[^\w\s]|[_\x1c-\x1f])|(?<=[^\w\s][.,])|(?<=[_\x1c-\x1f][.,]))")
MAGIC = b"DAC1"
CHUNK_BITS = 8
BLOCK = 512
#: Ids in a segment after which the next document starts another one.
SEGMENT_IDS = 1 << 17
#: Words that a worker remembers at most: as many as half of it since it last sorted out, and those remembered then.
REMEMBERED = 900_000


def pack(ids: np.ndarray) -> bytes:
    """Ids (below 2^32) as levels of chunks, continuation bitmaps and rank directories."""
    rest, levels = np.asarray(ids, dtype=np.uint32), []
    while len(rest) or not levels:
        goes_on = rest >= (1 << CHUNK_BITS)
        bits = np.packbits(goes_on, bitorder="little")
        per_block = np.add.reduceat(goes_on, np.arange(0, len(rest), BLOCK), dtype=np.uint32) if len(rest) else np.zeros(0, np.uint32)
        ranks = np.concatenate(([0], np.cumsum(per_block)[:-1])).astype("<u4") if len(rest) else np.zeros(0, "<u4")
        levels.append((len(rest), (rest & 0xFF).astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes()))
        rest = rest[goes_on] >> CHUNK_BITS
    head = MAGIC + struct.pack("<I", len(levels)) + b"".join(struct.pack("<Q", n) for n, *_ in levels)
    return head + b"".join(ranks + bits + chunks for _, chunks, bits, ranks in levels)


class Packed:
    """A view of packed ids; nothing is decoded until it is asked for."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a sequence of directly addressable codes")
        count, = struct.unpack_from("<I", data, 4)
        sizes = struct.unpack_from(f"<{count}Q", data, 8)
        at, self.levels = 8 + 8 * count, []
        for n in sizes:
            blocks, width = -(-n // BLOCK), -(-n // 8)
            ranks = np.frombuffer(data, "<u4", blocks, at)
            bits = np.frombuffer(data, np.uint8, width, at + 4 * blocks)
            chunks = np.frombuffer(data, np.uint8, n, at + 4 * blocks + width)
            self.levels.append((chunks, bits, ranks))
            at += 4 * blocks + width + n

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        """One id, read through the rank directories."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = 0
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (CHUNK_BITS * level)
            if not bits[i >> 3] >> (i & 7) & 1:
                return value
            block = i // BLOCK
            within = np.unpackbits(bits[block * BLOCK // 8:(i >> 3) + 1], bitorder="little")[: i - block * BLOCK]
            i = int(ranks[block]) + int(within.sum())
        return value

    def all(self) -> np.ndarray:
        """Every id, as unsigned 32-bit integers."""
        above = np.zeros(0, np.uint32)
        for chunks, bits, _ in reversed(self.levels):
            ids = chunks.astype(np.uint32)
            goes_on = np.unpackbits(bits, count=len(chunks), bitorder="little").view(bool)
            ids[goes_on] |= above << CHUNK_BITS
            above = ids
        return above


class Words(dict):
    """The ids of the words met so far; spaces and line feeds part words for this tokenizer. Bounded."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.before: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        # the library takes the strings of special tokens out of a text before anything else
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.special]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)", re.IGNORECASE)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for piece, i in vocabulary.items() if suffix and piece.endswith(suffix)]] = True
        normalizer = str(self.tokenizer.normalizer)
        self.apart = "Lowercase" in normalizer and "NFC" in normalizer and "Replace" in normalizer

    def learn(self, words: list[str]) -> None:
        plain = [w for w in words if w.isalpha() and _EARLY.fullmatch(w)]
        for at in range(0, len(plain), 2000):
            some = plain[at:at + 2000]  # coded as one text; each word ends with a piece marked so
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype=np.uint32)
            ends = (np.flatnonzero(self.ends_word[ids]) + 1) * 4
            if len(ends) == len(some):
                raw, start = ids.tobytes(), 0
                for word, end in zip(some, ends.tolist()):
                    self[word], start = raw[start:end], end
        others = [w for w in words if w not in self]
        for at in range(0, len(others), 4096):
            some = others[at:at + 4096]
            for word, coded in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                self[word] = array("I", coded.ids).tobytes()

    @staticmethod
    def _words(text: str) -> list[str]:
        """Words whose ids can be put side by side: parted at spaces and line feeds, and at stops and commas that stand alone."""
        if _EARLY.fullmatch(text) and not _IN_RUN.search(text):
            text = text.lower().replace(".", " . ").replace(",", " , ")
        return text.replace("\n", " ").split(" ")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts, as the library gives them, as unsigned 32-bit integers."""
        if not self.apart:
            return [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        whole = {i for i, t in enumerate(texts) if t and "<|" in t and self.special.search(t)}  # coded in one piece
        split = [[] if i in whole else self._words(t or "") for i, t in enumerate(texts)]
        if len(self) >= REMEMBERED // 2:  # words that do not recur while as many others come are forgotten
            self.before = dict(self)
            self.clear()
        new = [w for w in set().union(*split) if w not in self]
        self.update((w, self.before[w]) for w in new if w in self.before)
        new = [w for w in new if w not in self]
        if new:
            self.learn(new)
        out = [b"".join(map(self.__getitem__, words)) for words in split]
        for i in whole:
            out[i] = array("I", self.tokenizer.encode(texts[i], add_special_tokens=False).ids).tobytes()
        return out


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    return Words(path)


FILE_SCHEMA = T.StructType([
    T.StructField("part", T.IntegerType()),
    T.StructField("segment", T.IntegerType()),
    T.StructField("part_start", T.LongType()),
    T.StructField("n_ids", T.LongType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("lengths", T.ArrayType(T.LongType())),
    T.StructField("codes", T.BinaryType()),
])


def write(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 1) -> None:
    """Tokenizes ``doc_id, text`` and writes the segments.

    Null and empty texts are documents of the end id alone. Rows that share a ``doc_id``
    are separate documents, ordered by their text. Null ids come first. Extra columns are
    not stored. An empty table gives an empty file set.
    """
    ordered = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = words(tokenizer_path), TaskContext.get().partitionId()
        end = np.array([end_id], dtype=np.uint32).tobytes()
        ids: list[bytes] = []
        docs_in: list = []
        held = start = segment = 0

        def close() -> pa.RecordBatch:
            lengths = [len(x) // 4 for x in ids]
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([start], pa.int64()), pa.array([held], pa.int64()),
                pa.array([docs_in], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
                pa.array([pack(np.frombuffer(b"".join(ids), dtype=np.uint32))], pa.binary()),
            ], names=FILE_SCHEMA.names)

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                piece = batch.slice(at, SLICE_ROWS)
                for doc_id, coded in zip(piece.column(0).to_pylist(), coder.encode(piece.column(1).to_pylist())):
                    docs_in.append(doc_id)
                    ids.append(coded + end)
                    held += len(ids[-1]) // 4
                    if held >= SEGMENT_IDS:
                        yield close()
                        start, segment, held, ids, docs_in = start + held, segment + 1, 0, [], []
        if ids:
            yield close()

    ordered.mapInArrow(run, FILE_SCHEMA).write.parquet(folder)


def _part_starts(files: DataFrame) -> DataFrame:
    """Ids before each part: one row per partition of the write."""
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    return totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Documents read back: ``doc_id``, ``start`` (ids of all documents before it), ``ids`` (binary, uint32)."""
    files = spark.read.schema(FILE_SCHEMA).parquet(folder)
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("at", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, start, doc_ids, lengths = (batch.column(i)[row].as_py() for i in range(4))
                ids = Packed(batch.column(4)[row].as_py()).all().astype("<u4")
                ends = np.cumsum(lengths)
                texts = [ids[e - n:e].tobytes() for e, n in zip(ends, lengths)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * len(texts), pa.int32()), pa.array(doc_ids, pa.int64()),
                    pa.array([start + int(e) - n for e, n in zip(ends, lengths)], pa.int64()), pa.array(texts, pa.binary()),
                ], names=schema.names)

    rows = files.select("part", "part_start", "doc_ids", "lengths", "codes").mapInArrow(run, schema)
    starts = F.broadcast(_part_starts(files))  # a row per partition of the write
    return rows.join(starts, "part").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "ids")


def ids_at(spark: SparkSession, folder: str, positions: DataFrame) -> DataFrame:
    """``position, id`` for each row of ``positions`` (a ``position`` in the whole sequence): random access.

    Positions outside the sequence, and null ones, give a null id. Positions meet
    segments by cells of equal width; those of one segment come to it together, and it is opened once.
    No other id is decoded.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(folder)
    index = files.select("part", "segment", "part_start", "n_ids").join(F.broadcast(_part_starts(files)), "part").select(
        "part", "segment", (F.col("before") + F.col("part_start")).alias("first"), "n_ids")
    wanted = positions.select(F.col("position").cast("long").alias("position")).where(F.col("position") >= 0).distinct()
    # cells as wide as the longest segment: a segment lies in two cells at most, and a cell is an equality
    stride = index.agg(F.coalesce(F.max("n_ids"), F.lit(1))).first()[0] or 1
    cell = F.floor(F.col("position") / F.lit(stride))
    spans = index.withColumn("cell", F.explode(F.sequence(F.floor(F.col("first") / F.lit(stride)), F.floor((F.col("first") + F.greatest("n_ids", F.lit(1)) - 1) / F.lit(stride)))))
    met = wanted.withColumn("cell", cell).join(spans.select("cell", "part", "segment", "first", "n_ids"), "cell").where(
        (F.col("position") >= F.col("first")) & (F.col("position") < F.col("first") + F.col("n_ids")))
    asked = met.groupBy("part", "segment", "first").agg(F.collect_list("position").alias("positions"))  # as many as a segment has ids
    rows = asked.join(files.select("part", "segment", "codes"), ["part", "segment"]).select("first", "positions", "codes")
    schema = T.StructType([T.StructField("position", T.LongType()), T.StructField("id", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, places, codes in zip(*(c.to_pylist() for c in batch.columns)):
                packed = Packed(codes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(places, pa.int64()), pa.array([packed[p - first] for p in places], pa.int64())], names=schema.names)

    found = rows.mapInArrow(run, schema)
    return positions.select("position").join(found, "position", "left")


def digests(read_back: DataFrame) -> DataFrame:
    """Per document its start, number of ids and their crc32."""
    return read_back.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """Writes the files to the shared folder and reads them back."""
    spark = docs.sparkSession
    folder = new_path(spark, "tokens")
    write(docs, tokenizer_path, folder, end_id)
    return read(spark, folder)
