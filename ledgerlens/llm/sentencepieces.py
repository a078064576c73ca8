"""SentencePiece encoding and decoding (operator 1).

Merge-type encoding without a merge queue: at each position the longest piece that an
Aho-Corasick automaton finds is tried, then its shorter prefixes. A piece is accepted
after its left neighbour only if re-merging the text of the two gives these two pieces
back; adjacent compatibility is enough for the whole sequence to be the one that the
merges lead to. A position from which no accepted continuation exists is marked in a
bit field and never tried again.

White space starts pieces and never stands inside one after another character, so a text
is encoded unit by unit, and units that recur are looked up.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Callable
from functools import lru_cache
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import with_arrow_columns

SPACE = "▁"
#: Units that a worker remembers; it starts anew beyond them.
REMEMBERED = 700_000
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"


class PieceModel:
    """The pieces of a merge-type model with an identity normaliser and byte fallback."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        rules, trained = proto.normalizer_spec, proto.trainer_spec
        kinds = {p.type for p in proto.pieces}
        if (
            trained.model_type != 2 or not trained.byte_fallback or rules.precompiled_charsmap
            or rules.remove_extra_whitespaces or not rules.escape_whitespaces
            or trained.treat_whitespace_as_suffix or kinds & {USER_DEFINED, UNUSED}
        ):
            raise ValueError("only merge-type models with byte fallback and an identity normaliser can be used")
        self.dummy_prefix = rules.add_dummy_prefix
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.byte_ids = [i for i, p in enumerate(proto.pieces) if p.type == BYTE]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids):
            raise ValueError("a piece holds white space after another character: texts cannot be split into units")
        #: Punctuation that no piece holds after a letter: a unit can be cut before it.
        loose = [c for c in ".,!?;:)\n" if not any(re.search(f"[{_LETTER}]{re.escape(c)}", p) for p in self.ids)]
        self.cut = re.compile(f"(?<=[{_LETTER}])(?=[{re.escape(''.join(loose))}])") if loose else None
        self.newline_apart = not any("\n" in p for p in self.ids)
        order = sorted(set(self.score.values()), reverse=True)
        place = {s: i for i, s in enumerate(order)}
        self.rank = {p: place[s] for p, s in self.score.items()}
        shared = Counter(self.score.values())
        #: Pieces whose merges are not in order of rank, or tie: their pairs are merged in full.
        self.unordered: set[str] = set()
        self.starts: dict[str, list] = {}
        self.ends: dict[str, list] = {}
        reachable = []
        for p in self.ids:
            steps: list[tuple[str, str]] = []
            if self.merged(p, steps) == [p]:
                reachable.append(p)
                self._edges(p, steps, shared)
        self.automaton = ahocorasick.Automaton()
        for p in reachable:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        known = set(reachable)
        self.shorter = {}
        for p in reachable:
            n = len(p) - 1
            while n and p[:n] not in known:
                n -= 1
            if n:
                self.shorter[p] = p[:n]
            elif len(p) > 1:
                self.shorter[p] = p[0]
        self.fits: dict[tuple[str, str], bool] = {}
        self.units = Units(self)
        # Decoding: the bytes of every id; the library shows other ids like this.
        self.shown = np.empty(len(proto.pieces), dtype=object)
        for i, p in enumerate(proto.pieces):
            self.shown[i] = {
                NORMAL: p.piece.replace(SPACE, " "), UNKNOWN: " ⁇ ", CONTROL: ""
            }.get(p.type, "").encode("utf-8")
        for value, i in enumerate(self.byte_ids):
            self.shown[i] = bytes([value])
        self.is_byte = np.zeros(len(proto.pieces), dtype=bool)
        self.is_byte[self.byte_ids] = True
        self.is_control = np.array([p.type == CONTROL for p in proto.pieces])
        self.is_space = np.array([p.type == NORMAL and p.piece.startswith(SPACE) for p in proto.pieces])

    def _edges(self, piece: str, steps: list[tuple[str, str]], shared: Counter) -> None:
        """The symbols that begin and end the piece while it is merged, each with the rank of the merge that ends it."""
        begin, end = [[piece[0], inf]], [[piece[-1], inf]]
        for left, right in steps:
            whole, rank = left + right, self.rank[left + right]
            if shared[self.score[whole]] > 1 or any(len(x) > 1 and self.rank[x] >= rank for x in (left, right)):
                self.unordered.add(piece)
        at = len(piece)  # walk the merges back from the whole piece to see which of them touch its edges
        for edges, side in ((begin, 0), (end, 1)):
            chain, now = [], piece
            for step in reversed(steps):
                if step[0] + step[1] == now and len(now) <= at:
                    chain.append((step[side], self.rank[now]))
                    now = step[side]
            edges[:] = [[s, r] for s, r in reversed(chain)] + [[piece, inf]]
            if chain and len(chain[-1][0]) > 1:
                self.unordered.add(piece)
        self.starts[piece], self.ends[piece] = begin, end

    def merged(self, text: str, steps: list | None = None) -> list[str]:
        """What the merges make of a short text: the best-scored adjacent pair first, the left one of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            if steps is not None:
                steps.append((parts[at], parts[at + 1]))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fit(self, left: str, right: str) -> bool:
        if len(self.fits) >= REMEMBERED:
            self.fits.clear()
        known = self.fits[left, right] = not left or self._remerge(left, right)
        return known

    def _remerge(self, left: str, right: str) -> bool:
        """Whether merging the text of both leaves the border between them.

        Only the symbols at the border matter. They change at known ranks; the border
        goes if a pair across it has a better rank than the next change. Of equal ranks
        the left merge comes first.
        """
        if left not in self.ends or right not in self.starts or left in self.unordered or right in self.unordered:
            return self.merged(left + right) == [left, right]
        ends, starts, rank, i, j = self.ends[left], self.starts[right], self.rank, 0, 0
        while True:
            (x, x_until), (y, y_until) = ends[i], starts[j]
            across = rank.get(x + y)
            if x_until <= y_until:
                if across is not None and across < x_until:
                    return False
                if x_until == inf:
                    return True
                i += 1
            else:
                if across is not None and across <= y_until:
                    return False
                j += 1

    def pieces(self, unit: str) -> list[str]:
        """The pieces of a unit; a character that is no piece stands for itself."""
        n = len(unit)
        longest = list(unit)
        for end, piece in self.automaton.iter(unit):
            longest[end + 1 - len(piece)] = piece  # ends rise: the last one is the longest
        failed, dead_ends = bytearray((n >> 3) + 1), False
        fits, shorter = self.fits, self.shorter
        taken: list[str] = []
        at, last, piece = 0, "", longest[0]
        while True:
            end = at + len(piece)
            if not (dead_ends and failed[end >> 3] >> (end & 7) & 1):
                good = fits.get((last, piece))
                if good is None:
                    good = self.fit(last, piece)
                if good:
                    taken.append(piece)
                    if end == n:
                        return taken
                    at, last, piece = end, piece, longest[end]
                    continue
            piece = shorter.get(piece)
            while piece is None:
                failed[at >> 3] |= 1 << (at & 7)
                dead_ends = True
                piece = taken.pop()  # some encoding exists, so there is a piece to take back
                at -= len(piece)
                last = taken[-1] if taken else ""
                piece = shorter.get(piece)

    def unit_ids(self, unit: str) -> list[int]:
        out: list[int] = []
        for p in self.pieces(unit) if unit else ():
            i = self.ids.get(p)
            if i is None:
                out.extend(self.byte_ids[b] for b in p.encode("utf-8"))
            else:
                out.append(i)
        return out

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as native 32-bit integers."""
        if not text:
            return b""
        text = text.replace(" ", SPACE)
        if self.dummy_prefix:
            text = SPACE + text
        if SPACE * 2 in text:
            units = re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", text)
        else:
            text = text.replace(SPACE, " " + SPACE)
            if self.newline_apart:
                text = text.replace("\n", " \n ")
            units = text.split(" ")
        return b"".join(map(self.units.__getitem__, units))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; a byte that is no part of a character becomes U+FFFD, as in the library."""
        if not len(ids):
            return ""
        raw = self.shown[ids]
        shown = ids[~self.is_control[ids]]
        strip = self.dummy_prefix and len(shown) and self.is_space[shown[0]]
        try:
            text = "" if self.is_control[ids].any() else b"".join(raw).decode("utf-8")
        except UnicodeDecodeError:
            text = ""
        if not text:  # bytes that form no character, or a control id that ends a run of bytes
            text = self._decode_loosely(ids, raw)
        return text[1:] if strip else text

    def _decode_loosely(self, ids: np.ndarray, raw: np.ndarray) -> str:
        out, run = [], bytearray()
        for i, shown in zip(ids, raw):
            if self.is_byte[i]:
                run += shown
                continue
            out.append(_characters(bytes(run)))
            run.clear()
            out.append(shown.decode("utf-8"))
        out.append(_characters(bytes(run)))
        return "".join(out)


def _characters(run: bytes) -> str:
    out, at = [], 0
    while at < len(run):
        for n in (1, 2, 3, 4):
            try:
                out.append(run[at:at + n].decode("utf-8"))
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


class Units(dict):
    """The ids of units met so far, as bytes; bounded."""

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model = model

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        cut = self.model.cut
        parts = cut.split(unit) if cut and len(unit) < 200 and not unit[1:].isalpha() else [unit]
        if len(parts) > 1:
            ids = b"".join([self[p] for p in parts])
        else:
            ids = array("i", self.model.unit_ids(unit)).tobytes()
        if len(unit) < 200:
            self[unit] = ids
        return ids


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


def _id_lists(encoded: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(encoded) + 1, dtype=np.int32)
    np.cumsum([len(x) // 4 for x in encoded], out=offsets[1:])
    values = pa.array(np.frombuffer(b"".join(encoded), dtype=np.int32))
    return pa.ListArray.from_arrays(pa.array(offsets), values)


IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))
DECODED = T.StructField("decoded", T.StringType())


def encode(docs: DataFrame, path: str, column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``ids``, the piece ids of the whole text. Null and empty texts have no ids."""

    def make() -> Callable:
        m = model(path)
        return lambda texts: [_id_lists([m.encode(t) for t in texts.to_pylist()])]

    return with_arrow_columns(docs, column, T.StructType([IDS]), make, keep)


def decode(df: DataFrame, path: str, column: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``decoded``, the text of its ids; null ids give an empty text."""

    def make() -> Callable:
        m = model(path)

        def run(ids: pa.Array) -> list[pa.Array]:
            return [pa.array([m.decode(np.array(x.as_py() or [], dtype=np.int64)) for x in ids], pa.string())]

        return run

    return with_arrow_columns(df, column, T.StructType([DECODED]), make, keep)


def encode_decode(docs: DataFrame, path: str, column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``ids`` and the text decoded from them, in one pass over the texts."""

    def make() -> Callable:
        m = model(path)

        def run(texts: pa.Array) -> list[pa.Array]:
            encoded = [m.encode(t) for t in texts.to_pylist()]
            decoded = [m.decode(np.frombuffer(x, dtype=np.int32)) for x in encoded]
            return [_id_lists(encoded), pa.array(decoded, pa.string())]

        return run

    return with_arrow_columns(docs, column, T.StructType([IDS, DECODED]), make, keep)


def ids_digest(ids: Column) -> Column:
    """Lowercase hex of the sha256 of the decimal ids joined by commas."""
    return F.sha2(F.concat_ws(",", ids.cast("array<string>")), 256)


def digests(coded: DataFrame, key: str = "doc_id") -> DataFrame:
    return coded.select(
        key, F.size("ids").cast("long").alias("n_tokens"), ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
