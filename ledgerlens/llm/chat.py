"""Chat formatting by incremental black-box rendering (operator 9).

A template is only called: it turns a list of (role, text) into one text. Rendering
successive prefixes of a conversation and comparing consecutive outputs shows what each
turn added. If an output does not continue the one before, the template rewrites history;
the turn is reported and what it rewrote carries no loss. Where the text lies inside an
added stretch is found by rendering the turn with two probe texts: what both outputs
begin and end with are the marks of the template.

A template may depend on any turn before, so a conversation is rendered whole, by one task.
Only for a template that names the turns it looks back (``context_turns``) are rows
range-partitioned by conversation and turn: a conversation of any length is then spread over
tasks, and each task also gets the last turns before its first row as context. Conversations come out in pieces of at most ``PIECE_TURNS`` turns; nearly all have one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import staged

#: Turns of a piece, and turns before a piece that a template is shown with it if it says it looks back no further.
PIECE_TURNS, CONTEXT_TURNS = 64, 8
Turn = tuple[str, str]


class InstTemplate:
    """Marks for user, assistant and any other role; control strings inside texts are escaped reversibly.

    ``[`` or ``<`` that begins a control string, with any backslashes after it, gets one more
    backslash; taking one away restores the text. Other characters stay as they are.
    """

    #: What a turn adds depends on that turn alone, so this context is enough.
    context_turns = CONTEXT_TURNS
    _CONTROL = r"(?=/?INST\]|/?s>|/?ROLE\]|SAYS\])"
    _PLAIN, _ESCAPED = re.compile(r"([\[<])(\\*)" + _CONTROL), re.compile(r"([\[<])\\(\\*)" + _CONTROL)

    def escape(self, text: str) -> str:
        return self._PLAIN.sub(r"\1\\\2", text)

    def unescape(self, text: str) -> str:
        return self._ESCAPED.sub(r"\1\2", text)

    def __call__(self, turns: list[Turn]) -> str:
        out = []
        for role, text in turns:
            if role == "user":
                out.append(f"[INST] {self.escape(text)} [/INST]")
            elif role == "assistant":
                out.append(f" {self.escape(text)}</s>")
            else:
                out.append(f"[ROLE] {self.escape(role)} [SAYS] {self.escape(text)} [/ROLE]")
        return "".join(out)

    def parse(self, formatted: str) -> list[Turn]:
        """The turns that a formatted text (or a piece of one) holds."""
        turns, at = [], 0

        def until(mark: str) -> str:
            nonlocal at
            end = formatted.index(mark, at)
            part, at = formatted[at:end], end + len(mark)
            return self.unescape(part)

        while at < len(formatted):
            if formatted.startswith("[INST] ", at):
                at += len("[INST] ")
                turns.append(("user", until(" [/INST]")))
            elif formatted.startswith("[ROLE] ", at):
                at += len("[ROLE] ")
                role = until(" [SAYS] ")
                turns.append((role, until(" [/ROLE]")))
            elif formatted.startswith(" ", at):
                at += 1
                turns.append(("assistant", until("</s>")))
            else:
                raise ValueError(f"no turn begins at {at}")
        return turns


Span = dict[str, object]


def _content(render: Callable[[list[Turn]], str], before: list[Turn], role: str, added: str, known: dict) -> tuple[int, int] | None:
    """Where the text of a turn lies in what the turn added; None if the marks cannot be told."""
    key = (role, before[-1][0] if before else None)
    for fresh in (False, True):
        if fresh or key not in known:
            base = render(before) if before else ""
            probes = [render(before + [(role, p)]) for p in ("x0x", "y1y")]
            if not all(p.startswith(base) for p in probes):
                return None
            a, b = (p[len(base):] for p in probes)
            known[key] = (commonprefix([a, b]), commonprefix([a[::-1], b[::-1]])[::-1])
        head, tail = known[key]
        if added.startswith(head) and added.endswith(tail) and len(added) >= len(head) + len(tail):
            return len(head), len(added) - len(tail)
    return None


def render_piece(render: Callable[[list[Turn]], str], context: list[Turn], turns: list[Turn], loss_role: str, known: dict) -> tuple[str, list[Span], list[int]]:
    """The formatted text of a piece, a span for each turn, and the turns at which history was rewritten.

    Offsets count code points from the start of the piece. ``loss_start`` and ``loss_end``
    are -1 where a turn has no loss. A piece that rewrites its context begins where the two part.
    """
    base = render(context) if context else ""
    outputs, spans, rewritten, cut = base, [], [], len(base)
    for i, (role, _) in enumerate(turns):
        now = render(context + turns[:i + 1])
        start = len(outputs)
        if not now.startswith(outputs):
            start = len(commonprefix([outputs, now]))
            rewritten.append(i)
            cut = min(cut, start)
            for s in spans:
                s["start"], s["end"] = min(s["start"], start), min(s["end"], start)
                if s["loss_end"] > s["end"]:
                    s["loss_start"] = s["loss_end"] = -1
        inside = None
        if role == loss_role and (not rewritten or rewritten[-1] != i):
            inside = _content(render, context + turns[:i], role, now[start:], known)
        spans.append({
            "role": role, "start": start, "end": len(now),
            "loss_start": start + inside[0] if inside else -1, "loss_end": start + inside[1] if inside else -1,
        })
        outputs = now
    return outputs[cut:], [_moved(s, cut) for s in spans], rewritten


def _moved(span: Span, by: int) -> Span:
    """The span with its offsets counted from ``by``."""
    return {k: v - by if k != "role" and not (k.startswith("loss") and v < 0) else v for k, v in span.items()}


def cut_pieces(formatted: str, spans: list[Span], rewritten: list[int]) -> Iterator[tuple[int, str, list[Span], list[int]]]:
    """A whole conversation as pieces: the first turn of each, its text, spans and rewriting turns, counted from its start."""
    for at in range(0, len(spans), PIECE_TURNS):
        begin = spans[at]["start"] if at else 0
        end = spans[at + PIECE_TURNS]["start"] if at + PIECE_TURNS < len(spans) else len(formatted)
        yield (at, formatted[begin:end], [_moved(s, begin) for s in spans[at:at + PIECE_TURNS]],
               [i - at for i in rewritten if at <= i < at + PIECE_TURNS])


_SPAN = T.StructType([
    T.StructField("role", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("loss_start", T.IntegerType()), T.StructField("loss_end", T.IntegerType()),
])
PIECE = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("piece", T.LongType()), T.StructField("formatted", T.StringType()),
    T.StructField("spans", T.ArrayType(_SPAN)), T.StructField("rewritten", T.ArrayType(T.IntegerType())),
])


def _arrow() -> pa.Schema:
    fields = [("role", pa.string()), *((n, pa.int32()) for n in ("start", "end", "loss_start", "loss_end"))]
    return pa.schema([
        ("conv_id", pa.int64()), ("piece", pa.int64()), ("formatted", pa.string()),
        ("spans", pa.list_(pa.struct(fields))), ("rewritten", pa.list_(pa.int32()))])


def _whole(render: Callable[[list[Turn]], str], loss_role: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Renders conversations that lie whole and in order in a task, one at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(b.column(n).to_pylist() for n in ("conv_id", "place", "role", "text"))))
        for conv, of_conv in groupby(rows, key=lambda row: row[0]):
            places, turns = [], []
            for _, place, role, text in of_conv:
                places.append(place)
                turns.append((role, text))
            for at, formatted, spans, rewritten in cut_pieces(*render_piece(render, [], turns, loss_role, {})):
                yield pa.RecordBatch.from_pylist([{
                    "conv_id": conv, "piece": places[at], "formatted": formatted, "spans": spans, "rewritten": rewritten}], schema=_arrow())

    return run


def format_conversations(rows: DataFrame, render: Callable[[list[Turn]], str], loss_role: str = "assistant") -> DataFrame:
    """Pieces of formatted conversations, ordered by ``piece`` within ``conv_id``.

    Turns are ordered by ``turn`` (nulls first), then role and text, so equal turns have a
    fixed order and repeated rows stay. Null roles and texts are empty; rows without
    ``conv_id`` form one conversation. Other columns are not carried. An empty table gives
    no pieces. Templates may depend on all turns before: one task holds one conversation and
    renders it from its first turn. A template with an attribute ``context_turns`` promises
    that a turn adds the same text whatever came before so many turns (``CONTEXT_TURNS`` at
    most); its long conversations are spread over tasks.
    """
    whole = not 0 <= getattr(render, "context_turns", -1) <= CONTEXT_TURNS
    clean = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    ordered = staged(clean.repartitionByRange(*order).sortWithinPartitions(*order).select(
        F.monotonically_increasing_id().alias("place"), "conv_id", "role", "text"), "turns")
    if whole:
        return ordered.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_whole(render, loss_role), PIECE)
    ordered = ordered.withColumn("part", F.shiftright("place", 33).cast("int"))
    last = ordered.groupBy("part").agg(F.max("place").alias("last"))
    parts = (last.agg(F.max("part")).first()[0] or 0) + 2
    # the last turns of a part are context of the next one; `last` has a row per partition
    context = ordered.join(F.broadcast(last), "part").where(F.col("place") > F.col("last") - CONTEXT_TURNS).select(
        "place", "conv_id", "role", "text", (F.col("part") + 1).alias("part"), F.lit(True).alias("context"))
    dealt = ordered.withColumn("context", F.lit(False)).unionByName(context).repartitionById(parts, F.col("part")).sortWithinPartitions("part", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        before: list[Turn] = []
        turns: list[Turn] = []
        now = first = None

        def close() -> pa.RecordBatch:
            formatted, spans, rewritten = render_piece(render, before, turns, loss_role, known)
            return pa.RecordBatch.from_pylist([{
                "conv_id": now, "piece": first, "formatted": formatted, "spans": spans, "rewritten": rewritten}], schema=_arrow())

        begun = False
        for batch in batches:
            for place, conv, role, text, _, is_context in zip(*(batch.column(n).to_pylist() for n in ("place", "conv_id", "role", "text", "part", "context"))):
                if not begun or conv != now:
                    if turns:
                        yield close()
                    before, turns, now, begun = [], [], conv, True
                if is_context:
                    before = (before + [(role, text)])[-CONTEXT_TURNS:]
                    continue
                if len(turns) == PIECE_TURNS:
                    yield close()
                    before, turns = (before + turns)[-CONTEXT_TURNS:], []
                if not turns:
                    first = place
                turns.append((role, text))
        if turns:
            yield close()

    return dealt.mapInArrow(run, PIECE)


DIGEST = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
    T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()),
])


def read_back(pieces: DataFrame, template: InstTemplate) -> DataFrame:
    """Per conversation, from the formatted text and its loss mask: turns, digests and sizes.

    Pieces are parsed where they lie; a digest over a whole conversation is sequential, so
    the parsed pieces of one conversation stream through one task, which holds one at a time.
    """
    shape = T.StructType([
        T.StructField("conv_id", T.LongType()), T.StructField("piece", T.LongType()), T.StructField("n_turns", T.LongType()),
        T.StructField("turns", T.BinaryType()), T.StructField("loss", T.StringType()), T.StructField("chars", T.LongType())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            formatted = batch.column(2).to_pylist()
            turns = [template.parse(x) for x in formatted]
            loss = ["".join(template.unescape(x[s["loss_start"]:s["loss_end"]]) for s in spans if s["loss_start"] >= 0)
                    for x, spans in zip(formatted, batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(x) for x in turns], pa.int64()),
                pa.array(["".join(f"{r}\n{t}\n" for r, t in x).encode("utf-8") for x in turns], pa.binary()),
                pa.array(loss, pa.string()), pa.array([len(x) for x in formatted], pa.int64()),
            ], names=shape.names)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            done = []
            for conv, _, n, turns, loss, chars in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or state[0] != conv:
                    if state:
                        done.append(state)
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[1] += n
                state[2].update(turns)
                state[3] += len(loss)
                state[4].update(loss.encode("utf-8"))
                state[5] += chars
            if done:
                yield rows(done)
        if state:
            yield rows([state])

    def rows(states: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([x.hexdigest() if hasattr(x, "hexdigest") else x for x in column], pa.string() if i in (2, 4) else pa.int64())
             for i, column in enumerate(zip(*states))], names=DIGEST.names)

    parsed = pieces.select("conv_id", "piece", "formatted", "spans").mapInArrow(parse, shape)
    return parsed.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(digest, DIGEST)
