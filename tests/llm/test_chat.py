"""Operator 9."""

import hashlib
import random

from pyspark.sql import functions as F

from ledgerlens.llm import chat

ROWS = "conv_id long, turn long, role string, text string"
T = chat.InstTemplate()


def test_template_is_reversible_and_spans_are_exact():
    r = random.Random(1)
    parts = ["[", "<", "\\", "INST]", "/INST]", "/s>", "s>", "ROLE]", "SAYS]", " ", "</s>", "[INST] ", " [/INST]", "x", "\n", "[SAYS]"]
    for _ in range(4000):
        turns = [(r.choice(["user", "assistant", "system", "", "a [SAYS] b"]), "".join(r.choice(parts) for _ in range(r.randint(0, 6)))) for _ in range(r.randint(1, 5))]
        assert T.parse(T(turns)) == turns
        out, spans, rewritten = chat.render_piece(T, turns[:1], turns[1:], "assistant", {})
        assert T(turns[:1]) + out == T(turns) and not rewritten
        assert [T.unescape(out[s["loss_start"]:s["loss_end"]]) for s in spans if s["loss_start"] >= 0] == [t for role, t in turns[1:] if role == "assistant"]


def test_rewriting_templates_are_found():
    def keeps_last_thought(turns):  # drops the thoughts of all turns but the last
        return "".join(f"<{r}>{t if i == len(turns) - 1 else t.split('|')[-1]}</{r}>" for i, (r, t) in enumerate(turns))

    turns = [("user", "q"), ("assistant", "think|answer"), ("user", "more"), ("assistant", "hm|ok")]
    out, spans, rewritten = chat.render_piece(keeps_last_thought, [], turns, "assistant", {})
    assert rewritten == [2] and out == "<user>q</user><assistant>answer</assistant><user>more</user><assistant>hm|ok</assistant>"
    assert [out[s["loss_start"]:s["loss_end"]] for s in spans if s["loss_start"] >= 0] == ["hm|ok"]
    assert chat.render_piece(T, [], turns, "assistant", {})[2] == []


def expected(rows):
    by = {}
    for c, n, r, t in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        by.setdefault(c, []).append((r or "", t or ""))
    out = {}
    for c, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(T(turns)))
    return out


def check(spark, rows):
    table = spark.createDataFrame(rows, ROWS).withColumn("piece", F.lit("clash"))
    pieces = chat.format_conversations(table, T)
    got = {r.conv_id: tuple(r)[1:] for r in chat.read_back(pieces, T).collect()}
    assert got == expected(rows)
    return pieces


def test_conversations(spark):
    tricky = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky), (1, 0, "system", "be"), (1, 1, "user", None), (1, 2, "assistant", ""), (1, 2, "assistant", ""),
            (2, None, None, "a"), (2, 5, "assistant", "é😀"), (None, 1, "tool", "x"), (None, 2, "assistant", "y" * 20000), (3, 1, "assistant", "a"), (3, 1, "user", "b")]
    assert check(spark, rows).count() >= 5
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], ROWS), T), T).count() == 0


def test_a_long_conversation_is_cut_into_pieces_over_several_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions would be merged again
    try:
        long_conversation(spark)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def long_conversation(spark):
    rows = [(9, i, ("user", "assistant")[i % 2], f"turn {i} [INST]") for i in range(700)] + [(i, 0, "user", "hello") for i in range(100, 140)]
    pieces = check(spark, rows).where("conv_id = 9").select("piece", F.size("spans").alias("n")).collect()
    assert len(pieces) >= 11 and max(p.n for p in pieces) <= chat.PIECE_TURNS
    assert len({p.piece >> 33 for p in pieces}) > 1


def rewriting_template():
    def last_thought_alone(turns):  # begins with the first text, drops the thoughts of all turns but the last
        return f"{{{turns[0][1]}}}" + "".join(f"<{r}>{t if i == len(turns) - 1 else t.split('|')[-1]}</{r}>" for i, (r, t) in enumerate(turns))

    return last_thought_alone  # not a global: tasks cannot import this file


last_thought_alone = rewriting_template()


def test_a_rewriting_template_sees_whole_conversations(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # borders inside the conversations
    try:
        rows = [(c, i, ("user", "assistant")[i % 2], f"thought {c}|text {i}") for c, n in ((1, 200), (2, 20), (3, 65)) for i in range(n)]
        pieces = chat.format_conversations(spark.createDataFrame(rows, ROWS).repartition(5), rewriting_template()).orderBy("conv_id", "piece").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for c, n in ((1, 200), (2, 20), (3, 65)):
        turns, mine = [(r, t) for k, _, r, t in rows if k == c], [p for p in pieces if p.conv_id == c]
        assert "".join(p.formatted for p in mine) == last_thought_alone(turns)
        assert [len(p.spans) for p in mine] == [min(64, n - at) for at in range(0, n, 64)]
        assert [64 * k + i for k, p in enumerate(mine) for i in p.rewritten] == list(range(1, n))
        assert all(0 <= s.start <= s.end <= len(p.formatted) for p in mine for s in p.spans)


def test_a_shortened_context_loses_no_text():
    turns = [("user", "long|q"), ("assistant", "a|b")]
    out, spans, rewritten = chat.render_piece(last_thought_alone, turns[:1], turns[1:], "assistant", {})
    assert rewritten == [0] and last_thought_alone(turns).endswith(out) and out.endswith("<assistant>a|b</assistant>") and spans[0]["end"] == len(out)
