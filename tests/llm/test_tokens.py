"""Operators 1 and 10 against the libraries."""

import hashlib
import random
import zlib
from array import array

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import sentencepieces as sp
from ledgerlens.llm import tokenfiles as tf
from .conftest import DOC, prose

ODD = [
    "", " ", "  two  spaces ", "line\nbreak\n\n", "tab\tand\rmore", "▁ low line ▁▁", "a" * 3000, "é" * 500, "漢字とかな 😀", "\x00nul", "</s> <0x41> <unk>",
    "THE End. (Quote) it's 3.14!", "e\u0301 combining", "İ! ΟΔΟΣ, ΟΔΟΣ", "\x1c\x85\u2028", "<|endoftext|> x", " ".join(prose(1, 4000)),
]


def test_piece_model_equals_the_library(pieces_path):
    sentencepiece = pytest.importorskip("sentencepiece")
    library, ours = sentencepiece.SentencePieceProcessor(model_file=pieces_path), sp.model(pieces_path)
    r = random.Random(2)
    alphabet = list(" \t\n▁ abcdeinthgrs.,!?'\"()[]{}0123456789éñüß漢ひ😀\x00\u0301_-/\\<>") + ["</s>", "the", "ing", "   ", "aaaa"]
    for text in ODD + ["".join(r.choice(alphabet) for _ in range(r.randint(0, 25))) for _ in range(3000)]:
        ids = np.frombuffer(ours.encode(text), dtype=np.int32)
        assert ids.tolist() == library.encode(text), text
        assert ours.decode(ids) == library.decode(ids.tolist()), text
    for _ in range(3000):  # ids that no text gives: stray bytes, control ids, the unknown id
        ids = [r.choice([0, 1, 2, r.randrange(3, 259), r.randrange(32000), 29871]) for _ in range(r.randint(0, 9))]
        assert ours.decode(np.array(ids, dtype=np.int64)) == library.decode(ids), ids


def test_every_accepted_pair_is_what_merging_gives(pieces_path):
    ours, r = sp.model(pieces_path), random.Random(3)
    known = list(ours.ends)
    for _ in range(5000):
        a, b = r.choice(known), r.choice(known)
        assert ours._remerge(a, b) == (ours.merged(a + b) == [a, b]), (a, b)


def test_encode_decode_rows(spark, pieces_path):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(99, None), (99, None), (None, "x")]
    docs = spark.createDataFrame(rows, DOC).withColumn("ids", F.lit("clash")).withColumn("lang", F.lit("en"))
    out = sp.encode_decode(docs, pieces_path)
    assert set(out.columns) == {"doc_id", "text", "lang", "ids", "decoded"}
    got = sorted(map(str, sp.digests(out).collect()))
    want = []
    for i, t in rows:
        ids = library.encode(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert got == sorted(f"Row(doc_id={a}, n_tokens={b}, ids_sha256={c!r}, decoded_sha256={d!r})" for a, b, c, d in want)
    assert sp.decode(sp.encode(docs, pieces_path), pieces_path).where("doc_id = 3").first().decoded == ODD[3]
    assert sp.digests(sp.encode_decode(docs.where("false"), pieces_path)).count() == 0


def test_packed_ids_random_access():
    r = random.Random(1)
    for n in (0, 1, 7, 511, 512, 513, 3000):
        ids = np.array([r.choice([0, 255, 256, 49407, 65536, 2**31, 2**32 - 1]) for _ in range(n)], dtype=np.uint32)
        packed = tf.Packed(tf.pack(ids))
        assert len(packed) == n and (packed.all() == ids).all() and [packed[i] for i in range(n)] == ids.tolist()
    with pytest.raises(ValueError):
        tf.Packed(b"other bytes")


def test_words_equal_the_library(words_path):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(words_path)
    r = random.Random(4)
    alphabet = list(" \t\n\r\x1c\x85   aAbBsStTdD'.,!?-_019ßΣσςİıÉéǅﬁ\u0301漢😀\x00’") + ["'s", "'ll", "The", "</w>", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|"]
    texts = ODD + ["".join(r.choice(alphabet) for _ in range(r.randint(0, 25))) for _ in range(4000)]
    ours = [np.frombuffer(x, dtype=np.uint32).tolist() for x in tf.words(words_path).encode(texts)]
    assert ours == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_words_that_recur_are_learnt_once(words_path, monkeypatch):
    """A full memory forgets words that do not recur, not those of every text; ids stay those of the library."""
    monkeypatch.setattr(tf, "REMEMBERED", 400)
    coder, learnt = tf.Words(words_path), []
    learn = coder.learn
    monkeypatch.setattr(coder, "learn", lambda words: (learnt.extend(words), learn(words)))
    texts = ["the common words of all texts " + " ".join(f"rare{'abcdefghij'[i % 10]}{'klmnopqrst'[j % 10]}{'uvwxyz'[(i + j) % 6]}{chr(97 + i)}" for j in range(60)) for i in range(20)]
    got = [coder.encode([t])[0] for t in texts]
    assert got == [array("I", x.ids).tobytes() for x in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert learnt.count("common") == 1 and len(learnt) > 400
    assert len(coder) + len(coder.before) <= 400 + 2 * 70


def test_files_round_trip_and_random_access(spark, words_path, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(words_path)
    rows = [(100 - i, t) for i, t in enumerate(ODD)] + [(7, None), (7, None), (7, "b"), (None, "null id")]
    docs = spark.createDataFrame(rows, DOC).withColumn("start", F.lit(1)).repartition(5)
    tf.write(docs, words_path, str(tmp_path / "ids"))
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in tf.digests(tf.read(spark, str(tmp_path / "ids"))).collect())
    start, want, flat = 0, [], []
    for doc_id, text in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((start, doc_id, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        flat += ids
        start += len(ids)
    assert got == want
    wanted = [0, 5, len(flat) - 1, len(flat) // 2, len(flat)]
    found = tf.ids_at(spark, str(tmp_path / "ids"), spark.createDataFrame([(p,) for p in wanted], "position long"))
    assert dict(map(tuple, found.collect())) == {p: flat[p] if p < len(flat) else None for p in wanted}
    assert tf.digests(tf.round_trip(docs.where("false"), words_path)).count() == 0
