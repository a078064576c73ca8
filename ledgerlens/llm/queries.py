"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    chat, decontam, jaccard, language, lexical, lines, quality, sentencepieces, tokenfiles, topk, toxicity, urls, vectorcodes,
)
from ledgerlens.llm.common import table

#: Files of the public vocabularies; they lie in the same place on every machine.
PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def op1_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return sentencepieces.digests(sentencepieces.encode_decode(docs, PIECES, keep=["doc_id"]))


def op2_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Each document that stays, with the digest of its remaining text and the number of its lines that went."""
    out = lines.dedup(table(spark, d, "documents").select("doc_id", "text"), with_counts=True)
    return out.select("doc_id", "lines_dropped", F.length("text").alias("chars_left"), F.md5("text").alias("text_md5"))


def op3_top_k(spark: SparkSession, d: str) -> DataFrame:
    return topk.search(table(spark, d, "embeddings"), k=10, every=100)


def op4_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontam.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op5_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs, fold = table(spark, d, "documents").select("doc_id", "text"), quality.held_out(F.col("doc_id"), 5, 0)
    model = toxicity.fit(docs, table(spark, d, "labels").where(~fold))
    scored = toxicity.score(docs, model, keep=["doc_id"]).withColumn("held_out", fold)
    return quality.predicted(scored, 0.5).select("doc_id", "held_out", "score", "predicted")


def op6_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return jaccard.classes(table(spark, d, "documents"), words=3, num=90, den=100).select("doc_id", "n_shingles", "component_id")


def op7_url_filter(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return urls.judge(table(spark, d, "pages"), rules)


#: What op8 and the pipeline take for good.
GOOD_FROM = 0.7


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.QualityModel:
    """Learnt from the labels of the three folds that are not held out."""
    return quality.fit(docs, labels.where(~quality.held_out(F.col("doc_id"), 4, 2)))


def op8_quality(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality_model(docs, table(spark, d, "labels")), keep=["doc_id"])
    return quality.predicted(scored.withColumn("held_out", quality.held_out(F.col("doc_id"), 4, 2)), GOOD_FROM).select(
        "doc_id", "held_out", "score", "predicted")


#: A conversation whose texts hold the control strings of the template.
TRICKY = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op9_chat(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(TRICKY, "conv_id long, turn long, role string, text string"))
    template = chat.InstTemplate()
    return chat.read_back(chat.format_conversations(rows, template), template)


def op10_token_files(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return tokenfiles.digests(tokenfiles.round_trip(docs, WORDS))


def op11_language_id(spark: SparkSession, d: str) -> DataFrame:
    """The nearest language of every document; ``rejected`` marks texts far from all that was learnt."""
    docs, fold = table(spark, d, "documents").select("doc_id", "text", "lang"), quality.held_out(F.col("doc_id"), 4, 2)
    model = language.fit(docs.where(~fold))
    found = language.predict(docs.select("doc_id", "text"), model, keep=["doc_id"]).withColumn("held_out", fold)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op12_vector_codes(spark: SparkSession, d: str) -> DataFrame:
    coded, books = vectorcodes.compress(table(spark, d, "embeddings"))
    return vectorcodes.with_label_errors(coded).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op13_lexical_search(spark: SparkSession, d: str) -> DataFrame:
    return lexical.search(table(spark, d, "documents"), table(spark, d, "benchmark"), k=10)


QUERIES = {
    "op2_line_dedup": op2_line_dedup,
    "op3_top_k": op3_top_k,
    "op4_decontamination": op4_decontamination,
    "op5_toxicity": op5_toxicity,
    "op6_jaccard_join": op6_jaccard_join,
    "op8_quality": op8_quality,
    "op1_sentencepiece": op1_sentencepiece,
    "op7_url_filter": op7_url_filter,
    "op9_chat": op9_chat,
    "op10_token_files": op10_token_files,
    "op11_language_id": op11_language_id,
    "op12_vector_codes": op12_vector_codes,
    "op13_lexical_search": op13_lexical_search,
}
