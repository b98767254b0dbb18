"""The registered queries of the corpus operators, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm import bpe, conversations, line_dedup, media, mixing, pieces, pii, quality, sharding, simhash, spelling, suffix_dedup, toxicity
from wakeline.session import settle, table


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    lines = pages.select("page_id", line_dedup.host_of(F.col("url")).alias("host"), line_dedup.page_text(F.col("html")).alias("text"))
    lines = settle(lines)  # counted and filtered: the markup is taken apart once
    out = line_dedup.drop_boilerplate(lines, "host")
    return out.select("page_id", "host", "n_lines", "n_dropped", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, sf_dir, "documents"), keep_bytes=False).drop("kept")


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.copies(media.drawn(table(spark, sf_dir, "embeddings")))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", (toxicity.fold("doc_id") == 0).alias("held_out"), "score", "predicted")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"), "doc_id").select("doc_id", "slot", "shard")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit(table(spark, sf_dir, "conversations"), faults=True)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), damage=199)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_media": op3_media,
    "op4_bpe": op4_bpe,
    "op5_pii": op5_pii,
    "op6_simhash": op6_simhash,
    "op7_mixing": op7_mixing,
    "op8_toxicity": op8_toxicity,
    "op9_sharding": op9_sharding,
    "op10_quality": op10_quality,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_conversations": op12_conversations,
    "op13_spelling": op13_spelling,
}
ORACLE_SQL = {
    "op1_line_dedup": line_dedup.sql(),
    "op9_sharding": sharding.sql(),
    "op10_quality": quality.sql(),
}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it imports this subpackage

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return QUERIES | {"pipeline": pipeline}
