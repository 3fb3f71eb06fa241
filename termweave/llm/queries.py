"""The registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, bpe, chat, decontaminate, hnsw, jaccard, licenses, lines, naming, quality, secrets, substring, whitening
from .tables import read

#: The public tokenizer's file; every worker finds its own copy.
TOKENIZER = "byte_bpe_50k.json"


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(read(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(read(spark, sf_dir, "documents"))
    names = F.array_join(F.array_sort(F.array_distinct(F.col("licences.licence"))), ",")
    return found.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"), F.array_join("sentence_ids", ",").alias("sentence_ids"), names.alias("licences"))


def op3_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return hnsw.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.fit(docs))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), count("crf"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(read(spark, sf_dir, "conversations"))


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(read(spark, sf_dir, "documents"), TOKENIZER)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.dedup(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.score(docs.select("doc_id", "text"), model).select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.dedup(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naming.dedup(read(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_jaccard_join, op2_license_scan, op3_nearest_vectors, op4_secret_scan, op5_decontamination, op6_chat_formatting, op7_bpe_codec, op8_line_dedup, op9_quality_classifier, op10_substring_dedup,
        op11_exact_dedup, op12_filter_audit, op13_embedding_whitening, pipeline,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op6_chat_formatting": chat.sql(), "op11_exact_dedup": naming.SQL, "op12_filter_audit": audit.SQL}
