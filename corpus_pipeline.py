"""The corpus pipeline: documents in, token ids out, five stages.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept and
returns the columns of documents, extra ones of any name too; the last returns ids.
A null text counts as empty. Rows without an id are never dropped as copies, lose
no lines and are counted like all others. Rows that repeat an id are judged each by
its own text, but share what is said of the id: its near-duplicate group and its
benchmark hits. Ties go to the smaller id. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termweave.llm import bpe, decontaminate, jaccard, lines, quality
from termweave.llm.queries import TOKENIZER
from termweave.llm.tables import clear, mark, read, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the classifier, fitted on these documents' labels, takes for good: a score of 0.5 or more, empty texts by the constant alone."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    packed = docs.select("text", F.struct(*(docs[c] for c in docs.columns if c != "text")).alias("row"))
    return quality.score(packed, model).where("predicted = 1").select(*("text" if c == "text" else F.col(f"row.`{c}`") for c in docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts the aligned common lines from later documents; a document of which no text is left goes, one that lost nothing stays even if empty."""
    kept = lines.dedup(docs, carry=[c for c in docs.columns if c not in ("doc_id", "text")])
    kept = kept.where((F.trim("kept") != "") | (F.col("n_removed") == 0)).withColumn("text", F.col("kept"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least id of each group of near duplicates, with all its rows, and every row without an id or words."""
    found = jaccard.similar_components(docs)
    return docs.join(found.where("doc_id <> component_id").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the ids that hold a benchmark item; rows without an id stay."""
    found = decontaminate.leaks(docs, read(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit) of all that is left, null ids too; an empty text has no ids."""
    return bpe.encode_decode(docs, TOKENIZER).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("bpe encoding and decoding", bpe_codec),
]

#: No stage but the line counts can be said in SQL; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. What a stage wrote on the way is deleted once its result is written."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        since = mark()
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
            clear(spark, since, keep=docs)
    return docs
