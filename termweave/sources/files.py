"""File sources and sinks (A)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

#: Columns of the vocabulary files, in order.
VOCABULARY_FILES = {
    "concept": "concept_id long, concept_name string, domain_id string, vocabulary_id string, concept_class_id string, standard_concept string, concept_code string, valid_start_date string, valid_end_date string, invalid_reason string",
    "concept_ancestor": "ancestor_concept_id long, descendant_concept_id long, min_levels_of_separation long, max_levels_of_separation long",
    "concept_relationship": "concept_id_1 long, concept_id_2 long, relationship_id string, valid_start_date string, valid_end_date string, invalid_reason string",
    "concept_synonym": "concept_id long, concept_synonym_name string, language_concept_id long",
    "drug_strength": "drug_concept_id long, ingredient_concept_id long, amount_value double, amount_unit_concept_id long, numerator_value double, numerator_unit_concept_id long, denominator_value double, denominator_unit_concept_id long, box_size long, valid_start_date string, valid_end_date string, invalid_reason string",
    "domain": "domain_id string, domain_name string, domain_concept_id long",
    "vocabulary": "vocabulary_id string, vocabulary_name string, vocabulary_reference string, vocabulary_version string, vocabulary_concept_id long",
    "relationship": "relationship_id string, relationship_name string, is_hierarchical string, defines_ancestry string, reverse_relationship_id string, relationship_concept_id long",
    "concept_class": "concept_class_id string, concept_class_name string, concept_class_concept_id long",
}
CATALOGUE_COLUMNS = ["cohortId", "cohortName", "status", "logicDescription", "hashTag", "numberOfConceptSets", "numberOfInclusionRules"]
PREDICTION_COLUMNS = ["source_data_identifier", "source_code", "target_concept_id", "predicate"]
TRUTH_COLUMNS = ["source_data_identifier", "source_code", "target_concept_id", "alternative_target_concept_id", "predicate"]


def load_vocabulary(spark: SparkSession, folder: str, tables: list[str] | None = None) -> dict[str, DataFrame]:
    """Tab-delimited vocabulary files with a header and no quoting, by table; all nine unless told which."""
    return {name: spark.read.schema(VOCABULARY_FILES[name]).csv(f"{folder}/{name.upper()}.csv", sep="\t", header=True, quote="") for name in tables or VOCABULARY_FILES}


def table(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """A stored table, also as a temporary view, `schema_name` where a schema is given."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    df.createOrReplaceTempView(f"{schema}_{name}" if schema else name)
    return df


def embedding_metadata(concepts: DataFrame, mode: str = "standard") -> DataFrame:
    """The valid rows to be embedded: standard, nonstandard or all."""
    rows = concepts.where("invalid_reason is null")
    if mode == "standard":
        return rows.where("standard_concept = 'S'")
    if mode == "nonstandard":
        return rows.where("coalesce(standard_concept, 'X') <> 'S'")
    if mode == "all":
        return rows
    raise ValueError(f"unknown mode {mode}: standard, nonstandard or all")


def build_embedding_table(metadata: DataFrame, vectors: DataFrame, dims: int) -> DataFrame:
    """metadata with vectors(concept_id, embedding) joined by id; a vector of another length fails the job."""
    joined = metadata.join(vectors.select("concept_id", "embedding"), "concept_id")
    right = F.assert_true(F.size("embedding") == dims, F.lit(f"a vector has not {dims} dimensions"))
    return joined.withColumn("embedding", F.when(right.isNull(), F.col("embedding")))


def missing_vectors(metadata: DataFrame, vectors: DataFrame) -> DataFrame:
    return metadata.select("concept_id").join(vectors.select("concept_id"), "concept_id", "left_anti")


def read_catalogue_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A cohort catalogue: header names without byte-order mark, quotes and blanks; rows without an integer cohortId go."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    rows = raw.toDF(*(c.lstrip("﻿").strip().strip('"').strip() for c in raw.columns))
    rows = rows.select(*(F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns))
    return rows.withColumn("cohortId", F.col("cohortId").try_cast("bigint")).where("cohortId is not null")


def _qualified(spark: SparkSession, folder: str):
    """The folder's Hadoop path, with its scheme, and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.makeQualified(path), store


def write_files(rows: DataFrame, folder: str) -> None:
    """A file for each of rows(name, value) in a folder, written by the tasks that hold the rows.

    A file gets its name only when it is whole, so a task that runs twice does no
    harm. File systems that pyarrow doesn't know are written to by the driver, a
    file at a time.
    """
    spark = rows.sparkSession
    at, store = _qualified(spark, folder)
    uri = at.toUri()
    scheme = {"s3a": "s3", "s3n": "s3"}.get(uri.getScheme(), uri.getScheme())
    where = f"{scheme}://{uri.getAuthority() or ''}{uri.getRawPath()}"
    store.mkdirs(at)
    try:
        fs.FileSystem.from_uri(where)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
        for r in rows.toLocalIterator():
            out = store.create(spark._jvm.org.apache.hadoop.fs.Path(at, r.name))
            out.write(bytearray(r.value.encode()))
            out.close()
        return

    def write(part: Iterator[Row]) -> None:
        own, root = fs.FileSystem.from_uri(where)
        for r in part:
            draft = f"{root}/_{uuid.uuid4().hex}"
            with own.open_output_stream(draft) as out:
                out.write(r.value.encode())
            own.move(draft, f"{root}/{r.name}")

    rows.select("name", "value").repartition(spark.sparkContext.defaultParallelism).foreachPartition(write)


def read_definitions(spark: SparkSession, folder: str) -> DataFrame:
    """cohortId and json of each <id>.json file of a folder; the folder is listed once, however many files it has."""
    depth = _qualified(spark, folder)[0].toUri().getPath().rstrip("/").count("/") + 1
    found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(folder, wholetext=True)
    inside = F.regexp_replace(F.col("_metadata.file_path"), "^[^:/]+:(//[^/]*)?", "")
    rows = found.where(F.size(F.split(inside, "/")) == depth + 1).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)\.json$", 1).alias("id"), F.col("value").alias("json"))
    return rows.select(F.col("id").try_cast("bigint").alias("cohortId"), "json").where("cohortId is not null")


def read_query_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """path and content of every markdown file below a folder."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Prediction rows as strings; a required column that lacks is an error."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    lacking = [c for c in PREDICTION_COLUMNS if c not in df.columns]
    if lacking:
        raise ValueError(f"predictions lack {', '.join(lacking)}")
    return df


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, multiLine=True, escape='"').select(*TRUTH_COLUMNS)


def write_predictions(df: DataFrame, path: str, form: str = "csv") -> None:
    (df.write.option("header", True).option("escape", '"') if form == "csv" else df.write).format(form).save(path)


def capped_select(df: DataFrame, order: list[str], n: int = 1000) -> DataFrame:
    """The first n rows in an order, which makes the cut the same each time."""
    return df.orderBy(*order).limit(n)


def transcript_text(messages: DataFrame, role: str, session: str = "conv_id", at: str = "turn") -> DataFrame:
    """One role's messages that aren't empty, in order, a line each, by session."""
    rows = messages.where(F.col("role") == role).where("coalesce(text, '') <> ''")
    return rows.groupBy(session).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, "text"))), lambda x: x["text"]), "\n").alias("transcript"))


def session_summary(sessions: DataFrame, messages: DataFrame, session: str = "conv_id", at: str = "last_turn", limit: int = 50) -> DataFrame:
    """Sessions with their number of messages, newest first."""
    counts = messages.groupBy(session).agg(F.count("*").alias("n_messages"))
    return sessions.join(counts, session, "left").withColumn("n_messages", F.coalesce("n_messages", F.lit(0))).orderBy(F.col(at).desc(), session).limit(limit)
