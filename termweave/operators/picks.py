"""Mapping answers: extraction, validation, recovery, formatting, scoring (I)."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.text import normal_name
from ._rank import top
from .hierarchy import within_levels

#: Target vocabularies in order of preference.
VOCABULARY_ORDER = ["SNOMED", "LOINC", "CPT4", "HCPCS", "ICD10PCS", "ICD9Proc", "OPCS4", "OMOP Extension"]
PREDICATES = ["exactMatch", "broadMatch"]
SUBMISSION = ["source_data_identifier", "source_code", "source_name", "target_concept_id", "target_concept_name", "alternative_target_concept_id", "alternative_target_concept_name", "predicate", "row_id"]
_KEY = ["source_data_identifier", "source_code"]


def first_by_key(df: DataFrame, keys: list[str], row_id: str = "row_id") -> DataFrame:
    """The first row of each key in the order of row_id."""
    return top(df, keys, [row_id], 1, "_turn").drop("_turn")


def dedupe_sources(df: DataFrame) -> DataFrame:
    return first_by_key(df, _KEY)


def request_text(df: DataFrame) -> Column:
    """The request of a source: key, code, name, and the native name when it differs."""
    native = F.when(F.col("original_source_name").isNotNull() & (normal_name(F.col("original_source_name")) != normal_name(F.col("source_name"))), F.concat(F.lit("Original name: "), F.col("original_source_name")))
    return F.concat_ws("\n", F.concat(F.lit("Source: "), F.col("source_data_identifier").cast("string")), F.concat(F.lit("Code: "), F.col("source_code")), F.concat(F.lit("Name: "), F.col("source_name")), native)


def last_answer(text: str | None) -> str | None:
    """The last balanced JSON object or array that names target_concept_id and parses; an opener without end takes the rest."""
    found, at = None, 0
    text = text or ""
    while at < len(text):
        if text[at] not in "{[":
            at += 1
            continue
        depth, inside, escaped, end = 0, False, False, None
        for i in range(at, len(text)):
            c = text[i]
            if inside:
                inside = escaped or c != '"'
                escaped = c == "\\" and not escaped
            elif c == '"':
                inside = True
            elif c in "{[":
                depth += 1
            elif c in "}]":
                depth -= 1
                if not depth:
                    end = i + 1
                    break
        if end is None:
            break
        piece = text[at:end]
        if '"target_concept_id"' in piece:
            try:
                json.loads(piece)
                found = piece
            except ValueError:
                pass
        at = end
    return found


@F.pandas_udf(StringType())
def extract_answers(texts: pd.Series) -> pd.Series:
    return texts.map(last_answer)


#: What a pick may hold.
PICK = "struct<target_concept_id:string,target_concept_name:string,predicate:string,reasoning:string>"


def parse_picks(answer: Column) -> Column:
    """The picks of an answer: an array stays, an object is an array of one."""
    one = F.when(F.substring(F.ltrim(answer), 1, 1) == "[", answer).otherwise(F.concat(F.lit("["), answer, F.lit("]")))
    return F.from_json(one, f"array<{PICK}>")


def fan_out_picks(df: DataFrame, picks: str = "picks", error: str = "error") -> DataFrame:
    """One row a pick with pick_index and n_targets; no answer gives one row with no_json_extracted, no pick one empty row."""
    found = F.filter(picks, lambda p: p.isNotNull())
    n = F.coalesce(F.size(found), F.lit(0))
    listed = F.when(n > 0, found).otherwise(F.array(F.lit(None).cast(PICK)))
    rows = df.withColumn("n_targets", n.cast("long")).withColumn("_none", F.when(F.col(picks).isNull(), F.lit("no_json_extracted"))).select("*", F.posexplode(listed).alias("pick_index", "pick"))
    errors = F.concat_ws("|", F.col(error), F.col("_none")) if error in df.columns else F.concat_ws("|", F.col("_none"))
    return rows.withColumn("error", F.when(errors != "", errors)).withColumn("pick_index", F.col("pick_index").cast("long")).select(*(c for c in df.columns if c not in (picks, error)), "pick_index", "n_targets", "pick.*", "error")


def pad_picks(picks: Column, n: int) -> Column:
    """Exactly n picks: cut, or filled up with nulls."""
    return F.slice(F.concat(F.coalesce(picks, F.array().cast(f"array<{PICK}>")), F.array_repeat(F.lit(None).cast(PICK), n)), 1, n)


def validate_picks(picks: DataFrame, concepts: DataFrame, check_name: bool = True) -> DataFrame:
    """picks with target_concept_id, name and vocabulary as the vocabulary has them, and validation_error; the first failing rule decides."""
    known = concepts.select(F.col("concept_id").alias("_id"), F.col("concept_name").alias("_name"), F.col("vocabulary_id").alias("_vocabulary"), F.col("standard_concept").alias("_standard"), F.col("invalid_reason").alias("_invalid"))
    number = F.col("target_concept_id").cast("string").try_cast("bigint")
    rows = picks.withColumn("_wanted", number).join(known, F.col("_wanted") == F.col("_id"), "left")
    given = normal_name(F.col("target_concept_name")) if "target_concept_name" in picks.columns else F.lit("")
    error = (
        F.when(F.col("target_concept_id").isNull(), "no_target")
        .when(F.col("_wanted").isNull(), "not_an_integer")
        .when(F.col("_id").isNull(), "not_in_vocabulary")
        .when(~F.col("_standard").eqNullSafe(F.lit("S")), "not_standard")
        .when(F.col("_invalid").isNotNull(), "invalid")
    )
    if check_name:
        error = error.when((given != "") & (given != normal_name(F.col("_name"))), "name_mismatch")
    rows = rows.withColumn("validation_error", error)
    kept = [c for c in picks.columns if c not in ("target_concept_id", "target_concept_name", "target_vocabulary")]
    return rows.select(*kept, F.when(F.col("validation_error").isNull(), F.col("_wanted")).alias("target_concept_id"), F.col("_name").alias("target_concept_name"), F.col("_vocabulary").alias("target_vocabulary"), "validation_error")


def recovery_candidates(preds: DataFrame) -> DataFrame:
    return preds.where("target_concept_id is null and coalesce(session_id, '') <> ''")


def apply_recovery(preds: DataFrame, patches: DataFrame, concepts: DataFrame) -> DataFrame:
    """preds(row_id, session_id, target_concept_id, ...) with validated patches(row_id, patch_id, declined, reasoning) filled in and recovery_error set."""
    checked = validate_picks(patches.withColumnRenamed("patch_id", "target_concept_id"), concepts, check_name=False).select("row_id", F.col("target_concept_id").alias("_new"), F.col("target_concept_name").alias("_name"), "declined", F.col("reasoning").alias("_why"), F.col("validation_error").alias("_error"), F.lit(True).alias("_patched"))
    rows = preds.join(checked, "row_id", "left")
    open_row = F.col("target_concept_id").isNull()
    error = F.when(~open_row, F.lit(None)).when(F.coalesce("session_id", F.lit("")) == "", "no_session_id").when(F.col("_patched").isNull(), "no_json").when(F.col("declined"), "declined").otherwise(F.col("_error"))
    rows = rows.withColumn("recovery_error", error)
    fill = open_row & F.col("recovery_error").isNull()
    return rows.select(*(c for c in preds.columns if c not in ("target_concept_id", "target_concept_name", "reasoning")), F.when(fill, F.col("_new")).otherwise(F.col("target_concept_id")).alias("target_concept_id"), F.when(fill, F.col("_name")).otherwise(F.col("target_concept_name")).alias("target_concept_name"), F.when(open_row, F.col("_why")).otherwise(F.col("reasoning")).alias("reasoning"), "recovery_error")


def validate_targets(ids: DataFrame, concepts: DataFrame) -> DataFrame:
    return concepts.join(ids.select("concept_id").distinct(), "concept_id", "left_semi").select("concept_id", "concept_name", "vocabulary_id", "standard_concept", "invalid_reason")


def format_submission(test: DataFrame, preds: DataFrame, concepts: DataFrame, align: str = "key") -> DataFrame:
    """The submission's columns: test left-joined to preds on the key, names as the vocabulary has them.

    align="key" pairs every test row with every prediction of its key;
    align="position" pairs the nth with the nth.
    """
    answers = ["target_concept_id", "target_concept_name", "alternative_target_concept_id", "alternative_target_concept_name", "predicate"]
    left = test.drop(*answers).withColumns({k: F.col(k).cast("string") for k in _KEY})
    right = preds.select(*(F.col(k).cast("string").alias(k) for k in _KEY), "row_id", "target_concept_id", F.col("alternative_target_concept_id") if "alternative_target_concept_id" in preds.columns else F.lit(None).cast("long").alias("alternative_target_concept_id"), "predicate")
    on = list(_KEY)
    if align == "position":
        left, right = (top(df, _KEY, ["row_id"], None, "_at") for df in (left, right))
        on.append("_at")
    rows = left.join(right.drop("row_id"), on, "left")
    for side in ("target", "alternative_target"):
        named = concepts.select(F.col("concept_id").alias(f"{side}_concept_id"), F.col("concept_name").alias(f"{side}_concept_name"))
        rows = rows.join(named, f"{side}_concept_id", "left")
    return rows.select(*SUBMISSION)


def submission_report(submission: DataFrame, concepts: DataFrame) -> DataFrame:
    """One row of counts, each a row of the submission."""
    known = concepts.select(F.col("concept_id").alias("target_concept_id"), F.col("standard_concept"), F.lit(True).alias("known"))
    rows = submission.join(known, "target_concept_id", "left")
    target = F.col("target_concept_id").isNotNull()
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return rows.agg(
        F.count("*").alias("n_rows"), count(~target).alias("n_unmapped"), count(F.col("predicate").isNotNull() & ~F.col("predicate").isin(PREDICATES)).alias("n_invalid_predicate"),
        count(target & F.col("known") & ~F.col("standard_concept").eqNullSafe(F.lit("S"))).alias("n_non_standard"), count(target & F.col("known").isNull()).alias("n_not_in_vocabulary"),
    )


def score_rows(preds: DataFrame, truth: DataFrame, closure: DataFrame) -> DataFrame:
    """Prediction rows against the truth row of the same place within the key: exact, predicate_ok, near, joint."""
    keyed = lambda df: top(df.withColumns({k: F.col(k).cast("string") for k in _KEY}), _KEY, ["row_id"], None, "at")
    t = keyed(truth).select(*_KEY, "at", F.col("target_concept_id").alias("true_id"), F.col("alternative_target_concept_id").alias("other_id"), F.col("predicate").alias("true_predicate"))
    rows = keyed(preds).join(t, [*_KEY, "at"], "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    near = within_levels(closure, rows.select(F.col("row_id").alias("pair_id"), F.col("target_concept_id").alias("left_id"), F.col("true_id").alias("right_id")), 3).select(F.col("pair_id").alias("row_id"), "near")
    rows = rows.withColumn("exact", yes(F.col("target_concept_id") == F.col("true_id")) | yes(F.col("target_concept_id") == F.col("other_id"))).withColumn("predicate_ok", yes(F.lower("predicate") == F.lower("true_predicate")))
    return rows.join(near, "row_id").withColumn("joint", F.col("exact") & F.col("predicate_ok"))


def score_report(scored: DataFrame) -> DataFrame:
    """n, and count and percentage (2 places) of each mark."""
    marks = ["exact", "predicate_ok", "near", "joint"]
    return scored.agg(F.count("*").alias("n"), *(F.sum(F.col(m).cast("long")).alias(f"n_{m}") for m in marks), *(F.round(100 * F.avg(F.col(m).cast("double")), 2).alias(f"pct_{m}") for m in marks))


def missing_truth(preds: DataFrame, truth: DataFrame) -> DataFrame:
    text = lambda df: df.select(*(F.col(k).cast("string").alias(k) for k in _KEY)).distinct()
    return text(preds).join(text(truth), _KEY, "left_anti")


def retrieval_metrics(ranked: DataFrame, truth: DataFrame, ks: tuple[int, ...] = (1, 5, 10), by: tuple[str, ...] = ()) -> DataFrame:
    """Acc@k, mean reciprocal rank, mean rank and similarity of found ones, of truth(query_id, target_id, other_id[, by])."""
    hit = (F.col("concept_id") == F.col("target_id")) | F.coalesce(F.col("concept_id") == F.col("other_id"), F.lit(False))
    first = ranked.join(truth.select("query_id", "target_id", "other_id"), "query_id").where(hit).groupBy("query_id").agg(F.min("rank").alias("rank"), F.min_by("similarity", "rank").alias("similarity"))
    rows = truth.join(first, "query_id", "left")
    at = [F.round(F.avg(F.coalesce((F.col("rank") <= k).cast("double"), F.lit(0.0))), 6).alias(f"acc_{k}") for k in ks]
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *at, F.round(F.avg(F.coalesce(1.0 / F.col("rank"), F.lit(0.0))), 6).alias("mrr"), F.round(F.avg("rank"), 6).alias("mean_rank"), F.round(F.avg("similarity"), 9).alias("mean_similarity"))


def complementarity(found: DataFrame) -> DataFrame:
    """Of found(method, query_id): queries only that method found, all it found, and the union's size."""
    each = found.select("method", "query_id").distinct().withColumn("n", F.count("*").over(Window.partitionBy("query_id")))
    total = found.agg(F.countDistinct("query_id").alias("n_union"))
    return each.groupBy("method").agg(F.count("*").alias("n_found"), F.count_if(F.col("n") == 1).alias("n_only")).join(F.broadcast(total))


def category_summary(misses: DataFrame) -> DataFrame:
    """Rows and share of each category."""
    total = misses.agg(F.count("*").alias("total"))
    return misses.groupBy("category").agg(F.count("*").alias("n")).join(F.broadcast(total)).select("category", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


def prefer_vocabulary(candidates: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Candidates(query_id, concept_id, vocabulary_id) by place of their vocabulary in the order; others come last."""
    place = F.array_position(F.array(*map(F.lit, order or VOCABULARY_ORDER)), F.col("vocabulary_id"))
    return top(candidates.withColumn("preference", F.when(place == 0, F.lit(len(order or VOCABULARY_ORDER) + 1)).otherwise(place).cast("long")), ["query_id"], ["preference", "concept_id"], None)


def run_summary(preds: DataFrame) -> DataFrame:
    """Rows, rows with an error, and the first five errors, joined."""
    five = preds.where("error is not null").orderBy("row_id").limit(5).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_id", "error"))), lambda x: x["error"]), ";").alias("first_errors"))
    return preds.agg(F.count("*").alias("n_rows"), F.count("error").alias("n_errors")).join(F.broadcast(five))
