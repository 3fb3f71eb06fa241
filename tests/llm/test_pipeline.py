"""Each stage of the pipeline against brute force, and the whole on the given tables."""

import os
import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from termweave.llm import decontaminate, quality

from .helpers import docs, empty, words
from .test_text_operators import PATH, brute_components, brute_lines, semi_global

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Labels and benchmark items as the stages read them."""
    folder = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(1)
    spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(i, " ".join(words(rng, 12, 900))) for i in range(3)] + [(9, None), (10, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    rng = random.Random(2)
    good, bad = ["river", "garden", "evening", "story"], ["$$$", "BUY!!", "###"]
    texts = [" ".join(rng.choice(good if i % 2 else bad) + ("" if j % 3 else "\n") for j in range(40)) for i in range(60)]
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() if r.text]
    shared = "\n".join(" ".join(words(rng, 9, 400)) for _ in range(4))
    long = " ".join(words(rng, 80, 700))
    more = ["", None, shared, f"first\n{shared}\nlast", shared, long, long + " end", long, f"x {items[0]} y", items[1].replace(items[1][5], "#", 1) + " tail", "word " * 30_000, shared, None]
    ids = [*range(60), *range(100, 110), 110, None, None]
    rows = docs(spark, texts + more, ids)
    return rows.union(rows.where("doc_id = 104")).withColumn("score", F.lit("clash")).withColumn("tag", F.lit(1)).repartition(3)


def as_rows(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def plain(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_quality_stage_keeps_what_is_predicted_good(spark, table, sf_dir):
    found = cp.quality_classifier(spark, table, sf_dir)
    assert found.columns == table.columns and {r.score for r in found.select("score").collect()} == {"clash"}
    model = quality.fit(table, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    want = quality.score(table.select("doc_id", "text"), model).where("score >= 0.5")
    assert as_rows(found) == as_rows(want)
    kept = {i for i, _ in plain(found)}
    assert all((i in kept) == bool(i % 2) for i in range(60))


def test_line_stage_is_brute_force(spark, table, sf_dir):
    found = cp.line_dedup(spark, table, sf_dir)
    want = [(i, kept) for i, _, gone, kept in brute_lines(plain(table)) if kept.strip(" ") or not gone]
    assert found.columns == table.columns and as_rows(found) == sorted(want, key=str)
    assert found.where("n_chars <> length(text)").count() == 0


def test_jaccard_stage_is_brute_force(spark, table, sf_dir):
    rows = plain(table)
    copies = {i for i, _, least in brute_components(rows) if i is not None and least != i}
    assert as_rows(cp.jaccard_join(spark, table, sf_dir)) == sorted(((i, t) for i, t in rows if i not in copies), key=str) and copies


def test_benchmark_stage_is_brute_force(spark, table, sf_dir):
    items = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() if r.text]
    near = lambda t: any(x in t if len(t) > 5000 else semi_global(x, t) <= len(x) * 8 // 100 for x in items)
    rows = plain(table)
    hit = {i for i, t in rows if i is not None and near(decontaminate.normal(t))}
    assert hit == {108, 109} and as_rows(cp.decontamination(spark, table, sf_dir)) == sorted(((i, t) for i, t in rows if i not in hit), key=str)


def test_codec_stage_is_the_library(spark, table, sf_dir):
    library = Tokenizer.from_file(PATH)
    want = [(i, b"".join(x.to_bytes(4, "little") for x in library.encode(t or "", add_special_tokens=False).ids)) for i, t in plain(table)]
    found = [(r.doc_id, bytes(r.ids)) for r in cp.bpe_codec(spark, table, sf_dir).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_stages_of_an_empty_table(spark, sf_dir):
    rows = empty(spark)
    for _, stage in cp.STAGES:
        assert stage(spark, rows, sf_dir).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables aren't here")
def test_stages_one_after_another_are_the_run(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in cp.STAGES:
        rows = stage(spark, rows, SF)
    once = sorted((r.doc_id, bytes(r.ids)) for r in rows.collect())
    assert sorted((r.doc_id, bytes(r.ids)) for r in cp.run(spark, SF).collect()) == once and len(once) > 50
