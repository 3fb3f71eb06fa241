"""Exact deduplication by deterministic block naming (operator 11).

A text's UTF-8 bytes are cut into blocks of a fixed size. The distinct blocks are
sorted, by fingerprint and then by content, and numbered; a block's number is its
name. Then adjacent names of a text are paired, the distinct pairs are sorted and
numbered in turn, and so on, until each text has one name. Two texts are equal
exactly if they have the same number of blocks and the same last name.

Names carry no chance of a collision: before a fingerprint stands for a block, all
blocks of that fingerprint are compared, and different ones are told apart by a
further number. Only names travel from there on, so a text is shuffled once. All
of it is built-in column functions, so no row leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import clear, mark, written

#: Bytes of a block.
BLOCK_BYTES = 4096
#: Groups in which distinct blocks or pairs are sorted and numbered, each in one task.
BUCKETS = 65_536


def fingerprint(content: Column) -> list[Column]:
    """128 bits of a block, as two columns."""
    return [F.xxhash64(content).alias("a"), F.xxhash64(F.lit(1), content).alias("b")]


def clashes(contents: DataFrame, fingerprints: Callable[[Column], list[Column]] = fingerprint) -> DataFrame | None:
    """a, b, content, turn of different contents that share a fingerprint, numbered from 1; None if no two do, as is to be expected.

    contents(content) may repeat; equal ones are joined before they are shuffled.
    """
    once = contents.select(*fingerprints(F.col("content")), "content").distinct()
    several = written(once.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select("a", "b"))
    if several.isEmpty():
        return None
    return written(once.join(several, ["a", "b"], "left_semi").withColumn("turn", F.row_number().over(Window.partitionBy("a", "b").orderBy("content"))))


def keyed(df: DataFrame, shared: DataFrame | None, fingerprints: Callable[[Column], list[Column]] = fingerprint) -> DataFrame:
    """df(content, ...) with a, b and turn in place of content: equal exactly where the contents are. shared: the clashes of all contents."""
    rows = df.withColumns(dict(zip(("a", "b"), fingerprints(F.col("content")))))
    if shared is None:
        return rows.withColumn("turn", F.lit(0)).drop("content")
    return rows.join(shared, ["a", "b", "content"], "left").fillna(0, ["turn"]).drop("content")


def numbered(df: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct values of some columns with a whole number of their own, `name`: their place among the sorted ones of a bucket, and the bucket."""
    bucket = F.pmod(F.xxhash64(*columns), F.lit(BUCKETS))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(*columns)).cast("long") - 1
    return df.select(*columns).distinct().withColumn("bucket", bucket).select(*columns, (place * BUCKETS + F.col("bucket")).alias("name"))


def collapsed(text: Column) -> Column:
    """Each run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def identities(rows: DataFrame, fingerprints: Callable[[Column], list[Column]] = fingerprint) -> DataFrame:
    """The other columns of rows(text, ...) with `row` (distinct), `blocks` and `name`: texts are equal exactly if both are.

    Null texts are equal to each other only. Levels of naming are as many as the
    longest text needs; each halves what the one before it shuffled.
    """
    since = mark()
    others = [c for c in rows.columns if c != "text"]
    raw = F.col("text").cast("binary")
    cut = lambda i: F.substring(raw, i * BLOCK_BYTES + 1, F.lit(BLOCK_BYTES))
    size = F.greatest(F.ceil(F.octet_length("text") / BLOCK_BYTES).cast("int"), F.lit(1))
    pieces = F.transform(F.sequence(F.lit(0), size - 1), cut)
    shared = clashes(rows.select(F.explode(pieces).alias("content")), fingerprints)
    # what else a row holds stands by its first block
    own = rows.select("text", F.monotonically_increasing_id().alias("row"), size.alias("blocks"), F.struct(*others).alias("own"))
    exploded = own.select("row", "blocks", "own", F.posexplode(pieces).alias("place", "content"))
    parts = written(keyed(exploded.withColumn("own", F.when(F.col("place") == 0, F.col("own"))), shared, fingerprints))
    levels = (parts.agg(F.max("blocks")).first()[0] or 1) - 1
    named = written(parts.join(numbered(parts, ["a", "b", "turn"]), ["a", "b", "turn"]).select("row", "blocks", "place", "name"))
    found = [named.where("blocks = 1")]
    for level in range(levels.bit_length()):
        half = lambda side: F.max(F.when(F.col("place") % 2 == side, F.col("name")))
        pairs = named.where(F.col("blocks") > 1 << level).groupBy("row", "blocks", F.floor(F.col("place") / 2).alias("place")).agg(half(0).alias("left"), F.coalesce(half(1), F.lit(-1)).alias("right"))
        named = written(pairs.join(numbered(pairs, ["left", "right"]), ["left", "right"]).select("row", "blocks", "place", "name"))
        found.append(named.where(F.col("blocks") <= 2 << level))
    last = reduce(DataFrame.union, (f.select("row", "name") for f in found))
    out = written(parts.where("place = 0").select("row", "blocks", "own.*").join(last, "row"))
    clear(rows.sparkSession, since, keep=out)
    return out


def dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", fingerprints: Callable[[Column], list[Column]] = fingerprint) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of docs.

    Texts are equal when identical after each run of white space became one space,
    also at their ends; a null text is empty, and equal to other empty ones. Of
    equal texts the row of the smallest id stays, exactly one: of several rows of
    that id any one, as they don't differ here. Rows without an id stay only where
    no equal text has one; keep_id is null then. An empty table gives no rows. Other
    columns are not read.
    """
    normal = collapsed(docs[text])
    rows = identities(docs.select(docs[key].alias("doc_id"), F.sha2(normal.cast("binary"), 256).alias("text_sha256"), normal.alias("text")), fingerprints)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    # written, so that the join deals both sides anew and a hot group's rows can be split
    groups = written(rows.groupBy("blocks", "name").agg(first, F.count("*").alias("group_size")))
    found = rows.join(groups, ["blocks", "name"])
    return found.select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256")


#: The same on table documents, in DuckDB SQL.
SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t)"""
