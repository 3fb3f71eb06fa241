"""Filter interaction audit by contractions of contingency tensors (operator 12).

Spark counts, for each part of the corpus, the documents of each of the 32 ways to
pass and fail five filters. A part's counts are reshaped to 2x2x2x2x2, an axis a
filter, and each step of each order of the filters is one contraction: along an
axis it takes those that pass, those that fail, or all.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .naming import clashes, keyed
from .tables import clear, mark, written

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: What is counted of a part: documents, those of quality 1, toxic ones.
COUNTED = ["n", "good", "toxic"]
#: Parts contracted together.
TOGETHER = 64
_PASS, _FAIL, _ALL = (1, 0), (0, 1), (1, 1)


def own_failures(text: Column) -> dict[str, Column]:
    """The failure conditions of A to D, of a text alone."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {"A": n < 200, "B": 100 * distinct < 50 * n, "C": 100 * capitals > 2 * F.length(text), "D": text.rlike(r"[#$%&*|]")}


def failures(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """doc_id, part and pattern (bit i: filter i of ABCDE fails) of every row of docs.

    E compares whole texts of all rows: they are told apart by fingerprints that
    were proved against the texts, so that each text is shuffled once.
    """
    since = mark()
    whole = F.coalesce(docs[text], F.lit(""))
    bits = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(own_failures(whole).values())), F.lit(0))
    rows = docs.select(docs[key].alias("doc_id"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"), bits.alias("bits"), whole.cast("binary").alias("content"))
    shared = clashes(docs.select(whole.cast("binary").alias("content")))
    rows = written(keyed(rows, shared))
    first = written(rows.groupBy("a", "b", "turn").agg(F.min("doc_id").alias("first")))  # written, so that a hot text's rows can be split
    again = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    out = written(rows.join(first, ["a", "b", "turn"]).select("doc_id", "part", (F.col("bits") + F.when(again, 16).otherwise(0)).alias("pattern")))
    clear(docs.sparkSession, since, keep=out)
    return out


def selections() -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """For each order and step: which entries of each axis are kept, removed and failed by that filter alone, and the filter's number."""
    kept, removed, alone, which = [], [], [], []
    for order in ORDERS:
        for step, letter in enumerate(order):
            before = [FILTERS.index(x) for x in order[:step]]
            own = FILTERS.index(letter)
            take = lambda mine, rest: [mine if i == own else _PASS if i in before else rest for i in range(5)]  # noqa: E731, B023
            kept.append(take(_PASS, _ALL))
            removed.append(take(_FAIL, _ALL))
            alone.append(take(_FAIL, _PASS))
            which.append(own)
    return np.array(kept), np.array(removed), np.array(alone), which


def contract(tensors: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Sums of tensors[p, 2, 2, 2, 2, 2] over the entries that each selection takes: [p, selection]."""
    return np.einsum("pabcde,sa,sb,sc,sd,se->ps", tensors, *chosen.transpose(1, 0, 2), optimize=True)


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """part, filter_order, step and the counts of each step of all 120 orders, for every part.

    A null text is empty, a null part the empty string. A row without an id has no
    smaller one, nor is one smaller than another's. Rows that repeat an id are
    documents of their own. A document is good (toxic) if any label of its id says
    1. Empty documents give no rows; without labels nothing good or toxic is lost.
    """
    said = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c)
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("of")).agg(said("quality"), said("toxic"))
    rows = failures(docs, key, text, part)
    rows = rows.join(marks, rows.doc_id == marks.of, "left")
    counts = rows.groupBy("part", "pattern").agg(F.count("*").alias("n"), F.coalesce(F.sum("quality"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("pattern", *COUNTED)).alias("cells"))  # 32 at most
    schema = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, removed, alone, which = selections()
        names = [x.split()[0] for x in schema.split(", ")]
        steps = len(which)
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                some = batch.slice(at, TOGETHER)
                p = some.num_rows
                flat = np.zeros((p, 3, 32), np.int64)
                cells = some.column(1)
                of = np.repeat(np.arange(p), np.diff(cells.offsets.to_numpy()))
                inner = cells.flatten()
                for i, name in enumerate(COUNTED):
                    flat[of, i, inner.field("pattern").to_numpy()] = inner.field(name).to_numpy()
                # bit i is filter i, so the last axis of the reshaped counts is the first filter
                tensors = flat.reshape(p, 3, 2, 2, 2, 2, 2).transpose(0, 1, 6, 5, 4, 3, 2)
                all_of, good, toxic = (tensors[:, i] for i in range(3))
                fails = contract(all_of, np.array([[_FAIL if j == i else _ALL for j in range(5)] for i in range(5)]))[:, which]
                lost = contract(all_of, removed)
                shapley = np.stack([lost[:, np.array(which) == i].sum(1) for i in range(5)], 1)[:, which]
                counted = [contract(all_of, kept), lost, fails - lost, contract(all_of, alone), contract(good, removed), contract(toxic, removed), shapley]
                columns = [
                    some.column(0).take(pa.array(np.repeat(np.arange(p), steps))), pa.array([o for o in ORDERS for _ in FILTERS] * p), pa.array(np.tile(np.arange(1, 6), p * len(ORDERS)).astype(np.int32)),
                    *(pa.array(c.reshape(-1)) for c in counted),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return parts.mapInArrow(run, schema)


#: The same on tables documents and labels, in DuckDB SQL.
SQL = r"""
WITH plain AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
worded AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM plain),
marks AS (SELECT doc_id AS l, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
flags AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS failed FROM worded LEFT JOIN marks ON doc_id = l),
cells AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM flags GROUP BY 1, 2),
f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, CAST(k AS INTEGER) AS step, substr(filter_order, k, 1) AS own, substr(filter_order, 1, k - 1) AS before FROM orders, range(1, 6) r(k)),
found AS (SELECT part, filter_order, step, own,
    sum(CASE WHEN NOT contains(failed, own) AND (before = '' OR NOT regexp_matches(failed, '[' || before || '!]')) THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN contains(failed, own) AND (before = '' OR NOT regexp_matches(failed, '[' || before || '!]')) THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(failed, own) AND before <> '' AND regexp_matches(failed, '[' || before || '!]') THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN failed = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(failed, own) AND (before = '' OR NOT regexp_matches(failed, '[' || before || '!]')) THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(failed, own) AND (before = '' OR NOT regexp_matches(failed, '[' || before || '!]')) THEN toxic ELSE 0 END) AS toxic_lost
    FROM cells, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM found"""
