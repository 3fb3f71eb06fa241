import hashlib
import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from termweave.llm import audit, naming
from termweave.llm.queries import oracle_sql, queries

from ..oracle import connect, rows, twin
from .helpers import DOCS, docs, empty
from .test_vectors_and_chat import SF


def brute_copies(table):
    groups = {}
    for i, t in table:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for t, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        keep = known[0] if known else None
        sha = hashlib.sha256(t.encode()).hexdigest()
        left = 1
        for i in sorted(ids, key=lambda i: (i is None, i)):
            out.append((i, keep, len(ids), left == 1, sha))
            left = 0
    return sorted(out, key=str)


def found_copies(df, **more):
    return sorted((tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in naming.dedup(df, **more).collect()), key=str)


AWKWARD = [(1, None), (2, ""), (3, " "), (4, "\t\n \r"), (5, "a b"), (6, "a\x0b\x0cb"), (7, " a b"), (8, "a b "), (9, "a b"), (9, "a b"), (9, "a b"), (None, "a b"), (None, "lone"), (None, "lone"), (0, "é" * 3000 + "x"), (-1, "é" * 3000 + "y"), (11, "é" * 3000 + "x"), (12, "z" * 70_000), (13, "z" * 70_001), (14, "z" * 70_000)]


@pytest.mark.parametrize("block", [3, 4096])
def test_copies_are_those_of_equal_texts(spark, monkeypatch, block):
    monkeypatch.setattr(naming, "BLOCK_BYTES", block)
    rng = random.Random(block)
    table = AWKWARD[: 14 if block == 3 else None] + [(100 + i, "".join(rng.choice("ab \té") for _ in range(rng.choice([0, 1, 3, 8, 9, 40])))) for i in range(300)]
    table += [(1000 + i, "copied " * 5) for i in range(200)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in table], DOCS).withColumns({"row": F.lit(1), "name": F.lit("x"), "blocks": F.lit(2), "a": F.lit(3), "content": F.lit("c"), "keep_id": F.lit(5)}).repartition(5)
    assert found_copies(df) == brute_copies(table)


def test_clashing_fingerprints_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(naming, "BLOCK_BYTES", 4)
    weak = lambda c: [F.pmod(F.xxhash64(c), F.lit(2)).alias("a"), F.lit(0).cast("long").alias("b")]
    table = AWKWARD[:14] + [(i + 20, f"{i % 7:05d}{i % 3:05d}") for i in range(60)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in table], DOCS)
    assert naming.clashes(df.select(F.col("text").cast("binary").alias("content")), weak) is not None
    assert found_copies(df, fingerprints=weak) == brute_copies(table)


def test_no_documents_no_copies(spark):
    assert naming.dedup(empty(spark)).count() == 0


def test_copies_need_no_python(spark):
    plan = naming.dedup(docs(spark, ["a", "b", "a"]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|MapPartitions|SerializeFromObject", plan)


def brute_audit(table, marks):
    """Removes documents filter by filter, order by order."""
    plain = [(i, s or "", t or "") for i, s, t in table]
    failed = []
    for i, s, t in plain:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        smaller = any(j is not None and i is not None and j < i and u == t for j, _, u in plain)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": smaller}
        failed.append((s, {k for k, v in fails.items() if v}, any(m[0] == i and m[1] == 1 for m in marks if i is not None), any(m[0] == i and m[2] == 1 for m in marks if i is not None)))
    out, total = {}, {}
    for part in {s for s, *_ in failed}:
        own = [f for f in failed if f[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                gone = [f for f in left if x in f[1]]
                left = [f for f in left if x not in f[1]]
                out[part, order, step] = [len(left), len(gone), sum(x in f[1] for f in own) - len(gone), sum(f[1] == {x} for f in own), sum(f[2] for f in gone), sum(f[3] for f in gone)]
                total[part, x] = total.get((part, x), 0) + len(gone)
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found_audit(df, labels):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in audit.audit(df, labels).collect()}


def test_audit_equals_filtering_in_each_order(spark, monkeypatch):
    monkeypatch.setattr(audit, "TOGETHER", 2)
    rng = random.Random(3)
    texts = [None, "", "a" * 10, "A b", "x#y", " ".join(f"w{i}" for i in range(200)), " ".join(f"w{i}" for i in range(199)), " ".join(f"w{i % 99}" for i in range(200)), " ".join(f"W{i % 100}" for i in range(200)), " ".join(f"é{i}\x0b" for i in range(200)) + "|"]
    table = [(rng.choice([None, *range(60)]), rng.choice([None, "", "s", "t", "u"]), rng.choice(texts)) for _ in range(150)]
    marks = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(40)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1)]
    df = spark.createDataFrame([(i, t, "en", s, 0) for i, s, t in table], DOCS).withColumns({"part": F.lit("q"), "pattern": F.lit(1), "content": F.lit("c"), "of": F.lit(1), "quality": F.lit(7)}).repartition(4)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int").withColumn("source", F.lit("x"))
    assert found_audit(df, labels) == brute_audit(table, marks)
    assert {k: v[4:6] for k, v in found_audit(df, labels.where("false")).items()} == {k: (0, 0) for k in brute_audit(table, marks)}
    assert audit.audit(empty(spark), labels).count() == 0


def test_contractions_are_sums_over_selected_entries():
    tensor = np.random.default_rng(0).integers(0, 9, (1, 2, 2, 2, 2, 2))
    kept, removed, _, which = audit.selections()
    assert audit.contract(tensor, kept)[0, 0] == tensor[0, 0].sum()
    assert (audit.contract(tensor, kept) + audit.contract(tensor, removed))[0, 1] == tensor[0, 0].sum() and which[:5] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op12_filter_audit"])
def test_same_as_duckdb(spark, name):
    assert rows(queries()[name](spark, SF)) == twin(connect(SF), oracle_sql()[name])
