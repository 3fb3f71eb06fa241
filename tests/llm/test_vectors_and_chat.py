import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from termweave.llm import chat, hnsw
from termweave.llm.queries import oracle_sql

from ..oracle import connect, rows, twin

SF = "/root/testdata/sf0.001"


def brute(ids, x, queries, k=10):
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[ids.index(q)]) ** 2).sum(1))
        out[q] = [(ids[j], float(d[j])) for j in np.lexsort((ids, d)) if ids[j] != q][:k]
    return out


def test_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_POINTS", 300)
    rng = np.random.default_rng(0)
    x = (rng.normal(size=(20, 24))[rng.integers(0, 20, 1500)] + rng.normal(size=(1500, 24)) * 0.5).astype(np.float32)
    x[100:500] = x[7]  # one vector that many rows share
    ids = [i * 3 for i in range(1500)]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>").repartition(4)
    found = hnsw.nearest(table, table.where("vec_id % 60 = 0")).collect()
    want = brute(ids, x.astype(float), [i for i in ids if i % 60 == 0])
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
    assert hits / (10 * len(want)) >= 0.95
    for q, near in got.items():
        assert near == sorted(near, key=lambda p: (p[1], p[0]))
        for i, score in near:
            assert score == pytest.approx(float(np.sqrt(((x[ids.index(i)].astype(float) - x[ids.index(q)].astype(float)) ** 2).sum())), abs=1e-12)
    assert [i for i, _ in got[300]] == [i for i, _ in want[300]]  # ties go to the smaller id


def clusters(rng, n, d, spread):
    return rng.normal(size=(3, d))[rng.integers(0, 3, n)] * 1e3 + spread * rng.normal(size=(n, d))


SCALES = {
    "offset 1e4": lambda rng: rng.normal(size=(900, 16)) + 1e4,
    "offset 1e8": lambda rng: rng.normal(size=(900, 16)) + 1e8,
    "scale 1e-25": lambda rng: rng.normal(size=(900, 16)) * 1e-25,
    "scale 1e25": lambda rng: rng.normal(size=(900, 16)) * 1e25,
    "scale 1e200": lambda rng: rng.normal(size=(900, 16)) * 1e200,
    "mixed magnitudes": lambda rng: rng.normal(size=(900, 16)) * 10.0 ** rng.integers(-12, 13, (900, 1)),
    "tight clusters far from the origin": lambda rng: clusters(rng, 900, 16, 1e-4) + 1e5,
}


@pytest.mark.parametrize("kind", SCALES)
def test_recall_at_any_scale(spark, monkeypatch, kind):
    monkeypatch.setattr(hnsw, "SHARD_POINTS", 400)
    x = SCALES[kind](np.random.default_rng(2))
    ids = list(range(len(x)))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    small = np.ldexp(x, -hnsw.exponent(x))
    want = brute(ids, small, [i for i in ids if i % 20 == 0])
    got = {}
    for r in hnsw.nearest(table, table.where("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())  # no row is missing
    assert sum(len(got[q] & {i for i, _ in want[q]}) for q in want) / (10 * len(want)) >= 0.95


def test_scores_are_plain_distances_where_these_fit():
    rng = np.random.default_rng(6)
    x, q = rng.normal(size=(50, 16)) + 3, rng.normal(size=16)
    assert (hnsw.exact(x, q) == np.sqrt(((x - q) ** 2).sum(1))).all()
    assert hnsw.exact(np.array([[3e200, 4e200], [1.0, 1.0], [1e-200, 0.0]]), np.zeros(2)).tolist() == [pytest.approx(5e200), np.sqrt(2), 1e-200]


def test_repeated_ids_count_by_their_least_vector(spark):
    rows_ = [(0, [5.0, 0.0]), (0, [1.0, 0.0]), (0, [1.0, 0.5]), (1, [0.0, 2.0]), (1, [9.0, 9.0]), (1, [None, 0.0])]
    for order in (rows_, rows_[::-1]):
        table = spark.createDataFrame(order, "vec_id long, embedding array<double>").repartition(3)
        assert {(r.query_id, r.vec_id, r.score) for r in hnsw.nearest(table, table).collect()} == {(0, 1, 5**0.5), (1, 0, 5**0.5)}


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows_ = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, []), (None, [1.0, 1.0]), (7, [1.0, 0.5]), (7, [1.0, 0.5]), (8, [None, 1.0]), (9, [1.0, 2.0, 3.0])]
    table = spark.createDataFrame(rows_, "vec_id long, embedding array<double>").withColumn("shard", F.lit("x")).withColumn("rank", F.lit(1))
    found = sorted((r.query_id, r["rank"], r.vec_id) for r in hnsw.nearest(table, table).collect())
    assert found == [(0, 1, 7), (0, 2, 1), (1, 1, 7), (1, 2, 0), (7, 1, 0), (7, 2, 1)]
    assert hnsw.nearest(table.where("false"), table).count() == 0 == hnsw.nearest(table, table.where("false")).count()


@pytest.mark.parametrize("size", [2, 1024])
def test_perspectives(spark, monkeypatch, size):
    monkeypatch.setattr(chat, "PART_MESSAGES", size)
    turns = [(1, 0, "ann", "hi é"), (1, 1, "bob", "yo"), (1, 64, "ann", "later"), (2, None, None, None), (2, 0, "x", ""), (None, 0, "x", "lone"), (1, 1, "bob", "yo"), *[(3, None, "a", None)] * 5]
    turns += [(4, i, "ann" if i % 2 else "bob", f"message {i}") for i in range(300)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("x")).withColumn("speaker", F.lit("x")).repartition(3)
    found = {(r.conv_id, r.speaker, r.part): r for r in chat.rotate(df).collect()}
    want = {}
    for c in {t[0] for t in turns}:
        said = sorted(((n is not None, n or 0, who or "unknown", t or "") for i, n, who, t in turns if i == c))
        for speaker in {x[2] for x in said}:
            for part in range(0, len(said), size):
                whole, mask, own = "", [], 0
                for _, _, who, t in said[part : part + size]:
                    whole += chat.ASSISTANT_OPEN if who == speaker else chat.USER_OPEN + who + chat.USER_NAMED
                    if who == speaker:
                        mask.append(f"{len(whole)}:{len(whole) + len(t)}")
                    whole += t + chat.CLOSE
                want[c, speaker, part // size] = (len(said[part : part + size]), len(mask), whole, ",".join(mask))
    assert {k: (r.n_turns, r.n_own, r.rendered, r.mask) for k, r in found.items()} == want
    assert chat.rotate(df.where("false")).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables aren't here")
def test_chat_same_as_duckdb(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    assert rows(chat.rotate(table)) == twin(connect(SF), oracle_sql()["op6_chat_formatting"])
