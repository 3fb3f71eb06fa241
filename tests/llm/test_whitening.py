import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termweave.llm import whitening as wh
from termweave.llm.queries import queries

from .test_vectors_and_chat import SF


def spread(d, q, z):
    """How far an update is from a dense decomposition, and from orthogonal vectors."""
    want = (q * d) @ q.T + np.outer(z, z)
    d2, q2 = wh.rank_one(d, q.copy(), z)
    scale = max(np.abs(want).max(), 1e-300)
    assert (np.diff(d2) >= 0).all()
    return np.abs((q2 * d2) @ q2.T - want).max() / scale, np.abs(q2.T @ q2 - np.eye(len(d))).max()


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 12), st.integers(0, 2**32 - 1), st.sampled_from(["plain", "ties", "sparse", "zero", "graded", "close"]))
def test_rank_one_updates(n, seed, kind):
    rng = np.random.default_rng(seed)
    d = np.sort(rng.random(n)) * {"graded": 1e6}.get(kind, 1)
    if kind == "ties":
        d = np.sort(rng.integers(0, 3, n).astype(float))
    if kind == "zero":
        d = np.zeros(n)
    if kind == "graded":
        d = np.sort(10.0 ** rng.uniform(-9, 6, n))
    if kind == "close":
        d = np.sort(1 + rng.integers(0, 4, n) * 1e-13)
    z = rng.normal(size=n) * 10.0 ** rng.integers(-6, 4)
    if kind == "sparse":
        z[rng.random(n) < 0.6] = 0
    q = np.linalg.qr(rng.normal(size=(n, n)))[0]
    off, bent = spread(d, q, q @ z)
    assert off < 1e-12 and bent < 1e-12


def test_updates_row_by_row_equal_those_of_the_triangular_factor():
    rows = np.random.default_rng(1).normal(size=(300, 9)) * np.arange(1, 10)
    one = wh.nothing(9)
    for z in rows:
        one = wh.rank_one(*one, z)
    assert one[0] == pytest.approx(np.linalg.eigvalsh(rows.T @ rows), rel=1e-11)
    assert wh.with_rows(wh.nothing(9), rows)[0] == pytest.approx(one[0], rel=1e-11)


def brute(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64).astype(object) + 100000
    n, sums = len(x), x.sum(0)
    scaled = x * n - sums
    z = (scaled / n).astype(float)
    v = z.T @ z / n
    e, q = np.linalg.eigh(v)
    return n, [int(s) for s in (scaled * scaled).sum(1)], z, e[::-1][:k], q[:, ::-1][:, :k], np.trace(v)


def held(spark, table, vectors, df=None):
    df = df if df is not None else spark.createDataFrame(table, "vec_id long, embedding array<double>")
    found = wh.whiten(df).collect()
    n, deviations, z, e, q, trace = brute(vectors)
    k = len(e)
    assert len(found) == n * k and {r.n for r in found} == {n} and {r.component for r in found} == set(range(1, k + 1))
    assert sorted(r.deviation for r in found if r.component == 1) == sorted(deviations)
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9
    for r in found:
        assert r.explained == pytest.approx(e[r.component - 1] / trace, rel=1e-9)
    return found, z, e, q


def test_whitening_equals_a_dense_decomposition(spark, monkeypatch):
    monkeypatch.setattr(wh, "BLOCK_ROWS", 50)
    monkeypatch.setattr(wh, "FAN_IN", 2)
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(900, 20)) @ np.diag(np.linspace(0.1, 3, 20)) @ np.linalg.qr(rng.normal(size=(20, 20)))[0] + 7
    vectors[100:400] = vectors[3]
    table = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>").withColumns({"vector": F.lit("x"), "component": F.lit(1), "n": F.lit(2)}).repartition(7)
    found, z, e, q = held(spark, table, vectors, df)
    want = z @ q / np.sqrt(e)
    got = np.zeros_like(want)
    for r in found:
        got[r.vec_id, r.component - 1] = r.whitened
    assert np.abs(np.abs(got) - np.abs(want)).max() < 1e-9
    assert np.abs(got - want * np.sign((got * want).sum(0))).max() < 1e-9  # one sign for all rows


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    fine = [[1.0, 2.0], [1.5, -2.0], [0.0, 0.0], [0.0, 0.0], [3.25, 1e-9]]
    bad = [None, [], [nan, 1.0], [inf, 1.0], [None, 1.0], [1e300, 1.0], [1.0, 2.0, 3.0]]
    table = [(i % 4, v) for i, v in enumerate(fine)] + [(50, v) for v in bad]
    table[1] = (None, table[1][1])
    found, *_ = held(spark, table, fine)
    assert sorted((r.vec_id for r in found if r.component == 1), key=str) == [0, 0, 2, 3, None]
    big = spark.createDataFrame([(1, [2.0**37, 1.0]), (2, [-(2.0**37), 2.0])], "vec_id long, embedding array<double>")
    assert {r.deviation for r in wh.whiten(big).collect()} == {None}
    same = spark.createDataFrame([(1, [1.0, 2.0, 3.0])] * 3, "vec_id long, embedding array<float>")
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in wh.whiten(same).collect()} == {(3, 0, 0.0, 0.0, 0.0)}
    flat = wh.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(9)], "vec_id long, embedding array<double>")).collect()
    assert len(flat) == 27 and {r.whitened for r in flat if r.component > 1} == {0.0} and flat[0].identity_error < 1e-9
    assert wh.whiten(same.where("false")).count() == 0


def test_equal_eigenvalues_share_their_space(spark):
    vectors = [[s if j == i else 0.0 for j in range(10)] for i in range(10) for s in (1.0, -1.0)]
    n, _, z, e, q, trace = brute(vectors)
    found, *_ = held(spark, list(enumerate(vectors)), vectors)
    assert len(found) == 160


@pytest.mark.parametrize("name", ["op13_embedding_whitening"])
def test_given_vectors(spark, name):
    vectors = [r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    found = queries()[name](spark, SF).collect()
    n, deviations, z, e, q, trace = brute(vectors)
    assert len(found) == 8 * n and sorted(r.deviation for r in found if r.component == 1) == sorted(deviations)
    assert max(abs(r.explained / (e[r.component - 1] / trace) - 1) for r in found) < 1e-9 and found[0].identity_error < 1e-9
