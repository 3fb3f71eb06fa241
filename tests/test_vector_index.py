import os
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from termweave.operators import semantic
from termweave.operators import vector_index as vi
from termweave.plans.derive import Given
from termweave.queries.retrieval import vectors as given_vectors

SF = "/root/testdata/sf0.1"


def table(spark, x, key="concept_id", **more):
    rows = [(i, v.tolist(), *(c[i] for c in more.values())) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, f"{key} long, embedding array<double>" + "".join(f", {c} string" for c in more))


def listed(df):
    return sorted((r.query_id, r["rank"], r.concept_id, r.similarity) for r in df.collect())


def recall(found, exact):
    own = {}
    for r in found.collect():
        own.setdefault(r.query_id, set()).add(r.concept_id)
    want = {}
    for r in exact.collect():
        want.setdefault(r.query_id, set()).add(r.concept_id)
    return sum(len(own.get(q, set()) & near) for q, near in want.items()) / sum(map(len, want.values()))


@pytest.fixture(scope="module")
def clouds():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(25, 30))[rng.integers(0, 25, 3000)] + 0.35 * rng.normal(size=(3000, 30))
    x[500:1500] = x[4]  # one vector that a third of all rows share
    return x


def test_recall_with_a_fifth_of_the_rows(spark, clouds):
    index = table(spark, clouds)
    asked = index.where("concept_id % 20 = 0").withColumnRenamed("concept_id", "query_id")
    built = vi.build_index(index)
    assert built.shards.agg(F.sum("n")).first()[0] == len(clouds)
    exact = semantic.cosine_topk(asked, index, 10, own=False)
    spread = asked.where("query_id < 500 or query_id >= 1500")  # a copy's ties are cut by id
    assert recall(vi.search(spread, built, 10, own=False), exact.join(spread.select("query_id"), "query_id", "left_semi")) >= 0.9
    assert recall(vi.search(asked, built, 10, own=False), exact) >= 0.9
    rated = vi.search(spread, built, 10, own=False, counted=True).agg(F.max("n_rated"), F.avg("n_rated")).first()
    assert rated[1] < 0.2 * len(clouds)


@pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables aren't here")
def test_recall_on_the_given_vectors(spark):
    asked, index = given_vectors(Given(spark, SF))
    built = vi.build_index(index)
    assert recall(vi.search(asked, built, 10, own=False), semantic.cosine_topk(asked, index, 10, own=False)) >= 0.9
    took = vi.search(asked, built, 10, counted=True).agg(F.avg("n_rated"), F.max("n_measured")).first()
    print(f"{took[0]} rows rated by codes, {took[1]} measured of {index.count()}")  # these vectors lie evenly in all directions: most cells must be visited
    assert took[1] < 0.2 * index.count()


def test_every_cell_is_exact_and_filters_hold(spark, clouds, monkeypatch):
    monkeypatch.setattr(vi, "SHARD_BYTES", 8 * 30 * 64)  # shards of 64 rows
    monkeypatch.setattr(vi, "QUERY_BLOCK", 16)
    index = table(spark, clouds, domain_id=["a" if i % 3 else "b" for i in range(3000)])
    asked = index.where("concept_id % 50 = 0").select(F.col("concept_id").alias("query_id"), "embedding")
    built = vi.build_index(index, keep=("domain_id",))
    cells = len(built.model.centroids)
    assert listed(vi.search(asked, built, 7, probes=cells, refine=None)) == listed(semantic.cosine_topk(asked, index, 7))
    assert listed(vi.search(asked, built, 7, probes=cells, refine=None, own=False, domain_id="b")) == listed(semantic.cosine_topk(asked, index, 7, own=False, domain_id="b"))
    with pytest.raises(ValueError, match="keeps"):
        vi.search(asked, built, 7, label=1)
    assert built.shards.agg(F.max("n")).first()[0] <= 64  # no shard holds a cell of many copies whole


def test_only_visited_shards_are_met(spark, clouds, monkeypatch):
    monkeypatch.setattr(vi, "SHARD_BYTES", 8 * 30 * 20)  # shards of 20 rows
    index = table(spark, clouds)
    asked = index.where("concept_id = 77").withColumnRenamed("concept_id", "query_id")
    built = vi.build_index(index)
    met = vi._asked(asked, built, 4).count()
    assert 1 <= met < 0.5 * built.shards.count()
    assert vi.search(asked, built, 10, probes=4).count() == 10


def test_written_and_read(spark, clouds, tmp_path):
    index = table(spark, clouds[:300], label=[str(i % 4) for i in range(300)])
    asked = index.where("concept_id % 20 = 0").select(F.col("concept_id").alias("query_id"), "embedding")
    built = vi.build_index(index, keep=("label",))
    built.write(f"file://{tmp_path}/index")
    again = vi.VectorIndex.read(spark, f"file://{tmp_path}/index")
    assert listed(vi.search(asked, again, 5, label=2)) == listed(vi.search(asked, built, 5, label="2"))


def test_unusable_rows_take_no_part(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [nan, 1.0]), (5, [None, 1.0]), (6, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (7, []), (8, [0.0, 0.0]), (9, [1.0, 0.1])]
    index = spark.createDataFrame(rows, "concept_id long, embedding array<double>")
    asked = index.withColumnRenamed("concept_id", "query_id")
    built = vi.build_index(index)
    found = vi.search(asked, built, 10, own=False, probes=99, refine=None)
    assert {r.query_id for r in found.collect()} == {1, 2, 8, 9} and found.count() == 12
    assert vi.build_index(index.where("false")) is None and semantic.approx_topk(asked, index.where("false")).count() == 0
    assert vi.search(asked.where("false"), built).count() == 0


def test_codes_rate_near_rows_first():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 9))
    model = vi.Model(9, np.zeros((1, 9)), np.zeros((3, 1, 4)), 1)
    parts = model.padded(x).reshape(400, 3, 4)
    model.slices = np.stack([vi.k_means(parts[:, s], 64, rng) for s in range(3)])
    rated = model.ratings(x[:20], model.codes(x))
    exact = ((x[:20, None] - x[None]) ** 2).sum(2)
    near = [len(set(np.argsort(r)[:20]) & set(np.argsort(e)[:5])) / 5 for r, e in zip(rated, exact)]
    assert np.mean(near) > 0.9


def peak_mb(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_memory_of_a_task_is_bounded():
    rng = np.random.default_rng(5)
    x, centroids = rng.normal(size=(8000, 4)), rng.normal(size=(3000, 4))
    model = vi.Model(4, centroids, rng.normal(size=(1, 256, 4)), 3000)
    assert peak_mb(lambda: model.cells(x, 1)) < 100 and peak_mb(lambda: vi.nearest(x, centroids)) < 100  # 8000 x 3000 doubles are 192 MB
    model.cells(x[:100], 3000)
    assert peak_mb(lambda: vi._probes(model, x, vi.nearest(x, centroids))) < 100


def test_nearest_rows_are_those_of_a_full_sort(monkeypatch):
    rng = np.random.default_rng(6)
    near = np.round(rng.uniform(-1, 1, size=(30, 200)), 1)  # many ties
    near[3, 5], near[4] = np.nan, np.nan
    real = rng.random((30, 200)) < 0.7
    keys = rng.permutation(200) * 7 - 500
    keys[:4] = keys[4:8]
    for width in (1, 9, 200, 300):
        for names in (keys, np.broadcast_to(keys, near.shape)):
            at, best = vi.nearest_rows(near, names, real, width)
            for q in range(30):
                want = sorted((-near[q, c], keys[c]) for c in range(200) if real[q, c] and not np.isnan(near[q, c]))[:width]
                got = [(-s, keys[c]) for s, c in zip(best[q], at[q]) if s > -np.inf]
                assert np.allclose(got, want) if want else not got


def test_lists_search_once(spark, monkeypatch):
    from termweave.queries import retrieval

    class Spread(Given):
        def read(self, name):
            rows = spark.range(60).select(F.col("id").alias("vec_id"), F.array(F.sin("id"), F.cos("id")).alias("embedding"), F.lit(1).alias("label"))
            return rows if name == "embeddings" else super().read(name)

    plan = retrieval.lists(Spread(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan  # what was found is stored, not searched again for each list
