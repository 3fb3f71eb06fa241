import difflib
import json
from types import SimpleNamespace

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termweave.functions import text as tx
from termweave.operators import _pieces, catalogue, clinical, conceptset, governance, graph, hierarchy, intervals, mapping, picks, search, semantic, staging
from termweave.plans.derive import RELATIONSHIPS
from termweave.queries import _QUERIES
from termweave.queries.graphs import path_pairs
from termweave.sources import files, scratch

CONCEPT = "concept_id long, concept_name string, domain_id string, vocabulary_id string, concept_class_id string, concept_code string, standard_concept string, invalid_reason string"


@pytest.fixture(scope="module")
def concepts(spark):
    rows = [
        (1, "Clinical finding", "Condition", "V", "Finding", "c1", "S", None),
        (2, "Diabetes", "Condition", "V", "Finding", "c2", "S", None),
        (3, "Type 2 diabetes", "Condition", "V", "Finding", "c3", "S", None),
        (4, "Diabetic neuropathy", "Condition", "V", "Finding", "c4", "S", None),
        (5, "Old diabetes", "Condition", "W", "Finding", "E11", None, "U"),
        (6, "Loop a", "Condition", "W", "Finding", "L1", None, None),
        (7, "Loop b", "Condition", "W", "Finding", "L2", None, None),
        (8, "100% pure", "Drug", "V", "Drug", "d1", "S", None),
    ]
    return spark.createDataFrame(rows, CONCEPT)


@pytest.fixture(scope="module")
def closure(spark):
    rows = [(i, i, 0, 0) for i in (1, 2, 3, 4, 8)] + [(1, 2, 1, 1), (1, 3, 2, 2), (1, 4, 2, 3), (2, 3, 1, 1), (2, 4, 1, 2), (3, 4, 1, 1)]
    return spark.createDataFrame(rows, "ancestor_concept_id long, descendant_concept_id long, min_levels_of_separation long, max_levels_of_separation long")


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(5, 3, "Maps to"), (3, 5, "Mapped from"), (6, 7, "Maps to"), (7, 6, "Maps to"), (3, 2, "Is a"), (4, 2, "Is a"), (2, 3, "Subsumes"), (2, 4, "Subsumes"), (2, 1, "Is a")]
    return spark.createDataFrame([(*r, None) for r in rows], "concept_id_1 long, concept_id_2 long, relationship_id string, invalid_reason string")


@pytest.fixture(scope="module")
def relationship(spark):
    return spark.createDataFrame([(i, n, r, d, d) for i, n, r, d in RELATIONSHIPS], "relationship_id string, relationship_name string, reverse_relationship_id string, is_hierarchical string, defines_ancestry string")


def pairs_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_search_orders_exact_then_short(spark, concepts):
    q = spark.createDataFrame([(1, "diabetes"), (2, "nothing")], "query_id long, keyword string")
    found = search.search_concepts(concepts, q).orderBy("rank").collect()
    assert [r.concept_id for r in found] == [2, 5, 3]
    assert found[0].rank == 1


def test_many_keywords_take_the_piece_join(spark, concepts, monkeypatch):
    q = spark.createDataFrame([(1, "diabetes"), (2, "a"), (3, "%"), (4, "Type 2"), (5, "%b_t%s"), (6, "ty"), (7, "_"), (8, ""), (9, "0\\%"), (10, "İ"), (11, "a%zz")], "query_id long, keyword string")
    names = concepts.select("concept_id", F.col("concept_name").alias("text"))
    few = pairs_of(search._name_hits(names, q), "query_id", "concept_id")
    scored = lambda: pairs_of(catalogue.scored_pairs(concepts, q, "concept_name", "domain_id", "concept_code"), "query_id", "concept_id", "score")
    all_scored = scored()
    monkeypatch.setattr(_pieces, "small", lambda df, rows: False)
    assert pairs_of(search._name_hits(names, q), "query_id", "concept_id") == few and (5, 3) in few and (9, 8) in few
    assert scored() == all_scored and (6, 3, 15) in all_scored


def test_trace_mapping_ends(concepts, edges):
    found = {r.concept_id: r for r in mapping.trace_standard_mapping(concepts, edges, concepts).collect()}
    assert (found[3].target_id, found[3].hops) == (3, 0)
    assert (found[5].target_id, found[5].hops, found[5].chain) == (3, 1, [5, 3])
    assert (found[6].target_id, found[6].error) == (None, "loop")


def test_kinds_without_any_known_mean_all(relationship):
    assert mapping.relationship_ids_for_kinds(relationship, ["nonsense"]).count() == relationship.count()
    assert mapping.relationship_ids_for_kinds(relationship, ["nonsense"], empty_is_all=False).count() == 0


def test_ancestry_is_transitive(closure):
    rows = {(r[0], r[1]) for r in closure.collect()}
    assert all((a, d) in rows for a, b in rows for c, d in rows if b == c)


def test_subgraph_cap_keeps_the_edge(spark, concepts, edges):
    seeds = spark.createDataFrame([(1, 2)], "set_id long, concept_id long")
    nodes, found, flags = graph.explore_subgraph(concepts, edges, seeds, max_depth=1, max_nodes=2)
    assert pairs_of(nodes, "concept_id") == [(1,), (2,)]
    assert found.count() == 3 and flags.first().truncated


def test_paths_are_walks_and_shortest(spark, concepts, edges, relationship):
    pairs = spark.createDataFrame([(1, 4, 3), (2, 2, 2), (3, 1, 8)], "pair_id long, source long, target long")
    found = graph.find_ranked_paths(concepts, edges, relationship, pairs).collect()
    assert {r.pair_id for r in found} == {1, 2}
    steps = next(r.steps for r in found if r.pair_id == 1)
    assert [(s.subject_id, s.object_id) for s in steps] == [(4, 2), (2, 3)]
    known = {(r[0], r[2], r[1]) for r in edges.collect()}
    assert all((s.subject_id, s.predicate_id, s.object_id) in known for r in found for s in r.steps)


def test_pairs_through_a_hub_share_their_searches(spark, monkeypatch):
    """25 x 25 pairs through one hub: what is walked is kept for each of 50 ends, not for each of 625 pairs."""
    n = 25
    links = [(i, 1000) for i in range(n)] + [(1000, 100 + j) for j in range(n)] + [(i, 500 + i) for i in range(n)] + [(0, 100)]
    edges = spark.createDataFrame([(a, b, "Is a", None) for a, b in links], "concept_id_1 long, concept_id_2 long, relationship_id string, invalid_reason string")
    pairs = spark.createDataFrame([(i * n + j, i, 100 + j) for i in range(n) for j in range(n)], "pair_id long, source long, target long")
    walked, keep = [], graph.written

    def counted(df):
        out = keep(df)
        if "relationship_id" in df.columns:
            walked.append(out.count())
        return out

    monkeypatch.setattr(graph, "written", counted)
    found = {r.pair_id: [(s.subject_id, s.object_id) for s in r.steps] for r in graph.shortest_paths(edges, pairs).collect()}
    assert found == {i * n + j: [(0, 100)] if (i, j) == (0, 0) else [(i, 1000), (1000, 100 + j)] for i in range(n) for j in range(n)}
    assert sum(walked) <= 4 * n + 2


def test_missing_node_counts_as_invalid(spark, concepts, relationship):
    path = spark.createDataFrame([(1, 1, [(3, "Is a", 99)])], "pair_id long, path_id long, steps array<struct<subject_id:bigint,predicate_id:string,object_id:bigint>>")
    r = graph.path_profile(concepts, relationship, path).first()
    assert (r.invalid, r.non_standard, r.ontological, r.hops) == (1, 1, 1, 1)


def test_common_parents_and_cover(spark, concepts, closure):
    sets = spark.createDataFrame([(1, 3), (1, 4), (2, 3)], "set_id long, concept_id long")
    found = conceptset.common_parents(concepts, closure, sets)
    top = found.where("set_id = 1").orderBy("rank").first()
    assert (top.parent, top.coverage, top.completeness) == (2, 2, 1.0)
    assert found.where("set_id = 2").count() == 0
    cover = conceptset.greedy_cover(closure, sets, found).collect()
    assert [(r.set_id, r.parent, r.newly_covered) for r in cover] == [(1, 2, 2)]
    assert conceptset.uncovered_seeds(closure, sets, found.where("set_id = 1")).collect()[0].set_id == 2


def test_pads_and_fan_out(spark):
    rows = spark.createDataFrame([(1, '{"target_concept_id": "5"}', None), (2, "[]", None), (3, None, "timeout"), (4, '[{"target_concept_id": "1"}, null, {"target_concept_id": "2"}]', None)], "row_id long, answer string, error string")
    parsed = rows.withColumn("picks", picks.parse_picks(F.col("answer")))
    found = {(r.row_id, r.pick_index): r for r in picks.fan_out_picks(parsed.drop("answer")).collect()}
    assert found[3, 0].error == "timeout|no_json_extracted" and found[2, 0].target_concept_id is None and found[2, 0].error is None
    assert [found[4, i].target_concept_id for i in (0, 1)] == ["1", "2"] and found[4, 0].n_targets == 2
    assert parsed.select(F.size(picks.pad_picks(F.col("picks"), 2))).distinct().collect()[0][0] == 2


def test_last_answer():
    assert picks.last_answer('x {"target_concept_id": 1} y [{"target_concept_id": 2, "s": "}"}] {"other": 3}') == '[{"target_concept_id": 2, "s": "}"}]'
    assert picks.last_answer('{"target_concept_id": 1} { open "target_concept_id"') == '{"target_concept_id": 1}'
    assert picks.last_answer(None) is None and picks.last_answer('{"target_concept_id": }') is None


@settings(max_examples=60, deadline=None)
@given(st.text('{}[]",: a\\'), st.integers(0, 9))
def test_last_answer_finds_what_stands_last(noise, n):
    answer = json.dumps({"target_concept_id": n})
    before = noise.replace("{", " ").replace("[", " ").replace('"', " ")
    assert picks.last_answer(before + answer) == answer


def test_validation_order(spark, concepts):
    rows = spark.createDataFrame([(1, None, None), (2, "x", None), (3, "99", None), (4, "5", None), (5, "3", "TYPE 2 diabetes "), (6, "3", "other")], "row_id long, target_concept_id string, target_concept_name string")
    found = {r.row_id: r.validation_error for r in picks.validate_picks(rows, concepts).collect()}
    assert found == {1: "no_target", 2: "not_an_integer", 3: "not_in_vocabulary", 4: "not_standard", 5: None, 6: "name_mismatch"}


def test_gestalt_ratio_is_difflib(spark):
    rows = [("Type 2 diabetes", "diabetes type 2"), ("a" * 250, "a" * 200 + "b"), ("", ""), (None, "x")]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", tx.gestalt_ratio("a", "b").alias("r")).collect()
    for r in got:
        assert r.r is None if r.a is None else r.r == pytest.approx(difflib.SequenceMatcher(None, r.a.lower(), r.b.lower()).ratio())


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.text("abAB -é", max_size=8), st.text("abAB -é", max_size=14)), min_size=1, max_size=30))
def test_gestalt_by_columns(spark, rows):
    rows = [*rows, *((a, f"x{a}y{b}") for a, b in rows), ("a" * 3, "a" * 230), ("", ""), (None, "x"), ("K", "\u212a"), ("İ", "i̇")]
    a, b = F.col("a"), F.col("b")
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", tx.gestalt(a, b).alias("r"), tx.gestalt_known(a, b).alias("known"), tx.gestalt_bound(a, b).alias("bound")).collect()
    for r in got:
        want = None if r.a is None else difflib.SequenceMatcher(None, r.a.lower(), r.b.lower()).ratio()
        assert r.r == pytest.approx(want) if want is not None else r.r is None
        assert r.known is None or r.known == pytest.approx(want)
        assert want is None or r.bound >= want - 1e-12


def test_few_pairs_reach_python(spark):
    """Names that hold their keyword need no Python, and of the others only those that can still be among the best."""
    words = ["type", "two", "diabetes", "mellitus", "renal", "failure", "acute", "of", "heart", "chronic"]
    names = [(f"{words[i % 10]} {words[i // 10 % 10]} {words[i // 100 % 10]}",) for i in range(1000)]
    asked = [(1, "diabetes mellitus"), (2, "renal failure of"), (3, "type two")]
    rows = spark.createDataFrame([(q, k, i, n) for q, k in asked for i, (n,) in enumerate(names)], "query_id long, keyword string, concept_id long, concept_name string")
    score = F.round(tx.hybrid_score(F.col("keyword"), F.col("concept_name"), tx.gestalt_ratio), 6)
    best = lambda df: pairs_of(semantic.top(df.withColumn("score", score), ["query_id"], [F.col("score").desc(), "concept_id"], 5), "query_id", "concept_id", "score")
    left = semantic.promising(rows, 5)
    assert best(left) == best(rows)
    asks = left.where(tx.gestalt_known(F.col("keyword"), F.col("concept_name")).isNull()).count()
    print(f"{asks} of {rows.count()} pairs reach Python")
    assert asks < 0.1 * rows.count()


@settings(max_examples=5, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 14), st.integers(0, 14)).filter(lambda e: e[0] < e[1]), max_size=40))
def test_closure_of_any_depth(spark, edges):
    edges = edges | {(i, i + 1) for i in range(20, 40)}  # a chain of twenty levels
    levels = {}

    def walk(start, node, n):
        for a, b in edges:
            if a == node:
                levels.setdefault((start, b), set()).add(n)
                walk(start, b, n + 1)

    for a in {a for a, _ in edges if a < 15}:
        walk(a, a, 1)
    for a in range(20, 40):
        for b in range(a + 1, 41):
            levels[a, b] = {b - a}
    is_a = spark.createDataFrame([(b, a) for a, b in edges] + [(None, 1), (2, None)], "child long, parent long")
    found = hierarchy.build_closure(is_a, spark.createDataFrame([(3,), (3,), (None,)], "concept_id long"))
    want = {k: (min(v), max(v)) for k, v in levels.items()} | {(3, 3): (0, 0)}
    assert {(r[0], r[1]): (r[2], r[3]) for r in found.collect()} == want


def test_closure_refuses_cycles(spark):
    for edges in ([(1, 1)], [(1, 2), (2, 3), (3, 1), (9, 1)]):
        with pytest.raises(ValueError, match="cycle"):
            hierarchy.build_closure(spark.createDataFrame(edges, "child long, parent long"))
    assert hierarchy.build_closure(spark.createDataFrame([], "child long, parent long")).count() == 0


@pytest.mark.parametrize(("seed", "target"), [(0, 1.0), (1, 0.7), (2, 1.0)])
def test_covers_in_rounds_equal_those_in_groups(spark, seed, target):
    rng = np.random.default_rng(seed)
    rows = []
    for set_id in range(3):
        seeds = int(rng.integers(1, 25))
        for parent in range(int(rng.integers(1, 12))):
            purity = float(rng.choice([0.0, 0.25, 0.5, 1.0]))
            rows += [(set_id, parent, int(s), int(parent), purity, seeds + set_id) for s in rng.choice(seeds, int(rng.integers(1, seeds + 1)), replace=False)]
    df = spark.createDataFrame(rows, "set_id long, parent long, seed long, rank long, purity double, n_seeds long")
    names = ("set_id", "pick_no", "parent", "newly_covered")
    assert pairs_of(conceptset._cover_in_rounds(df, target), *names) == pairs_of(conceptset._cover_in_groups(df, target), *names)


def test_a_large_set_is_covered_by_many_tasks(spark, monkeypatch):
    """200,000 seeds of one set below ten parents of rising size, each sharing some with the next."""
    seeds = spark.range(200_000).select(F.lit(1).cast("long").alias("set_id"), F.col("id").alias("concept_id"))
    below = seeds.select(F.explode(F.array_distinct(F.array(F.floor(F.sqrt("concept_id") / 45), F.floor(F.sqrt(F.col("concept_id") + 500) / 45)))).alias("p"), F.col("concept_id").alias("descendant_concept_id"))
    closure = below.select((F.col("p") + 1_000_000).alias("ancestor_concept_id"), "descendant_concept_id")
    parents = closure.select(F.lit(1).cast("long").alias("set_id"), F.col("ancestor_concept_id").alias("parent")).distinct().withColumns({"rank": F.col("parent"), "purity": F.lit(1.0)})
    found = conceptset.greedy_cover(closure, seeds, parents)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert found.agg(F.sum("newly_covered")).first()[0] == 200_000
    few = pairs_of(found, "set_id", "pick_no", "parent", "newly_covered")
    monkeypatch.setattr(conceptset, "GROUP_ROWS", 10**9)
    assert pairs_of(conceptset.greedy_cover(closure, seeds, parents), "set_id", "pick_no", "parent", "newly_covered") == few
    assert "left_anti" in plan.lower() or "LeftAnti" in plan


def test_rrf_ignores_input_order(spark):
    rows = [(1, s, c, r) for s in "ab" for r, c in enumerate((5, 6, 7) if s == "a" else (7, 5, 8), 1)]
    a, b = (pairs_of(semantic.rrf_fuse(spark.createDataFrame(x, "query_id long, source string, concept_id long, rank long")), "rank", "concept_id", "score") for x in (rows, rows[::-1]))
    assert a == b and a[0][1] == 5


def test_cosine_topk_is_brute_force_and_lsh_recalls(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "concept_id long, embedding array<double>")
    asked = index.where("concept_id < 20").withColumnRenamed("concept_id", "query_id")
    exact = pairs_of(semantic.cosine_topk(asked, index, 5), "query_id", "concept_id")
    want = sorted((q, int(i)) for q in range(20) for i in np.lexsort((np.arange(300), -np.round(x @ x[q], 6)))[:5])
    assert exact == want
    near = pairs_of(semantic.approx_topk(asked, index, 5), "query_id", "concept_id")
    assert len(set(near) & set(exact)) >= 0.9 * len(exact)
    monkeypatch.setattr(semantic, "QUERY_BLOCK", 7)
    monkeypatch.setattr(semantic, "INDEX_BLOCK", 40)
    monkeypatch.setattr(semantic, "BROADCAST_QUERIES", 0)
    assert pairs_of(semantic.cosine_topk(asked, index, 5), "query_id", "concept_id") == want
    others = pairs_of(semantic.cosine_topk(asked, index, 4, own=False), "query_id", "concept_id")
    assert others == [p for p in want if p[0] != p[1]]
    assert semantic.cosine_topk(asked.where("false"), index).count() == 0 == semantic.cosine_topk(asked, index.where("false")).count()


def test_eras_hold_nested_events(spark):
    rows = [(1, 9, "2024-01-01", "2024-03-01"), (1, 9, "2024-01-05", "2024-01-06"), (1, 9, "2024-03-20", None), (1, 9, "2024-06-01", "2024-06-02")]
    events = spark.createDataFrame(rows, "person_id long, c long, s string, e string").select("person_id", "c", F.to_date("s").alias("start"), F.to_date("e").alias("end"))
    found = intervals.eras(events, "c").orderBy("era_start").collect()
    assert [(str(r.era_start), str(r.era_end), r.n_events) for r in found] == [("2024-01-01", "2024-03-20", 3), ("2024-06-01", "2024-06-02", 1)]


def test_lineage_of_any_depth(spark):
    headers = spark.createDataFrame([(i, i - 1 if i else None) for i in range(200)] + [(500, 30)], "result_id long, parent_result_id long")
    asked = spark.createDataFrame([(199,), (500,), (0,)], "result_id long")
    found = pairs_of(staging.lineage(headers, asked), "result_id", "ancestor_id", "generation")
    assert found == sorted([(199, 199 - n, n) for n in range(200)] + [(500, 500, 0)] + [(500, 30 - n, n + 1) for n in range(31)] + [(0, 0, 0)])
    loop = spark.createDataFrame([(1, 2), (2, 1)], "result_id long, parent_result_id long")
    with pytest.raises(ValueError, match="own ancestors"):
        staging.lineage(loop, loop)


def test_scratch_tables_are_cleared(spark):
    since = scratch.mark()
    a = scratch.written(spark.range(5).toDF("x"))
    b = scratch.written(a.where("x > 2"))
    scratch.clear(spark, since, keep=b)
    assert b.count() == 2
    with pytest.raises(Exception, match="(?i)path"):
        a.count()


def test_domains_go_by_short_names(spark):
    row = {"cohortId": 1, "cohortName": "Gout", "status": "Accepted", "logicDescription": None, "hashTag": "#x"} | dict.fromkeys(catalogue.DOMAIN_FLAGS, "0") | {"domainDrugExposure": "TRUE", "domainVisitOccurrence": "1"}
    df = spark.createDataFrame([row], ", ".join(f"{c} {'long' if c == 'cohortId' else 'string'}" for c in row))
    q = spark.createDataFrame([(1, "gout")], "query_id long, keyword string")
    assert df.select(catalogue.active_domains()).first()[0] == "drug, visit"
    assert [catalogue.search_phenotypes(df, q, d).count() for d in ("drug", "Visit", "death", None)] == [1, 1, 0, 1]


def test_private_columns_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "person_id long, x long")
    with pytest.raises(ValueError, match="person_id"):
        governance.deidentify(df)
    with pytest.raises(ValueError):
        governance.safe_agg(df, ["person_id"])
    assert governance.safe_agg(df, ["x"], n=F.countDistinct("person_id")).count() == 1


def test_expire_spares_parents(spark):
    headers = spark.createDataFrame([(1, None), (2, 1), (3, None)], "result_id long, parent_result_id long").withColumn("created_at", F.expr("timestamp'2024-01-01 00:00:00'"))
    rows = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "result_id long, concept_id long")
    log = staging.promote(spark.createDataFrame([(2, "d")], "result_id long, draft_name string"), F.expr("timestamp'2024-01-01 00:00:00'"))
    kept, left = staging.expire(headers, rows, log, F.expr("timestamp'2024-01-01 02:00:00'"))
    assert pairs_of(kept, "result_id") == [(1,), (2,)] == pairs_of(left, "result_id")


def test_nothing_is_staged_for_an_empty_result(spark):
    results = spark.createDataFrame([(1, "t"), (2, "t")], "result_id long, tool_name string").withColumn("created_at", F.current_timestamp())
    concepts = spark.createDataFrame([(1, 7, "a")], "result_id long, concept_id long, concept_name string")
    headers, rows = staging.stage(results, concepts, ["concept_name"])
    assert headers.count() == 1 and "concept_id" not in staging.result_concepts(rows).columns


def test_files(spark, tmp_path):
    (tmp_path / "c.csv").write_text('﻿"cohortId","cohortName ",extra\n1,"a, b",x\nz,bad,y\n', encoding="utf-8")
    found = files.read_catalogue_csv(spark, str(tmp_path / "c.csv"), files.CATALOGUE_COLUMNS).collect()
    assert [(r.cohortId, r.cohortName, r.status) for r in found] == [(1, "a, b", None)]
    d = tmp_path / "defs"
    d.mkdir()
    (d / "1.json").write_text('{"ConceptSets": [{"name": "x"}]}')
    (d / "note.json").write_text("{}")
    assert [r.cohortId for r in files.read_definitions(spark, str(d)).collect()] == [1]
    m = tmp_path / "q" / "deep"
    m.mkdir(parents=True)
    (m / "D01.md").write_text("<!---\nGroup:drug\nName:D01 Find\nAuthor:me\nCDM Version: 5.0\n-->\n## Description\nText\n\n## Query\n```sql\nSELECT 1\n```\n\n## Input\nnone\n\n## Output\nrow\n")
    (m / "x.md").write_text("no name")
    parsed = catalogue.parse_query_files(files.read_query_corpus(spark, str(tmp_path / "q"))).collect()
    assert [(r.query_id, r.group, r.sql, r.input, r.output) for r in parsed] == [("D01", "drug", "SELECT 1", "none", "row")]
    v = tmp_path / "v"
    v.mkdir()
    for name, schema in files.VOCABULARY_FILES.items():
        columns = [c.split()[0] for c in schema.split(", ")]
        (v / f"{name.upper()}.csv").write_text("\t".join(columns) + "\n" + "\t".join("1" if " long" in c or " double" in c else '5" tube' for c in schema.split(", ")) + "\n")
    loaded = files.load_vocabulary(spark, str(v))
    assert loaded["concept"].first().concept_name == '5" tube' and len(loaded) == 9
    p = spark.createDataFrame([("s", "P1", "5", "exactMatch", "line\nbreak")], "source_data_identifier string, source_code string, target_concept_id string, predicate string, reasoning string")
    files.write_predictions(p, str(tmp_path / "p"))
    assert files.read_predictions(spark, str(tmp_path / "p")).first().reasoning == "line\nbreak"
    files.write_predictions(p.drop("predicate"), str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="predicate"):
        files.read_predictions(spark, str(tmp_path / "bad"))
    files.write_predictions(p.withColumn("alternative_target_concept_id", F.lit("6")), str(tmp_path / "t"))
    assert files.read_truth(spark, str(tmp_path / "t")).columns == files.TRUTH_COLUMNS
    with pytest.raises(ValueError, match="unknown mode"):
        files.embedding_metadata(spark.createDataFrame([(None,)], "invalid_reason string"), "none")


def test_wrong_vector_length_fails(spark, concepts):
    vectors = spark.createDataFrame([(2, [1.0])], "concept_id long, embedding array<double>")
    with pytest.raises(Exception, match="dimensions"):
        files.build_embedding_table(concepts, vectors, 2).collect()
    assert files.missing_vectors(concepts, vectors).count() == 7


def test_within_levels_handles_nulls(spark, closure):
    p = spark.createDataFrame([(1, 4, 1), (2, None, 1), (3, 3, 3)], "pair_id long, left_id long, right_id long")
    assert pairs_of(hierarchy.within_levels(closure, p), "pair_id", "near") == [(1, True), (2, False), (3, True)]


def test_unknown_domain_is_an_error(spark):
    df = spark.createDataFrame([(1,)], "cohortId long")
    with pytest.raises(ValueError, match="unknown domain"):
        catalogue.search_phenotypes(df, df, "weather")


def test_path_queries_reach_beyond_two_hops(spark, relationship):
    """Four hops from item to item by adjectives and a product, and as many as a search level by level finds."""
    there = [(10, 1), (11, 2), (1, 5), (2, 5), (12, 2), (13, 3), (3, 4), (4, 5)]
    edges = spark.createDataFrame([(a, b, r, None) for x, y in there for a, b, r in ((x, y, "Is a"), (y, x, "Subsumes"))], "concept_id_1 long, concept_id_2 long, relationship_id string, invalid_reason string")
    known = spark.createDataFrame([(i, f"c{i}", "D", "V", "K", f"k{i}", "S", None) for i in (1, 2, 3, 4, 5, 10, 11, 12, 13, 14)], CONCEPT)
    parts = spark.createDataFrame([(10, 1), (13, 1), (12, 2), (11, 2), (14, 3)], "branded long, bn long")
    g = SimpleNamespace(edges=edges, parts=parts, concept=known, relationship=relationship)
    near: dict[int, list[int]] = {}
    for x, y in there:
        near.setdefault(x, []).append(y)
        near.setdefault(y, []).append(x)
    want = {}
    for r in path_pairs(g).collect():
        level, seen, hops = {r.source}, {r.source}, 0
        while level and r.target not in level:
            level = {y for x in level for y in near.get(x, [])} - seen
            seen |= level
            hops += 1
        if level:
            want[r.pair_id] = hops
    found = _QUERIES["e6_rank_paths"](g).collect()
    assert {r.pair_id: r.hops for r in found} == want and want[10] == 4 and want[13] == 5
    walked = {}
    for r in sorted(_QUERIES["e8_path_concepts"](g).collect(), key=lambda r: r.position):
        walked.setdefault(r.pair_id, []).append(r.concept_id)
    assert walked[10] == [10, 11, 1, 5, 2] and set(walked[13]) == {13, 11, 3, 4, 5, 2}


def test_files_are_written_by_tasks_and_listed_once(spark, tmp_path):
    ids = spark.range(1, 301).select(F.concat(F.col("id").cast("string"), F.lit(".json")).alias("name"), F.concat(F.lit('{"é": '), F.col("id").cast("string"), F.lit("}\n")).alias("value"))
    folder = f"file://{tmp_path}/a b"
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("written", "")
    files.write_files(ids, folder)
    spark.sparkContext.setJobGroup("listed", "")
    rows = files.read_definitions(spark, folder)
    spark.sparkContext.setJobGroup("read", "")
    assert len(jobs.getJobIdsForGroup("written")) >= 1 and not jobs.getJobIdsForGroup("listed")  # no file's path is listed alone
    assert sorted(tuple(r) for r in rows.collect()) == [(i, f'{{"é": {i}}}\n') for i in range(1, 301)]
    deep = tmp_path / "a b" / "x=1"
    deep.mkdir()
    (deep / "999.json").write_text("{}")
    assert files.read_definitions(spark, f"{tmp_path}/a b").count() == 300  # files of the folder itself
    assert files.read_definitions(spark, f"{tmp_path}/a*").count() == 300
