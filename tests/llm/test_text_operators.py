import hashlib
import itertools
import math
import os
import random
import re
import textwrap

import numpy as np
import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from termweave.llm import bpe, components, decontaminate, jaccard, licenses, lines, quality, secrets, substring
from termweave.llm.textops import Words, text_bytes
import pyarrow as pa

from .helpers import docs, empty, words

PATH = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"x{i}" for i in range(30_000))
ODD = [None, "", " \n\t ", "one", "Ünïcode é 日本 " * 3, "a\x0bb\x0cc  d"]


def split(text):
    return (text or "").encode().split()


# words and hashes


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \n\tabAé日 "))))
def test_words_are_those_between_separators(texts):
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    w = Words(data, offsets)
    got = [[bytes(data[w.starts[j] : w.ends[j]]) for j in range(w.first[i], w.first[i + 1])] for i in range(len(texts))]
    assert got == [split(t) for t in texts]
    seen = {}
    for ws, i in zip(got, range(len(texts))):
        for word, h in zip(ws, w.hashes[w.first[i] : w.first[i + 1]]):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


# BPE


@pytest.fixture(scope="module")
def own():
    return bpe.TrieEncoder(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r\x85 　'sdlmrtve0123"), st.characters(codec="utf-8"))))
def test_ids_are_the_librarys(own, library, text):
    ids = own.encode([text])[0]
    want = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_bpe_frame(spark, own, library):
    texts = [*ODD, "a<|endoftext|>b <|endoftext|>", "same", "same", LONG]
    found = {(r.doc_id): r for r in bpe.encode_decode(docs(spark, texts).withColumn("ids", F.lit(1)).withColumn("key", F.lit(2)), PATH, size=9).collect()}
    for i, t in enumerate(texts):
        assert np.frombuffer(found[i].ids, "<u4").tolist() == library.encode(t or "", add_special_tokens=False).ids
        assert found[i].decoded == (t or "") and found[i].n_tokens == len(found[i].ids) // 4
    assert bpe.encode_decode(empty(spark), PATH).count() == 0
    named = {r.doc_id: r.ids for r in bpe.encode_decode(docs(spark, texts), "byte_bpe_50k.json").collect()}
    assert named == {i: r.ids for i, r in found.items()}


def test_last_stage_keeps_null_ids(spark):
    import corpus_pipeline

    df = docs(spark, ["one", "two", "three"], [1, None, None])
    found = corpus_pipeline.bpe_codec(spark, df, "").collect()
    assert sorted(map(str, (r.doc_id for r in found))) == ["1", "None", "None"] and all(r.n_tokens for r in found)


def test_word_cache_may_be_cleared(library, monkeypatch):
    monkeypatch.setattr(bpe, "WORD_CACHE", 2)
    monkeypatch.setattr(bpe, "PAIR_CACHE", 2)
    enc = bpe.TrieEncoder(PATH)
    for t in ("one two three four", "five six seven", "one two"):
        assert np.frombuffer(enc.encode([t])[0], "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


# substring dedup


def brute_cut(rows, phrase=13):
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = split(t)
        for p in range(len(w) - phrase + 1):
            first.setdefault(tuple(w[p : p + phrase]), i)
    out = []
    for i, t in rows:
        w = split(t)
        gone = [False] * len(w)
        for p in range(len(w) - phrase + 1):
            if i is not None and first[tuple(w[p : p + phrase])] < i:
                gone[p : p + phrase] = [True] * phrase
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=str)


def cut_rows(df, **more):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.dedup(df, **more).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_substring_is_brute_force(spark, seed):
    rng = random.Random(seed)
    shared = [words(rng, rng.choice([12, 13, 14, 30, 80])) for _ in range(6)]
    texts = [" ".join(x for _ in range(rng.randrange(5)) for x in (words(rng, rng.randrange(20), 5) + rng.choice(shared))) for _ in range(60)]
    rows = list(zip(rng.sample(range(1000), 60), texts))
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows]).repartition(5)
    assert cut_rows(df) == brute_cut(rows)


def test_substring_odd_rows(spark, monkeypatch):
    p = " ".join(f"p{i}" for i in range(20))
    rows = [*zip(range(len(ODD)), ODD), (20, p), (20, p), (20, "other " + p), (21, p), (None, p), (30, LONG), (31, LONG + " tail"), (32, "a a a a a a a a a a a a a a a")]
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows]).withColumn("doc", F.lit("x")).withColumn("tag", F.lit("x")).withColumn("kept", F.lit("x"))
    assert cut_rows(df) == brute_cut(rows)
    assert substring.dedup(empty(spark)).count() == 0
    factors = next(r.factors for r in substring.dedup(df).collect() if r.doc_id == 21)
    assert [(f.start, f.n, f.source) for f in factors] == [(0, 20, 20)] and factors[0].source_start in (0, 1)  # either text of 20


def test_common_anchors_are_dealt_by_phrase(spark, monkeypatch):
    monkeypatch.setattr(substring, "HOT_RUNS", 4)
    monkeypatch.setattr(substring, "HOT_SAMPLE", 1)
    monkeypatch.setattr(substring, "HOT_SHARE", 0)
    rng = random.Random(11)
    shared = [words(rng, n, 500) for n in (20, 30, 13)]
    common = words(rng, 4, 500)
    texts = [" ".join(x for _ in range(3) for x in (words(rng, rng.randrange(20), 30) + common + rng.choice(shared))) for _ in range(60)]
    rows = [*zip(rng.sample(range(1000), 60), texts), (2000, texts[0]), (2000, texts[0]), (None, texts[1])]
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows]).repartition(5)
    hot = substring._hot_anchors(df.selectExpr("doc_id doc", "text").where("doc is not null"), 13, 4)
    assert len(hot) > 3
    assert cut_rows(df) == brute_cut(rows)
    assert parsed(df) == brute_factors(rows)
    # in one task only the first holder of a phrase is looked up
    n = np.array([3, 2, 1])
    flat = np.arange(30, dtype=np.uint8).reshape(6, 5)
    flat[3:5] = flat[0:2]
    block = np.array([7, 7, 9], np.uint64)
    plain, asks, waits = substring._send(np.array([1, 2, 3]), np.array([10, 20, 30]), n, block, flat, np.array([7], np.uint64))
    assert [c.to_pylist() for c in plain.columns[:3]] == [[9], [3], [30]]
    assert asks.column(1).to_pylist() == [1, 1, 1] and asks.column(2).to_pylist() == [10, 11, 12] and len(set(asks.column(0).to_pylist())) == 3
    assert waits.column(1).to_pylist() == [2, 2] and waits.column(2).to_pylist() == [20, 21]
    assert [np.frombuffer(x, np.int64).tolist() for x in waits.column(3).to_pylist()] == [[1, 10], [1, 11]]


def brute_factors(rows, phrase=13):
    """The greedy parse of each document against the first place of every phrase of smaller ids."""
    first = {}
    rows = sorted({(i, t or "") for i, t in rows if i is not None})
    for i, t in rows:
        w = split(t)
        for p in range(len(w) - phrase + 1):
            first.setdefault(tuple(w[p : p + phrase]), (i, p))
    out = {}
    for i, t in rows:
        w, p, found = split(t), 0, []
        place = lambda x: first.get(tuple(w[x : x + phrase]), (i, 0)) if x + phrase <= len(w) else (i, 0)
        while p < len(w):
            source, at = place(p)
            n = 0
            while source < i and place(p + n) == (source, at + n):
                n += 1
            if n:
                found.append((p, n + phrase - 1, source, at))
            p += max(n, 1)
        out.setdefault(i, set()).add(tuple(found))
    return out


def parsed(df):
    out = {}
    for r in substring.dedup(df).collect():
        if r.doc_id is not None:
            out.setdefault(r.doc_id, set()).add(tuple((f.start, f.n, f.source, f.source_start) for f in r.factors))
    return out


def test_factors_are_greedy_and_longest(spark):
    rng = random.Random(4)
    long = " ".join(words(rng, 1000, 100_000))
    other = " ".join(words(rng, 300, 100_000))
    mixed = " ".join([*long.split()[100:200], *other.split()[5:250], *long.split()[150:400]])
    rows = [(1, long), (2, long), (3, "before " + long + " after"), (4, other), (5, mixed), (6, mixed), (7, "x " + other[: len(other) // 2])]
    piece = lambda a: long.split()[a : a + rng.randrange(8, 90)]
    rows += [(10 + i, " ".join(x for _ in range(4) for x in words(rng, rng.randrange(9), 9) + piece(rng.randrange(900)))) for i in range(20)]
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows]).repartition(4)
    found = parsed(df)
    assert found == brute_factors(rows) and cut_rows(df) == brute_cut(rows)
    assert found[2] == {((0, 1000, 1, 0),)} and found[3] == {((1, 1000, 1, 0),)}
    assert found[5] == {((0, 100, 1, 100), (100, 245, 4, 5), (345, 250, 1, 150))}


# Jaccard join


def shingles(text):
    w = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    top = {i: i for i, _ in sets if i is not None}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= 80 * len(a | b):
                p, q = sorted((root(i), root(j)))
                top[q] = p
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=str)


def found_components(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_components(df).collect()), key=str)


def near_rows(seed, n=40):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.7:
            w = rng.choice(rows)[1].split()
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = f"n{rng.randrange(999)}"
            if rng.random() < 0.3:
                w = w[: rng.randrange(len(w) // 2, len(w) + 1) or 1]
        else:
            w = words(rng, rng.choice([1, 3, 5, 9, 60, 150]), 300)
        rows.append((i * 7 % 101, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_jaccard_is_brute_force(spark, seed):
    rows = near_rows(seed)
    assert found_components(docs(spark, [t for _, t in rows], [i for i, _ in rows]).repartition(4)) == brute_components(rows)


def test_jaccard_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_ROWS", 3)
    monkeypatch.setattr(jaccard, "CLUSTER_SHINGLES", 50)
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", 0)
    base = " ".join(f"t{i}" for i in range(40))
    rows = [*zip(range(len(ODD)), ODD), (10, base), (10, base), (11, base.upper()), (12, base + " u"), (13, base + " v"), (14, base + " u v"), (15, base + " z"), (16, base + " z y"), (None, base), (None, None), (17, "Up To"), (18, "up\tto"), (40, LONG), (41, LONG + " more")]
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows]).withColumn("n", F.lit("x")).withColumn("rep", F.lit(1)).withColumn("label", F.lit(1))
    assert found_components(df) == brute_components(rows)
    assert jaccard.similar_components(empty(spark)).count() == 0


def test_bitmaps_never_hide_a_link():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 80), dtype=np.uint64))
        b = np.unique(np.concatenate((rng.choice(a, rng.integers(1, len(a) + 1), replace=False), rng.integers(0, 1 << 63, rng.integers(0, 20), dtype=np.uint64))))
        inter = len(np.intersect1d(a, b))
        if 100 * inter >= 80 * (len(a) + len(b) - inter):
            for times in (1, 8):
                assert jaccard._bound_passes(len(a), jaccard._unpack(jaccard._bitmap(a, times)), len(b), jaccard._unpack(jaccard._bitmap(b, times)), 80)


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)]
    found = {r.node: r.label for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and found[101] == 100
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# line dedup


def plain_runs(ls):
    """(first, end) of the fewest lines that hold a block's characters, from each line on and back."""
    size = [len(x.strip(" ")) for x in ls]
    out = set()
    for i in (n for n, x in enumerate(size) if x):
        out |= {(i, j) for j in [next((j for j in range(i + 1, len(ls) + 1) if sum(size[i:j]) >= lines.BLOCK_CHARS), None)] if j}
        out |= {(j, i + 1) for j in [next((j for j in range(i, -1, -1) if sum(size[j : i + 1]) >= lines.BLOCK_CHARS), None)] if j is not None}
    return out


def test_line_ends_and_indents_tell_no_copies_apart(spark):
    shared = ["a line that both documents share whole", "and one more line of the same block", "é and a third one, with an accent"]
    texts = ["\n".join(["own one", *shared]), "\r\n".join(["own two", *shared, "", "more"]), "\n".join(["own three", *("\t" + x + " \t" for x in shared), "\x0b"])]
    found = {r.doc_id: (r.n_removed, r.kept) for r in lines.dedup(docs(spark, texts)).collect()}
    assert found == {0: (0, texts[0]), 1: (3, "own two\r\n\r\nmore"), 2: (4, "own three")}


def brute_lines(rows, rare=lines.RARE_ROWS):
    """Every document against every earlier one: whole frames if they share a rare run, frames of common runs if a common one."""
    cut = [(i, (t or "").split("\n")) for i, t in rows]
    holders = {}
    for n, (i, ls) in enumerate(cut):
        for a, b in plain_runs(ls) if i is not None else ():
            holders.setdefault(tuple(x.strip(" ") for x in ls[a:b]), set()).add(n)
    holders = {k: v for k, v in holders.items() if len({cut[n][0] for n in v}) > 1}

    def frame(ls, keys):
        held = {x for a, b in plain_runs(ls) if tuple(y.strip(" ") for y in ls[a:b]) in keys for x in range(a, b)}
        out = []
        for n in range(len(ls)):
            if n in held:
                out.append(n)
            elif not out or out[-1] is not None:
                out.append(None)
        return out

    few, many = ({k for k, v in holders.items() if (len(v) <= rare) == want} for want in (True, False))
    out = []
    for n, (i, ls) in enumerate(cut):
        gone = set()
        mine = {k for k, v in holders.items() if n in v}
        for m, (j, other) in enumerate(cut):
            if i is None or j is None or j >= i:
                continue
            both = {k for k in mine if m in holders[k]}
            for keys in ([few | many] if both & few else []) + ([many] if both & many else []):
                x, y = frame(ls, keys), frame(other, keys)
                code = lambda row, at, gap: [gap if p is None else hash(row[p].strip(" ")) if row[p].strip(" ") else 0 for p in at]
                sizes = [0 if p is None else len(ls[p].strip(" ")) for p in x]
                gone |= {x[p] for p in lines.common_lines(code(ls, x, -1), code(other, y, -2), sizes)}
        gone = lines.without_lines(ls, gone)
        out.append((i, len(ls), len(gone), "\n".join(x for p, x in enumerate(ls) if p not in gone)))
    return sorted(out, key=str)


def cut_lines(df, **more):
    return sorted(((r.doc_id, r.n_lines, r.n_removed, r.kept) for r in lines.dedup(df, **more).collect()), key=str)


@pytest.mark.parametrize("rare", [1, 3, 1000])
def test_lines_are_brute_force(spark, monkeypatch, rare):
    monkeypatch.setattr(lines, "RARE_ROWS", rare)
    rng = random.Random(5)
    pool = [f"a line of some length number {i}" for i in range(30)] + ["", " ", "}", "short", "less short"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 12)))) for i in rng.sample(range(500), 40)]
    rows += [(600, None), (601, ""), (602, rows[0][1]), (602, rows[0][1]), (602, rows[1][1]), (None, rows[0][1]), (603, "\n".join(pool * 40)), (604, " \n  \n")]
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows]).withColumn("tag", F.lit("x")).withColumn("kept", F.lit("x"))
    assert cut_lines(df, carry=["lang", "tag"]) == brute_lines(rows, rare)
    assert {r.tag for r in lines.dedup(df, carry=["tag"]).collect()} == {"x"}
    assert lines.dedup(empty(spark)).count() == 0


def test_overlaps_are_found_past_the_earliest_holders(spark, monkeypatch):
    first, second = "alpha line 1", "beta line 22"
    texts = [f"{first}\nq0", f"q1\n{second}", f"q2\n{first}\n{second}\nq3", f"q4\n{first}\n{second}\nq5"]
    df = docs(spark, texts, [1, 2, 3, 4])
    assert [(i, n) for i, _, n, _ in cut_lines(df)] == [(1, 0), (2, 0), (3, 0), (4, 2)]
    monkeypatch.setattr(lines, "RARE_ROWS", 1)
    assert [(i, n) for i, _, n, _ in cut_lines(df)] == [(1, 0), (2, 0), (3, 0), (4, 2)]


@pytest.mark.parametrize("rare", [1, 8])
def test_lines_are_aligned_with_further_holders(spark, monkeypatch, rare):
    monkeypatch.setattr(lines, "RARE_ROWS", rare)
    x, y = "a line that several documents hold", "another line that several documents hold"
    short = [f"short {i}" for i in range(5)]
    texts = [
        *(f"{x}\np\n{x}\nq", f"r1\n{x}\nr2", f"s1\n{x}\ns2", f"t1\n{x}\nt2"),  # the earliest holder repeats the line
        *(f"o{i}\n{s}\nu{i}" for i, s in enumerate(short)), "\n".join(["v1", *short, "v2"]), "\n".join(["w1", *short, "w2"]),  # each line of the block stands in another document
        *(f"{y}\nk1\n{y[::-1]}", f"{y[::-1]}\nm1\n{y}\nm2", f"n1\n{y[::-1]}\nn2\n{y}\nn3"),  # the earliest holder has the lines crossed
    ]
    rows = list(enumerate(texts))
    rng = random.Random(8)
    pool = [[f"line {i} of block {b}" + " and more" * (i % 2) for i in range(4)] for b in range(12)]
    for i in range(60):  # in any order, so that many earlier holders have them crossed
        rows.append((100 + i, "\n".join(z for b in rng.sample(pool, 3) for z in [f"own {i} {b[0]}", *b[rng.randrange(2) :], ""])))
    rows += [(100, rows[-1][1]), (160, rows[-1][1]), (160, rows[-1][1]), (None, rows[-1][1])]
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows])
    found = {i: n for i, _, n, _ in cut_lines(df) if (i or 99) < 50}
    assert [found[i] for i in (1, 2, 3)] == [0, 1, 1] and found[10] == 5 and found[13] == 2
    assert cut_lines(df) == brute_lines(rows, rare)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["", " ", "a", "bc d ", " e" * 5, "long " * 5, "é" * 9]), min_size=1, max_size=10), min_size=1, max_size=3))
def test_runs_are_plain_runs(texts):
    data, offsets = text_bytes(pa.array(["\n".join(t) for t in texts]))
    first, hashes, sizes = lines.split_lines(data, offsets)
    assert np.diff(first).tolist() == [len(t) for t in texts] and sizes.tolist() == [len(x.strip(" ")) for t in texts for x in t]
    text, a, b, run = lines.runs(first, hashes, sizes)
    got = list(zip(text.tolist(), (a - first[text]).tolist(), (b - first[text]).tolist()))
    assert sorted(got) == sorted((i, *x) for i, t in enumerate(texts) for x in plain_runs(t))
    named = {}
    for (i, x, y), h in zip(got, run.tolist()):
        assert named.setdefault(tuple(z.strip(" ") for z in texts[i][x:y]), h) == h
    assert len(set(named.values())) == len(named)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 6)), st.lists(st.integers(0, 6)))
def test_patience_aligns_equal_lines_in_order(a, b):
    pairs = lines.patience(a, b)
    assert all(a[x] == b[y] for x, y in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert lines.patience(a, a) == [(i, i) for i in range(len(a))]


# decontamination


def semi_global(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


@settings(max_examples=100, deadline=None)
@given(st.text("abc ", min_size=1, max_size=90), st.text("abc ", max_size=120))
def test_myers_is_the_table(p, t):
    assert decontaminate.myers(p, t)[0] == semi_global(p, t)


def test_leaks_are_brute_force(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 150)
    rng = random.Random(2)
    items = [" ".join(words(rng, 15, 500)) for _ in range(5)] + ["tiny item", "", None]
    texts = []
    for n in range(40):
        t = list(items[n % 5])
        for _ in range(rng.randrange(9)):
            k, c = rng.randrange(len(t)), rng.choice("xyz ")
            t[k : k + rng.randrange(2)] = [c] * rng.randrange(2)
        texts.append(" ".join([*words(rng, 20, 500), "".join(t).upper() if n % 3 else "".join(t), *words(rng, 20, 500)]))
    texts += [None, "", items[0].replace(" ", "\n\t "), "a Tiny  Item here", LONG, items[1] + LONG, items[2], items[2]]
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.distance) for r in decontaminate.leaks(docs(spark, texts).withColumn("item_id", F.lit(3)), b).collect())
    want = []
    for i, t in enumerate(texts):
        t = decontaminate.normal(t)
        for j, item in enumerate(items):
            item = decontaminate.normal(item)
            if item and len(t) < 5000 and (d := semi_global(item, t)) <= decontaminate.budget(len(item), 8):
                want.append((i, j, d))
            elif item and len(t) >= 5000 and item in t:
                want.append((i, j, 0))
    assert got == sorted(want) and len(want) > 20
    assert decontaminate.leaks(empty(spark), b).count() == 0
    assert decontaminate.leaks(docs(spark, texts), b.where("false")).count() == 0


def test_short_items_have_the_same_rule(spark):
    items = spark.createDataFrame([(1, "twenty char item ab!"), (2, "thirteen char"), (3, "only twelve!")], "item_id long, text string")
    texts = ["so twenty chXr item ab! it is", "a thirtXeen char b", "x only twelvX! x", "an only twelve! x", "twenty cXXr item ab!"]
    assert sorted((r.doc_id, r.item_id, r.distance) for r in decontaminate.leaks(docs(spark, texts), items).collect()) == [(0, 1, 1), (1, 2, 1), (3, 3, 0)]


# licences


def test_licences(spark):
    mit = " ".join(licenses.SENTENCES[k][0] for k in ("mit-grant", "mit-notice", "as-is"))
    texts = [*ODD, "Text. Released under the MIT License.", "x\nLICENSED under the Apache License,   Version 2.0.\ny", mit, mit.replace("THE", "the") + "\n" + mit, "This work is licensed under the GNU General Public License, version 3.\nLicensed under CC BY-NC 4.0.", "licensed under something", LONG + ". Licensed under CC BY 4.0."]
    found = {r.doc_id: [x.licence for x in r.licences] for r in licenses.scan(docs(spark, texts).withColumn("key", F.lit(1))).collect()}
    n = len(ODD)
    assert all(not found[i] for i in range(n))
    assert [found[n + i] for i in range(7)] == [["MIT"], ["Apache-2.0"], ["MIT"], ["MIT", "MIT"], ["GPL-3.0-only", "CC-BY-NC-4.0"], [], ["CC-BY-4.0"]]
    assert licenses.scan(empty(spark)).count() == 0


def _wrapped(text, mark="", width=60):
    return "\n".join(mark + x for x in textwrap.wrap(text, width))


@pytest.mark.parametrize("mark", ["", " * ", "// ", "# ", "dnl ", "REM ", "-- "])
def test_licences_of_wrapped_and_commented_texts(mark):
    form = lambda *names: "\n\n".join(licenses.SENTENCES[k][0].replace("{}", "Example Corp. and others") for k in names)
    show = lambda text: [x for x, _, _ in R.match(R.identify("\n".join(["Some words.", *(_wrapped(x, mark) for x in text.split("\n\n")), "More words"])))]
    R = licenses.Recogniser()
    assert show(form("mit-grant", "mit-notice", "as-is")) == ["MIT"]
    assert show(form("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse")) == ["BSD-3-Clause"]
    assert show(form("bsd-redistribution", "bsd-source", "bsd-binary")) == ["BSD-2-Clause"]
    numbered = form("bsd-redistribution") + "\n\n1. " + form("bsd-source") + "\n\n2. " + form("bsd-binary") + "\n\n3. " + form("bsd-endorse")
    assert show(numbered) == ["BSD-3-Clause"]
    for names, licence in ((("gpl-free", "gpl-hope"), "GPL-3.0-or-later"), (("gpl-2-free", "gpl-hope"), "GPL-2.0-or-later"), (("lgpl-21-free",), "LGPL-2.1-or-later"), (("agpl-3-free",), "AGPL-3.0-or-later"), (("mpl-2",), "MPL-2.0"), (("isc-grant",), "ISC"), (("0bsd-grant",), "0BSD"), (("apache-licensed", "apache-comply", "apache-obtain"), "Apache-2.0")):
        assert show(form(*names)) == [licence]
    assert show("SPDX-License-Identifier: MIT OR GPL-2.0+") == ["GPL-2.0-or-later", "MIT"]
    assert show("This is not Licensed under the MIT License.") == [] and show("Licensed under the MIT License we wrote") == []


def test_every_known_sentence_is_found_and_numbered():
    r = licenses.Recogniser()
    for name, forms in licenses.SENTENCES.items():
        for form in forms:
            text = form.replace("{}", "the library")
            for shown in (text, _wrapped(text, "/* ", 30), text.upper()):
                assert [x for _, x in r.identify("One.\n" + shown + "\nTwo.")] == [name], (name, shown)
    wrapped = "a first line that goes\non here. And two.\n\nLicensed under CC BY 4.0.\nlast words\nLicensed under CC BY-NC 4.0."
    assert r.identify(wrapped) == [(2, "cc-by-4"), (4, "cc-by-nc-4")]
    assert r.identify("\n" * 200_000) == []


_LIC = licenses.SENTENCES
_BSD4 = "\n".join(_LIC[k][0].replace("{}", "the X") for k in ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-advert")) + "\nThis product includes software developed by the X.\n" + _LIC["bsd-endorse"][0].replace("{}", "the X")


@pytest.mark.parametrize(
    ("text", "licences", "expressions"),
    [
        (_BSD4, ["BSD-4-Clause"], []),
        ("This software is released under the MIT license.", ["MIT"], ["MIT"]),
        ("The code is licensed under the MIT License; see LICENSE.", ["MIT"], ["MIT"]),
        ("The code is licensed under the MIT License and may be copied", ["MIT"], ["MIT"]),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", ["CC-BY-4.0"], ["CC-BY-4.0"]),
        ("Shared under the Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License.", ["CC-BY-NC-SA-3.0"], ["CC-BY-NC-SA-3.0"]),
        ("x\n     GNU GENERAL PUBLIC LICENSE\n       Version 3, 29 June 2007\n\n Copyright (C) 2007 F\n " + _LIC["gpl-verbatim"][0] + "\n\n   Preamble\n\n" + _LIC["gpl-3-open"][0], ["GPL-3.0-only"], []),
        ("  Apache License\n  Version 2.0, January 2004\n", ["Apache-2.0"], []),
        ("Mozilla Public License Version 2.0\n====\n\n1. Definitions", ["MPL-2.0"], []),
        ("Creative Commons Attribution-ShareAlike 4.0 International Public License\n\nBy", ["CC-BY-SA-4.0"], []),
        ("The MIT License (MIT)\n\nCopyright (c) X\n\n" + _LIC["mit-grant"][0] + "\n\n" + _LIC["mit-notice"][0] + "\n\n" + _LIC["as-is"][0], ["MIT"], []),
        ("// SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", ["GPL-2.0-only WITH Classpath-exception-2.0"], ["GPL-2.0-only WITH Classpath-exception-2.0"]),
        ("# SPDX-License-Identifier: (MIT OR Apache-2.0)\n", ["Apache-2.0", "MIT"], ["(MIT OR Apache-2.0)"]),
        ("SPDX-License-Identifier: (MIT OR", ["MIT"], []),
        ("Dual-licensed under the MIT License or the Apache License, Version 2.0.", ["Apache-2.0", "MIT"], ["MIT OR Apache-2.0"]),
        ("It is distributed under GPLv3+.", ["GPL-3.0-or-later"], ["GPL-3.0-or-later"]),
        ("Released under the GNU GPL version 2 or later.", ["GPL-2.0-or-later"], ["GPL-2.0-or-later"]),
        ("License: BSD 3-Clause\nName: x", ["BSD-3-Clause"], ["BSD-3-Clause"]),
        *((x, [], []) for x in ("It is no longer licensed under the MIT License.", "The MIT License is popular.", "Licensed under an MIT-style license.", "Licensed under the Apache License.", "MIT gives courses. A licence to kill.", "Stored under the table. The GPL 3 line.", "It isn't released under the MIT license.")),
    ],
)
def test_licences_of_ordinary_notices(text, licences, expressions):
    r = licenses.Recogniser()
    for shown in (text, "First words.\n" + text, text + "\n\nLast words."):
        assert sorted(x for x, _, _ in r.match(r.identify(shown))) == licences and r.expressions(shown) == expressions


def test_names_are_long_texts_safe():
    r = licenses.Recogniser()
    assert r.identify("The " * 300_000 + "license. " + "The end. " * 30_000) == []
    assert len(set(licenses.NAMES.values())) > 40 and all(licenses._named(" ".join(k), 0) for k in licenses.NAMES)


def test_rules_need_order_and_closeness():
    r = licenses.Recogniser({"a": ("A one.",), "b": ("B two.",)}, (("X", ("a", "b")), ("Y", ("b",))))
    match = lambda t: [x[0] for x in r.match(r.identify(t))]
    assert match("A one. B two.") == ["X"] and match("B two. A one.") == ["Y"]
    assert match("A one. u. v. B two.") == ["X"] and match("A one. u. v. w. B two.") == ["Y"]


def brute_licences(text, sentences, rules):
    """Sentences looked up one by one, and every combination of places tried for each rule."""
    names = {tuple(re.findall(r"\w+", form.lower())): name for name, forms in sentences.items() for form in forms}
    parts = [tuple(re.findall(r"\w+", x.lower())) for x in re.split(r"(?<=[.!?:;])\s+|\n\s*\n", text)]
    found = [(n, names[p]) for n, p in enumerate(p for p in parts if p) if p in names]
    used, out = set(), []
    for licence, rule in rules:
        for first in range(len(found)):
            fits = (
                c for c in itertools.combinations(range(first, len(found)), len(rule))
                if c[0] == first and not used & set(c) and [found[i][1] for i in c] == list(rule) and all(found[j][0] - found[i][0] <= licenses.GAP + 1 for i, j in itertools.pairwise(c))
            )
            if best := min(fits, default=None):
                used |= set(best)
                out.append((licence, found[best[0]][0], found[best[-1]][0]))
    return found, sorted(out, key=lambda x: (x[1], x[2], x[0]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["Alpha is free.", "BETA may be sold.", "Gamma  has no\nwarranty.", "Alpha is not free.", "Words stand here.", "Who?"]), st.sampled_from([" ", "\n", "\n\n"])), max_size=12))
@example([(x, "\n") for x in ("Alpha is free.", "BETA may be sold.", "BETA may be sold.", "Who?", "Who?", "Gamma  has no\nwarranty.")])
def test_licences_are_brute_force(units):
    sentences = {"a": ("Alpha is free.",), "b": ("Beta may be sold.",), "c": ("Gamma has no warranty.",)}
    rules = (("X", ("a", "b", "c")), ("Y", ("a", "b")), ("Z", ("c", "c")), ("W", ("b",)))
    r, text = licenses.Recogniser(sentences, rules), "".join(x + y for x, y in units)
    found = r.identify(text)
    assert (found, r.match(found)) == brute_licences(text, sentences, rules)


# secrets


def test_base_spans():
    assign = re.compile(r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for t in ['a Token = "abcdef12"', "password=token: abcdefgh", "api_key: short", "AKIA" + "B2" * 8, "AKIAB AKIA" + "Z" * 20, "f" * 24 + " " + "f" * 23, "passwd:'x'", "ſecret=abcdefgh"]:
        want = [(m.start(), m.end(), 0) for m in assign.finditer(t) if len(m[2]) >= 6 and t.isascii()]
        want += [(m.start(), m.end(), 1) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        want += [(m.start(), m.end(), 2) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        assert secrets.base_spans(t) == sorted(want, key=lambda s: (s[0], s[2]))


def brute_tags(tokens, chain):
    emit = sum(chain.weights[tokens.features[:, c]].astype(float) for c in range(tokens.features.shape[1]))
    out = {}
    for i in range(len(tokens.first) - 1):
        a, b = tokens.first[i], tokens.first[i + 1]
        if a < b:
            for j, t in enumerate(secrets.viterbi(emit[a:b], chain)):
                if t:
                    out[int(a + j)] = int(t)
    return out


def test_tags_are_whole_viterbi_and_learned():
    rng = random.Random(4)
    texts = [" ".join(words(rng, 12)) + (f' token = "{rng.getrandbits(160):040x}" ' if rng.random() < 0.5 else " ") + " ".join(words(rng, 12)) for _ in range(200)] + ["", None]
    batch = pa.record_batch([pa.array(texts, pa.string())], ["text"])
    found = [b for b in secrets._windows(iter([batch]))]
    k = secrets.KINDS_OF_FEATURES
    rows = [(np.array(f.as_py()).reshape(-1, k), np.array(t.as_py())) for b in found for f, t in zip(b.column(0), b.column(1))]
    width = max(len(t) for _, t in rows)
    features, tags, mask = np.zeros((len(rows), width, k), np.int64), np.zeros((len(rows), width), np.int64), np.zeros((len(rows), width), bool)
    for i, (f, t) in enumerate(rows):
        features[i, : len(t)], tags[i, : len(t)], mask[i, : len(t)] = f, t, True
    chain = secrets.train(features, tags, mask)
    tokens = secrets.Tokens(*text_bytes(pa.array(texts, pa.string())))
    at, got = secrets.tag(tokens, chain)
    assert dict(zip(at.tolist(), got.tolist())) == brute_tags(tokens, chain)
    assert abs(len(at) - sum("token =" in (t or "") for t in texts)) <= 3
    noisy = secrets.Chain(rng and np.random.default_rng(0).normal(size=(secrets.WIDTH, 3)).astype(np.float32), np.random.default_rng(1).normal(size=(3, 3)), np.zeros(3))
    at, got = secrets.tag(tokens, noisy)
    assert dict(zip(at.tolist(), got.tolist())) == brute_tags(tokens, noisy)


def test_secret_frame(spark):
    texts = [*ODD, 'é token = "0123456789abcdef0123456789abcdef" x', "same secret: abcdef99", "same secret: abcdef99", LONG]
    df = docs(spark, texts).withColumn("spans", F.lit(0))
    found = {r.doc_id: r.spans for r in secrets.scan(df, secrets.fit(df)).collect()}
    for i, t in enumerate(texts):
        assert [(s.start, s.end, secrets.KINDS.index(s.kind)) for s in found[i] if s.kind != "crf"] == secrets.base_spans(t or "")
    assert secrets.scan(empty(spark), secrets.fit(empty(spark))).count() == 0


def test_the_chain_finds_what_patterns_miss(spark):
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    value = lambda: "".join(rng.choice(letters) for _ in range(rng.randrange(22, 40)))
    plain = lambda: " ".join([*words(rng, 15), str(rng.getrandbits(40)), "AND", f"v{rng.randrange(9)}.{rng.randrange(99)}", *words(rng, 15)])
    taught = [f'{plain()} token = "{value()}" {plain()}' if i % 3 == 0 else plain() for i in range(300)]
    chain = secrets.fit(docs(spark, taught + ODD))
    hidden = [value() for _ in range(40)]
    texts = [f"é {a} {v} {plain()}" for a, v in zip((plain() for _ in hidden), hidden)] + [plain() for _ in range(200)]
    found = {r.doc_id: r.spans for r in secrets.scan(docs(spark, texts), chain).collect()}
    hit = sum(any(s.kind == "crf" and texts[i][s.start : s.end] == v for s in found[i]) for i, v in enumerate(hidden))
    assert hit >= 36 and sum(bool(found[i]) for i in range(40, 240)) <= 2


def test_training_places_are_bounded_and_right():
    text = "é x " + " ".join(f'token = "{i:x}ab{i:040x}" and more' for i in range(30_000))
    batch = pa.record_batch([pa.array([text, None, "plain"])], ["text"])
    got = [b for b in secrets._windows(iter([batch]))]
    assert sum(b.num_rows for b in got) <= secrets.SPANS_A_DOC * (2 + len(secrets.ALPHABETS)) + 4
    assert all(len(f.as_py()) == len(t.as_py()) * secrets.KINDS_OF_FEATURES for b in got for f, t in zip(b.column(0), b.column(1)))
    assert sum(1 in t.as_py() for b in got for t in b.column(1)) >= secrets.SPANS_A_DOC * (2 + len(secrets.ALPHABETS))
    assert secrets._apart([(2, 9, 0), (3, 4, 2)], [(0, 2, 3), (5, 6, 3), (8, 10, 3), (9, 12, 3)]) == [(0, 2, 3), (2, 9, 0), (3, 4, 2), (9, 12, 3)]


# quality


def test_quality_learns_and_holds_out(spark):
    rng = random.Random(9)
    good = lambda: " ".join(rng.choice(["river", "mountain", "gentle", "story", "evening", "garden"]) for _ in range(40))
    bad = lambda: " ".join(rng.choice(["BUY!!", "$$$", "click###", "WIN!!"]) for _ in range(40))
    label = [i % 2 for i in range(240)]
    texts = [good() if x else bad() for x in label] + ODD
    df = docs(spark, texts).withColumn("score", F.lit("clash"))
    marks = spark.createDataFrame([(i, x, 0) for i, x in enumerate(label)] + [(None, 1, 0), (999, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(df, marks)
    found = quality.score(df, model).withColumn("held", quality.held_out("doc_id")).collect()
    held = [r for r in found if r.held and r.doc_id < 240]
    assert len(held) > 50 and sum(r.predicted == label[r.doc_id] for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found) and len(found) == len(texts)
    import zlib

    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    flipped = marks.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(quality.fit(df, flipped).bucket_score, model.bucket_score)
    assert quality.score(empty(spark), model).count() == 0
    none = quality.score(df, quality.fit(df, marks.where("false"))).first()
    assert none.score is not None


def slow_quality(text, model):
    """A score by loops over words and bytes."""
    full = (1 << 64) - 1

    def mixed(x):
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53), (33, 1)):
            x = (x ^ (x >> shift)) * factor & full
        return x

    data = text.encode()
    words = re.findall(rb"[^ \t-\r]+", data)
    ids = [int(quality.Words(np.frombuffer(w, np.uint8), np.array([0, len(w)])).hashes[0]) for w in words]
    kinds = [[x & ((1 << quality.BUCKET_BITS) - 1) for x in ids], [mixed((a + mixed(b)) & full) >> (64 - quality.PAIR_BITS) for a, b in itertools.pairwise(ids)]]
    bases, total = (0, (1 + len(quality.NGRAMS)) << quality.BUCKET_BITS), model.bias
    for first, (base, kind) in enumerate(zip(bases, kinds)):
        counted = {((i + first) // quality.WINDOW, x) for i, x in enumerate(kind)}
        total += sum(float(model.bucket_score[base + x]) for _, x in counted) / max(1, len(kind))
    spaced = [32 if c == 32 or 9 <= c <= 13 else c for c in data]
    for kind, n in enumerate(quality.NGRAMS, 1):
        found = []
        for gram in (spaced[i : i + n] for i in range(len(spaced) - n + 1)):
            if gram[1:-1].count(32) <= 1:
                code = (gram[0] * 0x9E3779B97F4A7C15 + n) & full
                for c in gram[1:]:
                    code = ((code ^ (code >> 29)) * 0xBF58476D1CE4E5B9 + c) & full
                code = (code ^ (code >> 32)) * 0x94D049BB133111EB & full
                found.append(float(model.bucket_score[(kind << quality.BUCKET_BITS) + (code >> (64 - quality.BUCKET_BITS))]))
        total += sum(found) / max(1, len(found))
    return 1 / (1 + math.exp(-max(-500, min(500, total))))


def test_quality_scores_are_brute_force(spark):
    rng = random.Random(4)
    model = quality.Model(np.random.default_rng(1).normal(size=quality.BUCKETS).astype(np.float32), -0.25)
    texts = [*ODD, "der der der der", "a", "x y", *(" ".join(rng.choice(["ab", "Ünd", "c", "der", "$$"]) + rng.choice(["", "", "\n", "\t "]) for _ in range(rng.randrange(120))) for _ in range(20))]
    found = {r.doc_id: r.score for r in quality.score(docs(spark, texts).repartition(3), model).collect()}
    assert all(abs(found[i] - slow_quality(t or "", model)) < 1e-9 for i, t in enumerate(texts))
    swapped = [slow_quality(t, model) for t in ("one two", "two one")]
    assert swapped[0] != swapped[1]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="the given tables aren't here")
def test_quality_of_held_out_rows(spark):
    table = lambda name: spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet")
    df, marks = table("documents").select("doc_id", "text"), table("labels").select("doc_id", "quality")
    found = quality.score(df.join(marks.where(quality.held_out("doc_id")), "doc_id"), quality.fit(df, marks)).select("quality", "predicted").collect()
    for label, least in ((0, 0.9), (1, 0.99)):
        mine = [r for r in found if r.quality == label]
        assert len(mine) > 100 and sum(r.predicted == label for r in mine) >= least * len(mine)
