import random

import pytest
from pyspark.sql import functions as F

from termweave.operators import _pieces, search

WORDS = ["acute", "chronic", "disease", "of", "the", "kidney", "liver", "type", "unspecified", "disorder", "ox", "zq"]


@pytest.fixture(scope="module")
def names(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(WORDS[:10], weights=[9, 9, 30, 30, 30, 3, 3, 5, 20, 30], k=6)).title()) for i in range(2000)]
    rows[10], rows[11] = (10, "ox"), (11, None)
    return spark.createDataFrame(rows, "concept_id long, text string")


def asked(spark, keywords):
    return spark.createDataFrame(list(enumerate(keywords)), "query_id int, keyword string")


def first_piece(names, q):
    """Rows joined on each keyword's first piece of three characters, as a measure."""
    keyed = q.select("query_id", F.lower(F.substring("keyword", 1, 3)).alias("p"))
    return names.select("concept_id", F.explode(F.array_distinct(_pieces.cut(F.lower("text"), 3))).alias("p")).join(keyed, "p").count()


def pairs(df):
    return sorted((r.query_id, r.concept_id) for r in df.collect())


def brute(names, keywords):
    return sorted((q, r.concept_id) for q, k in enumerate(keywords) if k is not None for r in names.collect() if r.text is not None and k.lower() in r.text.lower())


@pytest.mark.parametrize("broadcast", [True, False])
def test_rarest_pieces_find_the_same_with_fewer_rows(spark, names, monkeypatch, broadcast):
    monkeypatch.setattr(_pieces, "HOT_TEXTS", 150)
    small = _pieces.small
    monkeypatch.setattr(_pieces, "small", lambda df, rows: broadcast and rows != _pieces.FEW and small(df, rows))
    keywords = ["disease of the kidney", "Disorder of the Liver", "the type", "disease of zq", "of", "o", "ox", None, "", "chronic KIDNEY"] + [f"disease of the {w}" for w in WORDS] * 6
    q = asked(spark, keywords)
    assert pairs(search._name_hits(names, q)) == brute(names, keywords)
    long = q.where("length(keyword) >= 3")
    joined = _pieces.candidates(names, F.col("text"), long, r"%_\\").count()
    assert joined < first_piece(names, long) / 2


def test_keywords_of_common_pieces_only(spark, names, monkeypatch):
    monkeypatch.setattr(_pieces, "HOT_TEXTS", 100)
    monkeypatch.setattr(_pieces, "small", lambda df, rows: False)
    keywords = ["disease", "disorder", "the", " of "] * 30
    q = asked(spark, keywords)
    found = _pieces.candidates(names, F.col("text"), q, r"%_\\")
    assert pairs(search._name_hits(names, q)) == brute(names, keywords)
    assert found.count() <= first_piece(names, q)


def test_rarest_piece_of_each_keyword(spark):
    names = spark.createDataFrame([(i, t) for i, t in enumerate(["abcx", "abcy", "bcdz", "xbcd", "zzz", "q%r"])], "concept_id long, text string")
    best = {r.keyword: (r._piece, r._holders) for r in _pieces.rarest(names, F.col("text"), asked(spark, ["abcd", "bcd", "zz", "nope", "%", "a%c", "ABCX", "abcx", "q\\%r"]), r"%_\\").collect()}
    assert best == {"abcd": ("abc", 2), "bcd": ("bcd", 2), "zz": ("zz", 1), "%": ("", 6), "a%c": ("a", 2), "ABCX": ("bcx", 1), "abcx": ("bcx", 1), "q\\%r": ("q", 1)}
