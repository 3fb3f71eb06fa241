"""Joins of texts with the keywords that they contain, by equal pieces of up to three characters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written
from ._rank import small

#: Characters of a piece.
PIECE = 3
#: Keywords up to which all are held against every text; more meet only texts that hold their piece.
FEW = 64
#: Texts that hold a piece, up to which they meet its keywords in one group; those of commoner pieces are dealt to several.
HOT_TEXTS = 100_000
#: Keywords up to which they are broadcast with their pieces.
BROADCAST_KEYWORDS = 100_000


def cut(text: Column, size: int) -> Column:
    """All runs of `size` characters."""
    if not size:
        return F.array(F.lit(""))
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1))), lambda i: text.substr(i, F.lit(size)))


def pieces_of(keyword: Column, special: str = "") -> Column:
    """The runs of PIECE characters that stand for themselves; shorter ones where there are none, and the empty one where there are none at all."""
    low, out = F.lower(keyword), F.array(F.lit(""))
    for size in range(1, PIECE + 1):
        stands = rf"(?s)\A[^{special}]{{{size}}}\z" if special else rf"(?s)\A.{{{size}}}\z"
        plain = F.filter(F.array_distinct(cut(low, size)), lambda p: p.rlike(stands))  # noqa: B023
        out = F.when(F.size(plain) > 0, plain).otherwise(out)
    return F.when(keyword.isNotNull(), out)


def rarest(texts: DataFrame, text: Column, queries: DataFrame, special: str = "") -> DataFrame:
    """keyword, _piece, _holders of every distinct keyword: of its pieces, the one that the fewest texts hold. Keywords of which a piece is held by none are left out."""
    asked = queries.select("keyword").distinct().select("keyword", F.explode(pieces_of(F.col("keyword"), special)).alias("_piece"))
    wanted = asked.select("_piece").distinct()
    sizes = _sizes(wanted)
    held = texts.select(F.explode(_held(text, sizes)).alias("_piece"))
    # the pieces asked for are found before anything is shuffled, if they are few
    counts = held.join(F.broadcast(wanted) if small(wanted, BROADCAST_KEYWORDS) else wanted, "_piece", "left_semi").groupBy("_piece").agg(F.count("*").alias("_holders"))
    least = asked.join(counts, "_piece", "left").groupBy("keyword").agg(F.min(F.struct(F.coalesce("_holders", F.lit(0)).alias("_holders"), "_piece")).alias("at"))
    return least.select("keyword", "at.*").where("_holders > 0")


def _sizes(pieces: DataFrame) -> list[int]:
    """The lengths of pieces; four at most."""
    return sorted(r[0] for r in pieces.select(F.length("_piece")).distinct().collect())


def _held(text: Column, sizes: list[int]) -> Column:
    """The distinct pieces of a text, of the given sizes."""
    low = F.lower(text)
    return F.array_distinct(F.concat(*(cut(low, size) for size in sizes))) if sizes else F.array().cast("array<string>")


def candidates(texts: DataFrame, text: Column, queries: DataFrame, special: str = "") -> DataFrame:
    """Rows of texts with each row of queries(keyword, ...) whose rarest piece they hold.

    Few keywords with their pieces are broadcast, and no text is shuffled. Many meet
    the texts by an equi-join; the texts that hold a common piece are then dealt to
    several groups, each of which has all keywords of that piece.
    """
    best = written(rarest(texts, text, queries, special))
    rows = texts.withColumn("_piece", F.explode(_held(text, _sizes(best))))
    if small(queries, BROADCAST_KEYWORDS):
        return rows.join(F.broadcast(queries.join(best.select("keyword", "_piece"), "keyword")), "_piece").drop("_piece")
    keyed = queries.join(best.withColumn("_groups", F.ceil(F.col("_holders") / HOT_TEXTS).cast("int")), "keyword")
    groups = best.select("_piece", F.ceil(F.col("_holders") / HOT_TEXTS).cast("int").alias("_groups")).distinct()  # also drops the pieces that no keyword has chosen
    dealt = rows.join(F.broadcast(groups) if small(groups, BROADCAST_KEYWORDS) else groups, "_piece").withColumn("_group", F.pmod(F.xxhash64(text), F.col("_groups")).cast("int")).drop("_groups")
    keyed = keyed.withColumn("_group", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1))).drop("_groups", "_holders")
    return dealt.join(keyed, ["_piece", "_group"]).drop("_piece", "_group")


def contained(texts: DataFrame, text: Column, queries: DataFrame, holds: Column, special: str = "") -> DataFrame:
    """Rows of texts with each row of queries(keyword, ...) for which `holds` is true.

    `holds` must imply that the lower-cased text contains the lower-cased keyword's
    pieces. Few queries are broadcast against the texts. Of many, each meets only
    the texts that hold the rarest of its pieces; a keyword of nothing but
    wildcards has the empty piece, which every text holds.
    """
    if small(queries, FEW):
        return texts.join(F.broadcast(queries), holds)
    return candidates(texts, text, queries, special).where(holds)
