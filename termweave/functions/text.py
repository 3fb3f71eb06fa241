"""Similarity of texts as column expressions and Arrow UDFs (G7-G10)."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


@F.pandas_udf(DoubleType())
def gestalt_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of the lower-cased texts, as difflib gives it; a null side gives null."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x.lower(), y.lower()).ratio() for x, y in zip(a, b)], dtype="float64")


def gestalt_known(a: Column, b: Column) -> Column:
    """gestalt_ratio without Python where the second text holds the first whole: nothing is left to match beside it. Null where it must be worked out.

    Texts must be ASCII, as lower case is not the same everywhere else, and the second
    shorter than 200 characters, from where on difflib skips common ones.
    """
    whole = F.contains(F.lower(b), F.lower(a)) & plain(a) & plain(b) & (F.length(b) < 200)
    both = F.length(a) + F.length(b)
    return F.when(whole, F.when(both == 0, F.lit(1.0)).otherwise(2.0 * F.length(a) / both))


def gestalt_bound(a: Column, b: Column) -> Column:
    """No less than gestalt_ratio: the characters that both texts hold, each as often as the one with fewer does; 1 for texts that are not ASCII."""
    x, y = F.lower(a), F.lower(b)
    held = lambda text, c: F.length(text) - F.length(F.replace(text, c, F.lit("")))
    shared = F.aggregate(F.array_distinct(F.split(x, "")), F.lit(0), lambda n, c: n + F.when(c == "", 0).otherwise(F.least(held(x, c), held(y, c))))
    both = F.length(a) + F.length(b)
    return F.when(plain(a) & plain(b) & (both > 0), 2.0 * shared / both).otherwise(F.lit(1.0))


def plain(text: Column) -> Column:
    return text.rlike(r"\A[\x00-\x7F]*\z")


def gestalt(a: Column, b: Column) -> Column:
    """gestalt_ratio; Python sees only the pairs of which gestalt_known tells nothing."""
    known = gestalt_known(a, b)
    return F.coalesce(known, gestalt_ratio(F.when(known.isNull(), a), F.when(known.isNull(), b)))


def levenshtein_ratio(a: Column, b: Column) -> Column:
    """1 - distance / longer length of the lower-cased texts; two empty texts are alike."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(F.lower(a), F.lower(b)) / longest)


def tokens(a: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(F.lower(a), r"\s+"), ""))


def jaccard_tokens(a: Column, b: Column) -> Column:
    """Shared over all lower-cased words; no words at all gives 0."""
    x, y = tokens(a), tokens(b)
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / union)


def hybrid_score(query: Column, name: Column, ratio=gestalt) -> Column:
    """0.4 text ratio + 0.4 word overlap + 0.2 preference for short names."""
    return 0.4 * ratio(query, name) + 0.4 * jaccard_tokens(query, name) + 0.2 / (1 + F.length(name) / 100)


def normal_name(a: Column) -> Column:
    return F.lower(F.trim(F.coalesce(a, F.lit(""))))


def preview(a: Column, size: int = 500) -> Column:
    """The first characters, line breaks written as \\n."""
    return F.replace(F.substring(F.coalesce(a, F.lit("")), 1, size), F.lit("\n"), F.lit("\\n"))
