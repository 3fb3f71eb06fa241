"""Small tables that hold the awkward cases."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, ids=None):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(rng, n, size=40):
    return [f"w{rng.randrange(size)}" for _ in range(n)]
