"""Small tables with awkward rows."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Names that operators use for themselves, as columns of the input.
CLASHES = ["words", "row", "score", "fp", "key", "_id", "_hash", "clean", "item", "shard", "n"]


def docs(spark, rows):
    """Rows ``(doc_id, text)`` as a table of documents, with extra columns of clashing names."""
    from pyspark.sql import functions as F

    full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, DOCS)
    return df.withColumns({c: F.lit("x") for c in CLASHES})
