import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use themselves.
    T.StructField("bucket", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("_group", T.IntegerType())])


def docs(spark, rows):
    """Rows of (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src", None if r[1] is None else len(r[1]), "x", 0.5, 1) for r in rows]
    return spark.createDataFrame(full, DOCS)


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


#: Null, empty, blank and odd texts, ids that are null or repeated, one long text.
EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (5, "one two"), (None, "no id at all"),
        (None, None), (6, "naïve ÉCOLE \u00a0 日本語 \x00 end"), (7, prose(1, 30_000)), (8, prose(1, 30_000))]


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
