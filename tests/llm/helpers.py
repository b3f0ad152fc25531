"""Small documents with the awkward cases every operator has to define."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
PROSE = ("In the first part of the river there is a long bridge that many people cross every day. "
         "They walk to the old market, buy bread and fruit, and talk about the weather in the town.\n"
         "Later the boats return with fish and the children run along the water to see them come in.")


def documents(spark, rows, **extra):
    """rows: (doc_id, text); ``extra`` columns clash with names that operators use."""
    df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], SCHEMA)
    from pyspark.sql import functions as F
    return df.withColumns({k: F.lit(v) for k, v in extra.items()})


AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, PROSE), (5, PROSE), (6, PROSE + " More."), (None, PROSE),
           (None, None), (7, "x " * 30_000), (8, "é" * 5000), (9, "\n\nÜber straße　日本 \U0001F600 naïve\n"), (10, "a,b;c"),
           (-3, "The same line.\nThe same line.\nanother one here")]
EXTRA = dict(node=1, a=2, b=3, fp=4, text1="x", ids="y", score=0.5, s=6, t=7, part=8, row_id=9, digest="d", k=10)
