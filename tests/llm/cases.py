"""Tables with the awkward rows every operator must take."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

SMALL = "/root/testdata/sf0.001"
LONG = "the of and in to that. " * 60_000
DOCUMENTS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
    # names that operators give to columns of their own
    StructField("ids", StringType()), StructField("score", StringType()), StructField("SPANS", StringType()),
    StructField("kept", StringType()), StructField("row", StringType()),
])


def odd_documents(spark):
    texts = [(1, "the cat sat on the mat and was of it", "en"), (2, None, "en"), (3, "", None), (4, LONG, "en"),
             (5, "same words here in this one text", "en"), (5, "same words here in this one text", "en"),
             (6, "same words here in this one text", "en"), (None, "no id at all", "de"), (7, " \n\t ", "fr"),
             (8, "123 456 !!!", None)]
    rows = [(i, t, lang, "s", len(t or ""), "x", "y", "z", "k", "r") for i, t, lang in texts]
    return spark.createDataFrame(rows, DOCUMENTS)


def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
