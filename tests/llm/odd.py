"""Small tables with every odd case: nulls, empty and long texts, repeated rows and ids, clashing extra columns."""

from pyspark.sql import types as T

#: Extra columns named like columns that the operators make.
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("key", T.StringType()),
                     T.StructField("kept", T.StringType()), T.StructField("score", T.StringType()), T.StructField("n_words", T.StringType())])
LABELS = "doc_id long, quality int, toxic int"

PROSE = ("the quick brown fox jumps over the lazy dog while the patient river carries small boats towards a distant harbour "
         "where merchants weigh grain and children count the gulls above the grey stone wall ")


def rows():
    long = " ".join(f"word{i % 997} runs {i}" for i in range(20_000))
    texts = [PROSE, PROSE, PROSE + "tail one", "", None, "a", "  \n\t ", long, "x" * 5_000, "é" * 300, PROSE.upper() + "!!", "1 | 2 | 3 | " * 40, "日本 語 " * 30]
    out = [(i + 1, t, None, None, None, "k", None, "s", "w") for i, t in enumerate(texts)]
    return out + [out[0], (2, "another text under a used id", "en", "src", 5, None, None, None, None), (None, PROSE, None, None, None, None, None, None, None),
                  (None, None, None, None, None, None, None, None, None)]


def docs(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, DOCS)


def plain(spark, texts):
    """doc_id from 0 for a list of texts."""
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def labels(spark, some=()):
    return spark.createDataFrame(list(some), LABELS)
