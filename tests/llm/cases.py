"""Awkward documents that every operator must take."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
        T.StructField("size", T.StringType()), T.StructField("score", T.StringType()), T.StructField("key", T.StringType()),
    ]
)
LONG = "the quick brown fox jumps over the lazy dog, said no one. " * 3000
ROWS = [
    (1, None, "en", "a", None, "x", None, "k"),
    (2, "", "en", None, 0, "x", "s", None),
    (3, " \t\n\x0b\x0c\r", None, "a", 6, None, None, None),
    (4, "one", "de", "b", 3, None, None, None),
    (5, "one two", "de", "b", 7, None, None, None),
    (6, LONG, "en", "a", len(LONG), None, None, None),
    (6, LONG, "en", "a", len(LONG), None, None, None),
    (7, LONG, "en", "a", len(LONG), None, None, None),
    (None, "a text without an id, which is still a text", "fr", "c", 40, None, None, None),
    (8, "Größe é 日本語 <|endoftext|> don't stop  \n\n now" + "a" * 5000, "de", "b", 1, None, None, None),
    (9, "A common line that many documents hold\nown line of nine", "en", "a", 1, None, None, None),
    (10, "a common line that many documents HOLD \nown line of ten", "en", "a", 1, None, None, None),
    (11, "  A common line that many documents hold\r\n\nA common line that many documents hold", "en", "a", 1, None, None, None),
    (12, "call +1 (212) 555-0100 or mail jo@example.com from 10.0.0.1 with 4111 1111 1111 1111", "en", "z", 1, None, None, None),
]


def documents(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
