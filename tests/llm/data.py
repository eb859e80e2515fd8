"""Small documents with every awkward case, and helpers of the brute-force versions."""

import re

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")

LONG = " ".join(f"word{k % 977}" for k in range(30_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs on.", "en", "a", 1),
    (2, "The quick brown fox jumps over the lazy dog and runs on.", "en", "a", 1),
    (2, "The quick brown fox jumps over the lazy dog and runs on.", "en", "a", 1),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \n\t ", "de", None, 4),
    (6, "Élan ÉLAN élan Straße STRASSE Σίσυφος ΣΊΣΥΦΟΣ", "fr", "b", 3),
    (7, "!!! ### $$$ 123 456", None, "b", 3),
    (8, LONG, "en", "a", len(LONG)),
    (9, LONG + " tail", "en", "c", len(LONG)),
    (None, "A text of no document at all, it has no number.", "en", "c", 9),
    (None, None, None, "c", None),
    (10, "x", "en", "", 1),
    (11, "a\u0085b c\x1cd e\x00f", "en", "b", 2),
    (12, "a" * 5000, "en", "b", 2),
    (13, "日本語 テキスト 🙂🙂 text", "ja", "b", 2),
]


def documents(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
