"""Small inputs that every operator must stand."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 997} the" for i in range(20_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from the old red barn today.", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, "  \n\t ", "xx"),
    (5, LONG, "en"),
    (6, "Ünïcode ſtraße don't stop 12345 <|endoftext|> ﬁn\x1cx\u2003y İstanbul 日本語 e\u0301", "de"),
    (7, "The quick brown fox jumps over the lazy dog and runs away from the old red barn today.", "en"),
    (7, "The quick brown fox jumps over the lazy dog and runs away from the old red barn today.", "en"),
    (None, "A row without an id still has a text of its own to be worked on.", "fr"),
]


def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with names of results."""
    df = spark.createDataFrame(TEXTS, "doc_id long, text string, lang string")
    clash = ("score", "kept", "ids", "secrets", "n_entities", "licenses", "node", "part", "reference", "path")
    return df.withColumns({c: F.lit("x") for c in clash})


def empty(spark):
    return odd(spark).limit(0)
