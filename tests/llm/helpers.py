import re
import zlib

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SF = "/root/testdata/sf0.001"

#: Extra columns whose names operators use for their own.
EXTRA = ("size", "kept", "score", "shard", "_key", "_id", "_text", "_copies", "_gone", "n", "target")


def words(text):
    return WORD.findall(text or "")


def held_out(key, n):
    return zlib.crc32(("" if key is None else str(key)).encode()) % n == 1


def edge_rows():
    """Nulls, empty and blank texts, ties, repeated rows, long texts, odd characters."""
    long = " ".join(f"word{i % 977} and{i % 13}" for i in range(12000))
    rows = [(0, "", "en", "a"), (1, None, "en", "b"), (2, " \n\t ", None, None),
            (3, "one two", "en", "a"), (3, "one two", "en", "a"),
            (None, "a row without an id " * 12, "en", "a"), (5, long, "en", "b"),
            (6, "One TWO three four five six " * 10, "en", "a"),
            (7, "one two three four five six " * 10, "fr", "a"),
            (8, "é\U0001f600 ß x <|endoftext|> \x1c y's don't 12½  z", "de", None),
            (9, "line a b c\nline a b c\nline a b c\nother line here", "en", ""),
            (10, "x" * 70000, "en", "c"), (11, "# $ % & * | < > " * 30, "en", "c"),
            (12, None, None, None)]
    return [(k, t, g, s, len(t or "")) for k, t, g, s in rows]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def edge_table(spark, rows=None):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(edge_rows() if rows is None else rows, SCHEMA)
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in EXTRA])
