"""Small tables with awkward rows, and brute-force versions of the base definitions."""

import re
import zlib

from pyspark.sql import types as T

# Columns of documents plus names that the operators use inside.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    T.StructField("name", T.StringType()), T.StructField("token", T.LongType()), T.StructField("score", T.StringType()),
    T.StructField("spans", T.LongType()), T.StructField("_base", T.StringType()), T.StructField("words", T.LongType()),
    T.StructField("low", T.LongType()), T.StructField("_h", T.StringType()), T.StructField("cluster", T.DoubleType())])

LONG = " ".join(f"word{i % 997} and{i % 13}" for i in range(30_000))


def frame(spark, rows, partitions=2):
    """rows: (doc_id, text); other columns hold clashing names and nulls."""
    full = [(i, t, None if k % 3 else "en", "src0", None, "x", k, None, 7, "b", None, 1, "h", 0.5)
            for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)


AWKWARD = [
    (None, "a null id has this text with some more words in it"), (None, None), (1, None), (2, ""), (3, "   \n\t  "),
    (4, "one"), (5, "Two words"), (6, "a b c d e f g h i j k l m n o p"), (7, "a b c d e f g h i j k l m n o p"),
    (8, "A B C D E F G H I J K L M N O P"), (8, "A B C D E F G H I J K L M N O P"), (9, "x" * 30_000), (10, LONG),
    (11, "É è ñ 日本語   \x00 \x1c tab\tand\x0bvt"), (12, "=" * 3000 + " " * 500 + "end"), (13, "one"),
]


def blank_words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def lower(t):
    return (t or "").translate({k: k + 32 for k in range(65, 91)})


def alnum_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))


def remainder(i, by):
    return zlib.crc32(("" if i is None else str(i)).encode()) % by


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
