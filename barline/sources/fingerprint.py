"""Dataset fingerprints.

* ``file_fingerprints``: SHA-256 of each file's bytes, the digest of hashing it locally.
* ``file_lines``: lines, header and ordered digest per file from one pass, for files of any size.
* ``input_line_counts``: physical lines minus the header, per file.
* ``row_fingerprint``: order- and partition-independent digest of a table's
  rows, for inputs too large or too many for per-file hashing.  Each row's
  text is hashed with MD5; two 60-bit slices of the digests are summed
  (associative, partial aggregation) and the sums are hashed with the count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.functions import cell_text, hex_slice_value
from barline.operators.ordered import file_digests

NULL_TEXT = "\\N"


def file_fingerprints(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``(path, dataset_hash, length)`` per file: SHA-256 of its bytes, read by an executor.
    For files up to the 2 GB that ``binaryFile`` allows; ``file_lines`` has no such bound."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        "path", F.sha2("content", 256).alias("dataset_hash"), "length")


def file_lines(spark: SparkSession, path: str | Sequence[str], names: Sequence[str] = ()) -> DataFrame:
    """``(path, lines, filled, header, fingerprint)`` per file from one pass over its splits.

    ``filled``: lines that are not blank; ``header``: the line that holds all of ``names`` as fields.  The fingerprint is the digest
    of the file's lines in their order and of its length (``ordered.file_digests``): any file size, any
    number of tasks, and it changes with every line, with their order and with line ends."""
    lines = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path)).select("value", "_metadata")
    fields = F.transform(F.split("value", ","), lambda x: F.lower(F.trim(F.regexp_replace(x, '["\r]', ""))))
    is_header = F.lit(bool(names))
    for n in names:
        is_header = is_header & F.array_contains(fields, n)
    header = F.max(F.when(is_header, F.regexp_replace("value", "\r$", "")))
    per = file_digests(lines, {"header": (header, F.max("header")), "filled": (F.count_if(F.trim(F.regexp_replace("value", "\r$", "")) != ""), F.sum("filled"))})
    return per.select("path", "lines", "filled", "header", F.col("digest").alias("fingerprint"))


def header_files(lines: DataFrame) -> dict[str, list[str]]:
    """Header line -> files, from ``file_lines`` (one row per file, as the driver lists them anyway)."""
    out: dict[str, list[str]] = {}
    for r in lines.select("path", "header").collect():
        if r["header"] is None:
            raise ValueError(f"source schema does not match: no header with the expected columns in {r['path']}")
        out.setdefault(r["header"], []).append(r["path"])
    return out


def input_line_counts(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """``(path, row_count)``: physical lines minus one header line per file."""
    return file_lines(spark, path).select("path", (F.col("lines") - (1 if header else 0)).cast("bigint").alias("row_count"))


def row_digest(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    types = dict(df.dtypes)
    cols = list(cols or df.columns)
    return F.md5(F.concat_ws("|", *[cell_text(c, types[c], missing=NULL_TEXT) for c in cols]))


def row_fingerprint(df: DataFrame, cols: Sequence[str] | None = None,
                    by: Sequence[Column | str] = ()) -> DataFrame:
    """``(*by, n_rows, fingerprint)``; equal for the same multiset of rows."""
    digested = df.select(*by, row_digest(df, cols).alias("_d"))
    group_names = [n for n in digested.columns if n != "_d"]
    agg = digested.groupBy(*group_names).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(hex_slice_value("_d", 1)).alias("_s1"),
        F.sum(hex_slice_value("_d", 16)).alias("_s2"),
    )
    text = F.concat_ws("|", F.col("n_rows").cast("string"), F.col("_s1").cast("string"),
                       F.col("_s2").cast("string"))
    return agg.select(*group_names, "n_rows", F.md5(text).alias("fingerprint"))
