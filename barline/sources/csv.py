"""CSV bar source.

Files are read as text columns, headers are normalised (strip + lower) and checked by
name, missing-value tokens become NULL, rows with any missing field are dropped (over all
columns of their file, extras included), and the named columns are parsed and cast to the raw-bar
contract.  Every file binds its columns by its own header, so files of one folder may order them
differently and differ in extra columns.  Input splits replace chunked reading; bad text raises (ANSI
casts), as a failed load should, or is kept with its reason (``line_outcomes``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.functions import parse_bar_time
from barline.operators.clean import drop_missing, normalise_columns, require_columns, require_names
from barline.schemas import CSV_COLUMNS, RAW_BARS, conform
from barline.sources.fingerprint import file_lines, header_files

# Field texts that the common pandas CSV reader treats as
# missing by default (the source loader relied on them).
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
TIME_FORMAT = "yyyyMMdd HH:mm:ss"


_CORRUPT = "_corrupt_record"


def header_columns(header: str) -> list[str]:
    return [c.strip().strip('"').strip().lower() for c in header.split(",")]


def _text_groups(spark: SparkSession, path: str | Sequence[str], names: Sequence[str],
                 headers: dict[str, Sequence[str]] | None) -> list[DataFrame]:
    """The files of each header as one frame of text columns."""
    if headers is None:
        headers = header_files(file_lines(spark, path, names))
    out = []
    for header, files in sorted(headers.items()):
        cols = header_columns(header)
        require_names(cols, names)
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*cols, _CORRUPT]])
        rows = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", _CORRUPT).csv(list(files)))
        # NULL for every good row; the error stops the load at a row with too many fields
        checked = F.when(_too_many(len(cols)), F.raise_error(F.concat(F.lit("too many fields: "), _CORRUPT)))
        out.append(rows.withColumn(_CORRUPT, checked.cast("string")).filter(F.col(_CORRUPT).isNull()).drop(_CORRUPT))
    if not out:
        raise ValueError(f"no CSV file with a header in {path}")
    return out


def _too_many(fields: int) -> Column:
    commas = F.length(_CORRUPT) - F.length(F.replace(F.col(_CORRUPT), F.lit(","), F.lit("")))
    outside_quotes = F.size(F.split(_CORRUPT, ",(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)", -1))
    return F.when(F.contains(F.col(_CORRUPT), F.lit('"')), outside_quotes).otherwise(commas + 1) > fields


def read_text_csv(spark: SparkSession, path: str | Sequence[str], names: Sequence[str] = tuple(CSV_COLUMNS),
                  headers: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """All columns as text, bound by each file's own header.  ``headers`` maps a header line to
    its files (default: found by one pass over the lines).  Files with the same header are
    read together; the groups are united by name, with NULL where a file lacks a column.

    A row with fewer fields than its header gets NULLs; one with more is an error."""
    groups = _text_groups(spark, path, names, headers)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups)


def null_tokens(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    toks = list(tokens)
    return df.select(*[F.when(F.col(c).isin(toks), None).otherwise(F.col(c)).alias(c) for c in df.columns])


def conform_bars(text: DataFrame, tokens: Sequence[str] = NA_TOKENS, time_format: str = TIME_FORMAT,
                 strict: bool = True, keys: Sequence[str] = ()) -> DataFrame:
    """Text frame with one bar header -> series ``keys`` + raw-bar contract (by name).  Rows with a
    missing value in any column of the frame are dropped."""
    df = drop_missing(null_tokens(require_columns(normalise_columns(text), [*CSV_COLUMNS, *keys]), tokens))
    parsed = df.select(*[
        (parse_bar_time(c, time_format, strict) if c == "date" else F.col(c)).alias(CSV_COLUMNS.get(c, c))
        for c in df.columns])
    # An unparsable date in non-strict mode becomes NULL and is dropped like any missing value.
    if not strict:
        parsed = parsed.filter(F.col("trade_timestamp").isNotNull())
    conform(parsed, RAW_BARS)  # fails on a missing column
    return parsed.select(*keys, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_BARS.fields])


def read_bars_csv(spark: SparkSession, path: str | Sequence[str], tokens: Sequence[str] = NA_TOKENS,
                  time_format: str = TIME_FORMAT, strict: bool = True, keys: Sequence[str] = (),
                  headers: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """The bars of one or many files.  Each file drops rows by its own columns: one that lacks a column
    of another file loses nothing by it."""
    groups = _text_groups(spark, path, [*CSV_COLUMNS, *keys], headers)
    return reduce(DataFrame.unionByName, [conform_bars(g, tokens, time_format, strict, keys) for g in groups])


# ---- every line with what became of it --------------------------------------------------------

#: Outcomes of a line: loaded, dropped for a missing value, or rejected for one of three reasons.
GOOD, MISSING, REJECTED = "good", "missing", ("fields", "time", "number")


def line_outcomes(lines: DataFrame, header: str, tokens: Sequence[str] = NA_TOKENS, time_format: str = TIME_FORMAT,
                  keys: Sequence[str] = ()) -> DataFrame:
    """``(file, line, outcome, keys, contract columns)`` of data lines (``file``, ``value``) under one
    header, in one pass.  ``fields``: more fields than the header; ``missing``: a missing value in any column (a short
    line too); ``time`` and ``number``: a value that cannot be read as such.  The contract columns of a line that is not
    good are NULL.  A quoted field must end on its line."""
    cols = header_columns(header)
    require_names(cols, [*CSV_COLUMNS, *keys])
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*cols, _CORRUPT]])
    fields = F.from_csv("line", schema.simpleString()[7:-1].replace(":", " "), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    # exploded, not selected: a filter on the outcome would else move below and parse the line once per field it names
    parsed = F.explode(F.when(F.trim("line") != "", F.array(fields)))
    df = lines.select("file", F.regexp_replace("value", "\r$", "").alias("line")).select("file", "line", parsed.alias("_f"))
    df = df.select("file", "line", *[F.when(F.col(f"_f.{c}").isin(list(tokens)), None).otherwise(F.col(f"_f.{c}")).alias(c) for c in cols],
                   F.col(f"_f.{_CORRUPT}").alias(_CORRUPT))
    types = {f.name: f.dataType for f in RAW_BARS.fields}
    value = {n: parse_bar_time(c, time_format, strict=False) if c == "date" else F.col(c).try_cast(types[n]) for c, n in CSV_COLUMNS.items()}
    any_null = lambda values: reduce(Column.__or__, [v.isNull() for v in values])
    outcome = (F.when(F.coalesce(_too_many(len(cols)), F.lit(False)), "fields").when(any_null([F.col(c) for c in cols]), MISSING)
               .when(value["trade_timestamp"].isNull(), "time")
               .when(any_null([value[n] for n in types if n != "trade_timestamp"]), "number").otherwise(GOOD))
    df = df.withColumn("outcome", outcome)
    good = F.col("outcome") == GOOD
    return df.select("file", "line", "outcome", *[F.when(good, F.col(k)).alias(k) for k in keys], *[F.when(good, value[n]).alias(n) for n in types])


def read_line_outcomes(spark: SparkSession, headers: dict[str, Sequence[str]], tokens: Sequence[str] = NA_TOKENS,
                       time_format: str = TIME_FORMAT, keys: Sequence[str] = ()) -> DataFrame:
    """``line_outcomes`` of the files of each header, without their header lines."""
    out = []
    for header, files in sorted(headers.items()):
        lines = spark.read.option("lineSep", "\n").text(list(files)).select(F.col("_metadata.file_path").alias("file"), "value")
        out.append(line_outcomes(lines.filter(F.regexp_replace("value", "\r$", "") != header), header, tokens, time_format, keys))
    return reduce(DataFrame.unionByName, out)
