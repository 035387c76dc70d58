"""Sharding by extendible hashing.

A document's place is the 60-bit hash of its id; a shard is a hash prefix.  The
directory starts from byte sums per cell of ``bits`` prefix bits, one aggregation.  A
prefix is a shard at the smallest depth at which it fits the limit, so only buckets over
the limit split on another bit.  Cells that are still too large are counted again, alone,
with more bits, until every shard fits.  Rows that share their whole hash (repeated or null
ids) cannot be parted by bits; a bucket of such rows over the limit is cut into pages.

Defined cases: a null id hashes as empty text; null and empty texts have 0 bytes;
repeated rows share a shard unless paged; one document over the limit is a shard of its own;
an empty table gives no rows; extra columns are ignored by ``assign_shards`` and kept by
``write_shards``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.llm.common import staged

HASH_BITS = 60
MAX_BYTES = 1 << 20
#: Prefix bits added when cells stay too large.
MORE_BITS = 8


def place(id_col: str) -> Column:
    """60-bit hash of an id as text: the first 15 hex digits of its MD5."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def leaf_depths(cells: DataFrame, low: int, high: int, max_bytes: int) -> DataFrame:
    """``cell, depth``: the smallest depth in ``[low, high]`` at which the cell's prefix
    fits; null where none does.  ``cells``: ``cell`` (``high`` bits), ``n_bytes``, ``n``."""
    up = cells.select("cell", "n_bytes", "n", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
    up = up.withColumn("prefix", F.expr(f"shiftright(cell, {high} - depth)"))
    fits = up.groupBy("depth", "prefix").agg(F.sum("n_bytes").alias("n_bytes"), F.sum("n").alias("n"))
    fits = fits.filter((F.col("n_bytes") <= max_bytes) | (F.col("n") == 1)).select("depth", "prefix", F.lit(True).alias("fits"))
    return (up.join(fits, ["depth", "prefix"], "left")
            .groupBy("cell").agg(F.min(F.when(F.col("fits"), F.col("depth"))).alias("depth")))


def with_shards(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_bytes: int = MAX_BYTES) -> DataFrame:
    """``_row`` (all columns of the document), ``_bytes``, ``_depth`` and ``_shard`` (prefix bits
    as text; a page number follows a dot)."""
    n_bytes = F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("bigint")
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), place(id_col).alias("_h"), n_bytes.alias("_bytes"))
    sizes = df.select("_h", "_bytes")
    total = sizes.agg(F.sum("_bytes")).first()[0] or 0
    low, bits = 0, min(HASH_BITS, math.ceil(math.log2(max(1, total / max_bytes))) + 4)
    df = df.withColumn("_depth", F.lit(None).cast("int"))
    while True:
        cell = F.expr(f"shiftright(_h, {HASH_BITS - bits})")
        cells = sizes.groupBy(cell.alias("cell")).agg(F.sum("_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("n"))
        depths = staged(leaf_depths(cells, low, bits, max_bytes), "directory")
        found = depths.select(F.col("cell").alias("_cell"), F.col("depth").alias("_found"))
        df = (df.withColumn("_cell", cell).join(found, "_cell", "left")
              .withColumn("_depth", F.coalesce("_depth", "_found")).drop("_cell", "_found"))
        over = depths.filter(F.col("depth").isNull()).select("cell")
        if bits == HASH_BITS or over.isEmpty():
            break
        # sizes of the cells still over the limit, counted again with more bits
        sizes = sizes.withColumn("cell", cell).join(over, "cell", "left_semi").select("_h", "_bytes")
        low, bits = bits + 1, min(HASH_BITS, bits + MORE_BITS)
    bits_text = F.expr(f"IF(_depth = 0, '', lpad(bin(shiftright(_h, {HASH_BITS} - _depth)), _depth, '0'))")
    df = df.withColumn("_shard", bits_text)
    return df if over.isEmpty() else paged(df, max_bytes)


def paged(df: DataFrame, max_bytes: int) -> DataFrame:
    """Buckets of equal hashes over the limit: pages of up to half the limit of running
    bytes (plus one row of at most as much), larger rows alone.  Pages are numbered within
    an input partition, so a hot id is spread over tasks."""
    half = max_bytes // 2
    df = df.withColumns({"_part": F.spark_partition_id(), "_big": F.col("_bytes") > half})
    rest = df.filter(F.col("_depth").isNull())
    w = Window.partitionBy("_h", "_part", "_big").orderBy(F.xxhash64("_h", "_bytes"))
    run = F.sum("_bytes").over(w.rowsBetween(Window.unboundedPreceding, -1))
    page = F.when(F.col("_big"), F.row_number().over(w)).otherwise(F.floor(F.coalesce(run, F.lit(0)) / half))
    name = F.expr(f"lpad(bin(_h), {HASH_BITS}, '0')")
    rest = rest.withColumn("_shard", F.concat_ws(".", name, F.col("_part"), F.col("_big").cast("int"), page.cast("bigint")))
    rest = rest.withColumn("_depth", F.lit(HASH_BITS))
    return df.filter(F.col("_depth").isNotNull()).unionByName(rest).drop("_part", "_big")


def assign_shards(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_bytes: int = MAX_BYTES) -> DataFrame:
    """Per document: ``doc_id, n_bytes, depth, shard``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = with_shards(rows, max_bytes=max_bytes)
    return out.select("_row.doc_id", F.col("_bytes").alias("n_bytes"), F.col("_depth").alias("depth"), F.col("_shard").alias("shard"))


def write_shards(docs: DataFrame, url: str, *, id_col: str = "doc_id", text_col: str = "text", max_bytes: int = MAX_BYTES) -> None:
    """Writes the documents as Parquet, one folder ``shard=b<bits>`` per shard; a column of
    the documents named ``shard`` would clash and is an error."""
    if "shard" in docs.columns:
        raise ValueError("documents have a column named shard")
    out = with_shards(docs, id_col=id_col, text_col=text_col, max_bytes=max_bytes)
    out = out.select("_row.*", F.concat(F.lit("b"), F.col("_shard")).alias("shard"))
    out.repartition("shard").write.partitionBy("shard").parquet(url)


ORACLE = f"""
WITH h AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS n_bytes,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h
  FROM documents
), up AS (
  SELECT d AS depth, h >> ({HASH_BITS} - d) AS prefix, sum(n_bytes) AS n_bytes, count(*) AS n
  FROM h, generate_series(0, 40) AS g(d) GROUP BY ALL
), leaf AS (
  SELECT h.doc_id, any_value(h.n_bytes) AS n_bytes, any_value(h.h) AS h, min(up.depth) AS depth
  FROM h, generate_series(0, 40) AS g(d)
  JOIN up ON up.depth = d AND up.prefix = h.h >> ({HASH_BITS} - d)
  WHERE up.n_bytes <= {MAX_BYTES} OR up.n = 1
  GROUP BY h.doc_id
)
SELECT doc_id, n_bytes, CAST(depth AS INTEGER) AS depth,
       CASE WHEN depth = 0 THEN '' ELSE right(lpad(bin(h), {HASH_BITS}, '0')[1:depth], CAST(depth AS BIGINT)) END AS shard
FROM leaf
"""
