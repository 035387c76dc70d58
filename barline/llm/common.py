"""Helpers shared by the training-data operators.

Text conventions: ``lower-case`` means A-Z only, and the two word classes are
ASCII-delimited, so UTF-8 bytes can be split without decoding.
"""

from __future__ import annotations

import contextlib
import gc
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` on lower-cased bytes: everything below 0x80
#: except digits and a-z becomes a blank.
_KEEP = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
ALNUM_TABLE = bytes(c if c in _KEEP else 32 for c in range(256))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def blank_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as bytes; none for null."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def alnum_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text; none for null."""
    if not text:
        return []
    return text.encode("utf-8", "surrogatepass").lower().translate(ALNUM_TABLE).split()


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only id and text, under fixed names; other columns play no part."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def remainder(c: Column, by: int) -> Column:
    """crc32 of the id written as text, modulo ``by``; a null id counts as empty text."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % by


def per_row(df: DataFrame, fn, schema: str, *, names: list[str], types: list[pa.DataType]) -> DataFrame:
    """Applies ``fn(doc_id, text) -> tuple`` to each row of Arrow batches.

    ``fn`` is made per task by calling ``fn()`` once, so it can hold a cache."""
    out_schema = pa.schema(list(zip(names, types)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = fn()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1)
            for lo in range(0, len(ids), 512):
                rows = [one(i, t) for i, t in zip(ids[lo:lo + 512], texts.slice(lo, 512).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(col, t) for col, t in zip(zip(*rows), types)], schema=out_schema)

    return df.mapInArrow(run, schema)


# ---- arrays in SQL text ---------------------------------------------------------

#: Elements summed one by one (two to this power); whole runs of them are summed once.
_RUN = 7


def sums_before(t: str) -> str:
    """SQL: for each element of the int array ``t`` (a lambda variable) the sum of those before it.  Runs of 128 are
    summed first, so a long array costs some 64 steps an element, not one for every element before."""
    runs = f"transform(sequence(0, shiftright(size({t}) - 1, {_RUN})), b -> aggregate(slice({t}, b * {1 << _RUN} + 1, {1 << _RUN}), 0, (a, v) -> a + v))"
    starts = (f"aggregate({runs}, named_struct('at', 0, 'out', CAST(array() AS array<int>)), "
              "(a, v) -> named_struct('at', a.at + v, 'out', concat(a.out, array(a.at))), a -> a.out)")
    inside = f"aggregate(slice({t}, shiftright(i, {_RUN}) * {1 << _RUN} + 1, i & {(1 << _RUN) - 1}), 0, (a, v) -> a + v)"
    return (f"IF(size({t}) = 0, CAST(array() AS array<int>), "
            f"flatten(transform(array({starts}), o -> transform({t}, (v, i) -> o[shiftright(i, {_RUN})] + {inside}))))")


def last_before(array: str, condition: str) -> str:
    """SQL: the last element ``y`` of ``array`` for which ``condition`` (over ``y``) holds, NULL if it does for none; it must hold
    for a first part of the array only.  Found by halving."""
    mid = "shiftright(w.lo + w.hi, 1)"
    test = f"exists(array({array}[{mid}]), y -> {condition})"
    at = (f"aggregate(sequence(1, length(bin(size({array})))), named_struct('lo', 0, 'hi', size({array})), (w, k) -> "
          f"IF(w.lo >= w.hi, w, IF({test}, named_struct('lo', {mid} + 1, 'hi', w.hi), named_struct('lo', w.lo, 'hi', {mid}))), w -> w.lo)")
    return f"get({array}, {at} - 1)"


def per_worker(key: tuple, make):
    """``make()``, kept by the Python worker for its later tasks.  One object at a time, so
    another operator's does not add to it; a new worker makes its own."""
    import sys
    kept = sys.__dict__.setdefault("_barline_kept", {})
    if key not in kept:
        kept.clear()
        kept[key] = make()
    return kept[key]


class Numbers(dict):
    """Running number of each different item, from 0; ``new`` lists those not yet taken over."""

    def __init__(self):
        self.new: list = []

    def __missing__(self, item) -> int:
        n = self[item] = len(self)
        self.new.append(item)
        return n


class Codes:
    """One bytes value for each number, joined for runs of numbers in one gather."""

    def __init__(self):
        self.values = pa.array([], pa.large_binary())

    def extend(self, values: list[bytes]) -> None:
        if values:
            self.values = pa.concat_arrays([self.values, pa.array(values, pa.large_binary())])

    def joined(self, numbers, ends) -> tuple[memoryview, list[int]]:
        """The values of ``numbers`` one after the other, and the places where the runs that end
        before the ``ends`` end."""
        import numpy as np
        got = self.values.take(pa.array(numbers))
        at = np.frombuffer(got.buffers()[1], np.int64)[got.offset:got.offset + len(got) + 1]
        data = memoryview(got.buffers()[2] or b"").cast("B")[int(at[0]):int(at[-1])]
        return data, (at[np.asarray(ends, np.int64)] - at[0]).tolist()


# ---- shared folder -----------------------------------------------------------

def shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.  Where it is unset, a local
    session (tests) sets its own; a cluster session is an error, because a
    machine-local folder would lose data there."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    root = root or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="barline-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, for one run of one operator."""
    return f"{shared_root(spark)}/barline-llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: a lineage cut that
    outlives executors and keeps column pruning."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, url: str) -> None:
    """Removes a scratch path that no DataFrame in use reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(url)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of DataFrames that are out of use; it does so when
    the driver's JVM collects them, which may else be long after."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextlib.contextmanager
def shuffles_end_with_query(spark: SparkSession):
    """Queries made and run in here remove their shuffle files as they end, for results that lie in the
    shared folder or on the driver."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def open_fs(url: str):
    """``(pyarrow filesystem, path)`` of a shared folder."""
    from pyarrow import fs
    if url.startswith("file:"):
        return fs.LocalFileSystem(), "/" + url[5:].lstrip("/")
    if "://" not in url:
        return fs.LocalFileSystem(), url
    return fs.FileSystem.from_uri(url)


def write_file(url: str, parts: Iterable[bytes]) -> None:
    """Writes a file under a name of its own and moves it into place, so a
    repeated or speculative task leaves one whole file."""
    store, path = open_fs(url)
    store.create_dir(os.path.dirname(path), recursive=True)
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(tmp) as out:
        for p in parts:
            out.write(p)
    store.move(tmp, path)


def map_file(url: str):
    """A file of the shared folder as a memory-mapped byte array.  A store that
    cannot be mapped is copied to an unlinked temporary file first."""
    import mmap
    import shutil

    import numpy as np
    store, path = open_fs(url)
    if store.type_name == "local":
        if os.path.getsize(path) == 0:
            return np.zeros(0, np.uint8)
        return np.memmap(path, np.uint8, "r")
    with tempfile.TemporaryFile() as local, store.open_input_stream(path) as src:
        shutil.copyfileobj(src, local, 1 << 20)
        local.flush()
        if local.tell() == 0:
            return np.zeros(0, np.uint8)
        return np.frombuffer(mmap.mmap(local.fileno(), 0, access=mmap.ACCESS_READ), np.uint8)
