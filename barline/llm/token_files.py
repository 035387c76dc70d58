"""Token-ID files: flat unsigned integers plus 64-bit document offsets.

Documents are range-partitioned by id; each task writes three files into the
shared folder and moves them into place when they are whole:

``part-N.bin``  token ids of its documents, one after the other (uint16 where the
                vocabulary allows it, else uint32, little-endian)
``part-N.idx``  uint64 offsets in tokens, one per document and the end
``part-N.doc``  int64 document ids, then one validity byte each

A small manifest (one row per part) gets the global bases by a prefix sum.  Readers
memory-map a part and slice it by its offsets.

Defined cases: null and empty texts give the end id alone; null ids sort first;
repeated ids stay separate documents, ordered by a hash of the text; extra columns
are ignored; an empty table gives an empty manifest.
"""

from __future__ import annotations

import zlib
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barline.llm.common import Codes, Numbers, map_file, per_worker, scratch, staged, text_rows, write_file

#: Distinct words remembered by one worker before it starts afresh.
CACHE_WORDS = 800_000
#: Bytes of text in one part (about; ranges of ids are cut by sampling).  A worker meets most
#: of its words again, so larger parts encode fewer words.
PART_BYTES = 48 << 20
MANIFEST = "part int, n_docs long, n_tokens long, dtype string"


class WordEncoder:
    """Encodes texts with the tokenizers library, each distinct word once.

    Holds for tokenizers whose pre-tokenizer never joins across ASCII white space
    and drops it; then a text's ids are its words' ids one after the other.
    ``lower`` says that the tokenizer lower-cases, so words that differ in the case of
    A-Z are one word here (not in texts with combining marks U+0300-U+037F, where
    composition comes before lower-casing)."""

    def __init__(self, tokenizer_path: str, dtype: str, lower: bool = False, cache_words: int = CACHE_WORDS):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(tokenizer_path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        self.dtype, self.lower, self.cache = dtype, lower, cache_words
        self.clear()

    def clear(self) -> None:
        self.numbers, self.codes = Numbers(), Codes()

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word; many words go through the library as one text, and the
        tokens' places in it tell the words apart."""
        import numpy as np
        e = self.tok.encode(" ".join(words), add_special_tokens=False)
        ids = np.array(e.ids, self.dtype).tobytes()
        ends = np.cumsum([len(w) + 1 for w in words])
        first = np.fromiter((a for a, _ in e.offsets), np.int64, len(e))
        cuts = (np.searchsorted(first, ends) * np.dtype(self.dtype).itemsize).tolist()
        return [ids[a:b] for a, b in zip([0, *cuts], cuts)]

    def words_of(self, text: str | None) -> list[bytes]:
        data = (text or "").encode("utf-8", "surrogatepass")
        return (data.lower() if self.lower and b"\xcc" not in data and b"\xcd" not in data else data).split()

    def encode(self, texts: list[str | None], end: bytes) -> tuple[memoryview, list[int]]:
        """The texts' ids one after the other, ``end`` after each, and where each ends (in bytes)."""
        import itertools

        import numpy as np
        if len(self.numbers) > self.cache:
            self.clear()
        if not self.numbers:  # number 0: the end of a text, which no word is
            self.numbers[b" "] = 0
            self.codes.extend([end])
        split = [[*self.words_of(t), b" "] for t in texts]
        try:
            numbers = np.fromiter(map(self.numbers.__getitem__, itertools.chain.from_iterable(split)), np.int64)
            new, self.numbers.new = self.numbers.new, []
            found = [ids for lo in range(0, len(new), 512) for ids in self.encode_words([w.decode("utf-8", "replace") for w in new[lo:lo + 512]])]
            self.codes.extend(found)
        except BaseException:
            self.clear()  # numbers without codes must not stay for the next task
            raise
        data, cuts = self.codes.joined(numbers, np.cumsum([0, *map(len, split)]))
        return data, cuts[1:]


def vocabulary_size(tokenizer_path: str) -> int:
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True)


def write_token_files(docs: DataFrame, tokenizer_path: str, *, end_id: int, lower: bool = False, url: str | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> tuple[str, DataFrame]:
    """Writes the files below ``url`` (default: a new path in the shared folder);
    returns it and the manifest with each part's ``base``."""
    spark = docs.sparkSession
    url = url or scratch(spark, "tokens")
    dtype = "<u2" if max(vocabulary_size(tokenizer_path), end_id + 1) <= 1 << 16 else "<u4"
    schema = pa.schema([("part", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("dtype", pa.string())])

    def write(batches):
        import numpy as np
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        # words met by the worker in earlier parts are known
        encoder = per_worker(("words", tokenizer_path, dtype, lower, end_id), lambda: WordEncoder(tokenizer_path, dtype, lower))
        end = np.array([end_id], dtype).tobytes()
        ids, valid, ends = [], [], []

        def chunks():
            total = 0
            for batch in batches:
                for lo in range(0, batch.num_rows, 1024):
                    rows = batch.slice(lo, 1024)
                    data, cuts = encoder.encode(rows.column(1).to_pylist(), end)
                    keys = rows.column(0).to_pylist()
                    ids.extend(0 if i is None else i for i in keys)
                    valid.extend(i is not None for i in keys)
                    ends.extend(total + c // len(end) for c in cuts)
                    total = ends[-1]
                    yield data

        name = f"{url}/part-{part:06d}"
        write_file(name + ".bin", chunks())
        if ids:
            write_file(name + ".idx", [np.array([0, *ends], "<u8").tobytes()])
            write_file(name + ".doc", [np.array(ids, "<i8").tobytes(), np.array(valid, np.uint8).tobytes()])
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(ids)], pa.int64()),
                                              pa.array([ends[-1]], pa.int64()), pa.array([dtype])], schema=schema)

    tie = F.xxhash64("text")
    rows = text_rows(docs, id_col, text_col)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ordered = rows.repartitionByRange(int(total) // PART_BYTES + 1, "doc_id", tie).sortWithinPartitions("doc_id", tie)
    manifest = staged(ordered.mapInArrow(write, MANIFEST), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    return url, manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("bigint"))


def read_token_files(spark: SparkSession, url: str, manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def read(batches):
        import numpy as np
        for batch in batches:
            for part, base, dtype in zip(*(batch.column(k).to_pylist() for k in range(3))):
                name = f"{url}/part-{part:06d}"
                tokens, at = map_file(name + ".bin").view(dtype), map_file(name + ".idx").view("<u8")
                n = len(at) - 1
                doc = map_file(name + ".doc")
                ids, valid = doc[:8 * n].view("<i8"), doc[8 * n:].astype(bool)
                for lo in range(0, n, 4096):
                    hi = min(n, lo + 4096)
                    crc = [zlib.crc32(tokens[int(a):int(b)].astype("<u4").tobytes())
                           for a, b in zip(at[lo:hi], at[lo + 1:hi + 1])]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.array(ids[lo:hi]), pa.int64(), mask=~valid[lo:hi]),
                        pa.array(at[lo:hi].astype(np.int64) + base),
                        pa.array(np.diff(at[lo:hi + 1]).astype(np.int64)),
                        pa.array(crc, pa.int64())], schema=schema)

    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = manifest.select("part", "base", "dtype").repartition(width, "part")
    return parts.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
