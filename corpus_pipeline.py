"""From raw documents to token ids: quality, near duplicates, benchmark leaks, personal
data, tokens.

Every stage works on all documents that the one before kept.  ``run`` writes each stage's
result as Parquet into the shared folder and reads it back, so a lost executor costs at
most a part of one stage.

Defined cases: an empty table gives empty stages; without trusted positives every score is
0.5 and the first stage drops all; null and empty texts are scored like any text, are
linked with nothing, hold no passage and no personal data and have no tokens; of rows that
repeat id and text one stays, rows of one id with different texts are judged each; rows
with a null id stay unless the classifier rejects them; all columns of ``documents`` pass
through, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barline.llm.bpe import encode_decode
from barline.llm.common import scratch, table
from barline.llm.decontaminate import remove_leaks
from barline.llm.jaccard import keep_one
from barline.llm.pii import fit_span_model, mask_pii
from barline.llm.quality import fit_quality, keep_quality

#: Byte-level BPE ranks and the pattern that splits texts before the merges.
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return keep_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out of the texts."""
    return remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind."""
    return mask_pii(docs, fit_span_model(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the decoded bytes."""
    # workers go on to other stages, which need the memory
    return encode_decode(docs, RANKS, PATTERN, keep_ids=True, keep_coder=False)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: SQL has no form of the classifier's fit, the BPE merges or the masking model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        url = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(url)
        docs = spark.read.parquet(url)
    return docs
