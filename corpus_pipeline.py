"""A training-corpus pipeline: five stages, each one operator of ``delivery_lake.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each result as
Parquet to the shared checkpoint folder and rereads it as the next stage's input, which cuts the
lineage, so a lost executor costs at most the stage it was in. All stages but the last return the
columns of ``documents``; the last adds the tokens.

1. language ID: documents without a recognised language go (no letter, or no likeness to any language);
2. SimHash near-dedup: one document of each group stays, that with the smallest id;
3. benchmark decontamination: words covered by benchmark phrases are cut from the texts;
4. secret scan: secrets are masked;
5. SentencePiece: every text is encoded; ``lossless`` says that its ids decode to the text.

Stages 3 to 5 keep every row. Null texts go in stage 1 (they have no letter); see the operators for
null ids, repeated rows and other cases."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from delivery_lake.llm import op1_sentencepiece, op2_secrets, op4_fm_index, op5_simhash, op7_langid
from delivery_lake.llm.common import documents
from delivery_lake.session import checkpoint_root


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op7_langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op5_simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op4_fm_index.remove_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op2_secrets.redact_secrets(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op1_sentencepiece.encode(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("sentencepiece", tokens),
]

#: No SQL: language ID, SimHash and SentencePiece can't be written in it (tested against brute force).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the last one's rows."""
    docs = documents(spark, sf_dir)
    root = f"{checkpoint_root(spark)}/corpus-{uuid.uuid4().hex[:12]}"
    for n, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{root}/{n}-{name}")
        docs = spark.read.schema(out.schema).parquet(f"{root}/{n}-{name}")
    return docs
