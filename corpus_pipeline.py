"""A training corpus from raw documents, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it
as Parquet and reads it again as the next one's docs. All but the last return
the columns of documents; n_chars follows the text.

1. toxicity: documents scored 0.3 or more go. The model learns from ``labels``.
2. line dedup: of lines that are nearly the same, the first stays.
3. near duplicates: of documents whose SimHashes are linked, one stays.
4. decontamination: documents that hold a window of a benchmark item go.
5. BPE: token ids, and a digest of what they decode to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, decontaminate, lines, simhash, toxicity
from tidewater.llm.common import load, materialise


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, load(spark, sf_dir, "labels"), toxicity.held_out())
    return toxicity.drop_toxic(docs, model)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = lines.drop_repeated_lines(docs, whole=True)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return out.select(docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_and_check(docs, *bpe.public_ranks())


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", without_near_copies),
    ("decontamination", without_benchmark),
    ("bpe", encoded),
]

# fingerprints, learned scores and merges are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
