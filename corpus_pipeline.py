"""From raw documents to packed sequences, in stages that each call one operator.

A stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read
again as the next stage's ``docs``. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import decontaminate, language, line_dedup, packing, simhash
from larkspur.llm.common import prepare
from larkspur.session import shared_folder


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough confidence; others go."""
    prepare(spark)
    return language.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that other documents keep; ``n_chars`` follows the text."""
    prepare(spark)
    left = "_llm_kept_text"
    cut = line_dedup.dedup_lines(docs, names=(left, "_llm_n_lines", "_llm_n_dropped"))
    columns = {"text": F.col(left)}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.length(left).cast(docs.schema["n_chars"].dataType)
    return cut.withColumns(columns).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link (three words, three bits)."""
    prepare(spark)
    return simhash.keep_one(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepare(spark)
    return decontaminate.drop_contaminated(
        docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces with places in sequences of 1024 tokens."""
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("best_fit_packing", pack),
]

#: Three of the stages (a trained classifier, XXH64 fingerprints, a tokenizer) have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            if not folder:
                docs = docs.persist()
                continue
            path = f"{folder.rstrip('/')}/stage-{i}-{name}-{uuid.uuid4().hex}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
