import inspect
from collections import Counter

import corpus_pipeline
import pytest
from larkspur.llm.queries import QUERIES, SQL
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "simhash_near_dedup", "benchmark_decontamination",
        "best_fit_packing"]
    for _, stage in corpus_pipeline.STAGES:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]


def test_each_stage_works_on_what_the_one_before_kept(spark, documents):
    docs, left = documents, Counter(r.doc_id for r in documents.select("doc_id").collect())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).persist()
        assert docs.schema.names == documents.schema.names
        kept = Counter(r.doc_id for r in docs.select("doc_id").collect())
        assert not kept - left, name
        if name == "line_dedup":
            assert kept == left
        left = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(left)
    run = corpus_pipeline.run(spark, FOLDER)
    assert Counter(map(tuple, run.collect())) == Counter(map(tuple, packed.collect()))


def test_empty_table_and_nulls(spark, documents):
    none = documents.filter("false")
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", None, 0)],
                                documents.schema)
    for docs in (none, odd):
        for _, stage in corpus_pipeline.STAGES[1:]:
            out = stage(spark, docs, FOLDER)
            assert out.count() <= docs.count()
        assert corpus_pipeline.identify_language(spark, docs, FOLDER).count() == 0


def test_queries_without_sql():
    """A trained model, XXH64 fingerprints, a tokenizer or a notice search has no SQL form."""
    assert QUERIES.keys() - SQL.keys() == {
        "op1_secret_scan", "op2_decontamination", "op3_language", "op4_sharding", "op5_simhash",
        "op9_licenses", "op10_packing", "op13_lm_scoring"}
    assert corpus_pipeline.ORACLE_SQL is None


def test_any_column_names_pass(spark, documents):
    """Columns that operators add under names of their own may be in the table already."""
    own = {c: F.lit(i) for i, c in enumerate(
        ("n_lines", "kept_text", "n_dropped", "shard", "score", "lang_pred", "root"))}
    docs = documents.limit(40).withColumns(own)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).persist()
        assert docs.columns == [*documents.columns, *own]
        assert docs.filter("n_lines <> 0 OR kept_text <> 1").isEmpty()
