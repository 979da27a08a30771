"""The pipeline's stages against what each is to keep."""

import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from airloom.llm import near_dedup, pieces, quality
from airloom.llm.common import materialize
from airloom.llm.queries import QUERIES
from test_operators import components_of, shingles

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, FOLDER), name)
        kept.append({r["doc_id"]: r for r in docs.collect()})
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.dtypes == before.dtypes
    rules, near, clean, masked, ids = kept
    source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert set(rules) == {r["doc_id"] for r in quality.judge(source).filter("kept").collect()}
    top = components_of(
        {i: shingles(r["text"], near_dedup.STAGE_SHINGLE) for i, r in rules.items()},
        near_dedup.STAGE_PERCENT,
    )
    assert set(near) == {i for i, t in top.items() if i == t}
    assert set(clean) <= set(near) and set(masked) == set(clean) == set(ids)
    assert any("<email>" in r["text"] for r in masked.values())
    assert not any("@mail" in r["text"] for r in masked.values())
    assert all(r["round_trip"] for r in ids.values())


def documents(spark, n=20):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").limit(n)


@pytest.mark.parametrize("column", ["text", "lang", "doc_id"])
def test_nulls(spark, column):
    docs = documents(spark)
    docs = docs.withColumn(column, F.lit(None).cast(docs.schema[column].dataType))
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, FOLDER), name)
        # Documents without a text fail the base rules; a missing language or id decides nothing.
        assert docs.count() == 0 if column == "text" else docs.count() > 0
        if column == "doc_id" and name in ("minhash_near_dedup", "benchmark_decontamination"):
            assert docs.count() == before.count()


def test_empty_table(spark, tmp_path):
    docs = documents(spark).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, FOLDER), name)
        assert docs.count() == 0
    documents(spark).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name in ("op1_token_counts", "op2_benchmark_decontamination"):
        assert QUERIES[name](spark, str(tmp_path)).count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


INNER = (
    "key base instances added merged masked_to spans d k words lines n_words kept base_failed class_counts word_counts lang_ grams "
    "ref_lang p_words a b h root id component_id rep n_shingles s1 sketch bands samples item_id ids n_tokens round_trip email_found"
).split()


def test_columns_of_any_name_stay_as_they_are(spark):
    docs = documents(spark, 60)
    wide = docs
    for i, name in enumerate(INNER):
        wide = wide.withColumn(name, F.concat(F.lit(f"own {i} "), F.col("doc_id")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, out = stage(spark, docs, FOLDER), materialize(stage(spark, wide, FOLDER), name)
        assert out.columns == wide.columns
        own = [F.concat(F.lit(f"own {i} "), F.col("doc_id")) == F.col(c) for i, c in enumerate(INNER)]
        assert out.where(sum((x.cast("int") for x in own), F.lit(0)) < len(own)).isEmpty()
        assert sorted(map(tuple, out.select(*docs.columns).collect())) == sorted(map(tuple, plain.collect()))
    assert corpus_pipeline.STAGES[-1][1](spark, wide, FOLDER).count() == 60


def test_ids_are_those_of_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    docs = documents(spark)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert len(found) == 20
    assert all(r["ids"] == library.encode(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"]) for r in found)
