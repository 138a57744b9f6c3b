from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs.count()]
    assert len(corpus_pipeline.STAGES) == 5
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == COLUMNS
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept.append(docs.count())
    assert kept[0] > kept[1] > kept[2] > kept[3] == kept[4] <= kept[5]
    texts = spark.read.parquet(str(tmp_path / "3"))
    assert texts.where(F.col("n_chars") != F.char_length("text")).count() == 0
    assert corpus_pipeline.run(spark, SF).count() == kept[5]


def test_empty_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
