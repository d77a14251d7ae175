"""The pipeline over the smallest tables: each stage against what it promises."""

from __future__ import annotations

import corpus_pipeline
from changeflow.llm.tables import written


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, left = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, small), name)
        assert docs.columns == columns
        left.append(docs.count())
    assert left[0] > left[1] >= left[2] >= left[3] == left[4]
    texts = [r.text.lower() for r in docs.collect()]
    assert len(set(texts)) == len(texts)
    assert corpus_pipeline.run(spark, small).count() == left[-1]
