"""The pipeline, stage by stage and as a whole."""

from __future__ import annotations

import zlib

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from armorica.llm import decontaminate


def test_stages(spark, tables, docs, token_file):
    from tokenizers import Tokenizer

    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(stage(spark, kept[-1], tables).cache())
    languages, single, clean, mixed, index = kept[1:]
    assert all(frame.columns == docs.columns for frame in kept[:-1])
    assert languages.count() == docs.count()
    assert single.count() < languages.count() and single.select("doc_id").distinct().count() == single.count()
    items = spark.read.parquet(f"{tables}/benchmark.parquet")
    gone = {row.doc_id for row in decontaminate.contaminated(single, items).filter(F.size("items") > 0).collect()}
    assert {row.doc_id for row in clean.collect()} == {row.doc_id for row in single.collect()} - gone
    words = sum(len(row.text.split()) for row in clean.collect())
    assert abs(sum(len(row.text.split()) for row in mixed.collect()) / words - 1.5) < 0.02
    assert all(row.n_chars == len(row.text) for row in mixed.collect())

    tokenizer = Tokenizer.from_file(token_file)
    crc = sorted(
        (row.doc_id, zlib.crc32(np.array(tokenizer.encode(row.text, add_special_tokens=False).ids + [2], "<u4").tobytes()))
        for row in mixed.collect()
    )
    rows = index.orderBy("start").collect()
    assert sorted((row.doc_id, row.ids_crc32) for row in rows) == crc
    assert [row.start for row in rows] == [0, *np.cumsum([row.n_tokens for row in rows])[:-1]]


def test_run_equals_its_stages(spark, tables, docs):
    step = docs
    for _, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, tables)
    whole = corpus_pipeline.run(spark, tables)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, step.collect()))


def test_odd_documents(spark, tables, odd_docs, no_docs):
    for rows in (odd_docs, no_docs):
        step = rows
        for _, stage in corpus_pipeline.STAGES:
            step = stage(spark, step, tables)
        assert step.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        step.collect()
