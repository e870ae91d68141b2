"""A training corpus from documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps with the
columns of ``documents``; the last one returns the index of the token files.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armorica.llm import decontaminate, langid, mixing, queries, simhash, tokens
from armorica.workspace import new_folder

# Documents are long: few of them make an Arrow batch, which bounds what a worker holds.
DOCS_PER_BATCH = 2_000
# Workers still hold what earlier stages left; the encoder remembers less than it does alone.
CACHED_SEGMENTS = 100_000


def _short_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", DOCS_PER_BATCH)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; null texts and texts without a letter go too."""
    _short_batches(spark)
    found = langid.identify(docs, queries.language_model(docs), out_col="_identified")
    return found.filter(~F.col("_identified.rejected")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document of the smallest id."""
    _short_batches(spark)
    return simhash.keep_one(docs, shingle_words=queries.SHINGLE_WORDS, max_distance=queries.MAX_DISTANCE)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item of the benchmark."""
    _short_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contaminated(docs, benchmark, out_col="_items")
    return found.filter(F.size("_items") == 0).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as they are taken, parts of documents cut out."""
    _short_batches(spark)
    return mixing.mixture(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; their index, read back: doc_id, start, n_tokens, ids_crc32."""
    _short_batches(spark)
    tokenizer = public_tokenizers.path(queries.TOKENIZER)
    path = tokens.write_tokens(docs, tokenizer, end_id=queries.END_ID, cached_segments=CACHED_SEGMENTS)
    return tokens.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("language identification", identify_language),
    ("SimHash near-duplicates", drop_near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("source mix", mix_sources),
    ("token ids", write_token_ids),
]

# Model fits, fingerprints and seeded choices have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "pipeline")
    for place, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{place}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
