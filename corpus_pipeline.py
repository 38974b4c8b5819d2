"""From raw documents to packed training sequences: quality rules, language, near duplicates, packing.

Every stage takes (spark, docs, sf_dir) and returns a frame; all but the last keep every column of the
documents they keep, whatever the columns are called. `run` writes each stage's result as Parquet in the
shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide.llm import language, nearcopies, packing, quality, simhash
from slowtide.llm.common import numbered, pick
from slowtide.session import materialize

#: Documents whose language is less certain than this are rejected; even odds over few languages lie below it.
MIN_LANGUAGE_SCORE = 0.4


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and reach the likelihood threshold, fitted on `docs` itself."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    plain, at = numbered(docs)
    judged = quality.judge(plain, model, at["text"], tuple(plain.columns))
    return judged.filter("kept").select(*plain.columns).toDF(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages."""
    plain, at = numbered(docs)
    found = language.identify(plain, language.fit(docs), at["text"], tuple(plain.columns))
    accepted = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return found.filter(accepted).select(*plain.columns).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies, five-word shingles at a Jaccard of 0.8."""
    return simhash.one_of_each(docs, near=nearcopies.near_copies)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    import public_tokenizers

    return packing.pack(packing.pieces(pick(docs, "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("SimHash near-dedup", near_duplicates),
    ("best-fit packing", best_fit_packing),
]

#: Trained models, XXH64 and tokenizers are not SQL; tests compare the pipeline with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
