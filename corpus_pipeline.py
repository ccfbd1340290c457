"""From raw documents to packed training sequences, as stages that each read what the one before wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from beaconry.llm import linededup, packing, queries, setjoin
from beaconry.llm.store import materialise

# Documents of a lower score are rejected.
LEAST_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier doesn't reject; it learns from the labels of the table folder.

    A column ``quality_score`` that documents have already steps aside for the score and comes back as it was.
    """
    aside = "_given"
    while aside in docs.columns:
        aside += "_"
    scored = queries.quality_scores(docs.withColumnRenamed("quality_score", aside), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = scored.where(scored["quality_score"] >= LEAST_QUALITY)
    return kept.select(*[kept[f"`{aside}`"].alias(c) if c == "quality_score" else kept[f"`{c}`"] for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each long line stays in the first document that holds it; n_chars follows the text."""
    return linededup.dedup_lines(docs).selectExpr(*["cast(length(text) as bigint) as n_chars" if c == "n_chars" else f"`{c}`" for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    return setjoin.keep_one_each(docs)


def packing_(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2,048 ids: one row per piece of a document, with its ids."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [("quality", quality), ("line dedup", lines), ("n-gram Jaccard join", near_copies), ("packing", packing_)]
# The classifier's scores and the tokenizer are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each but the last written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
