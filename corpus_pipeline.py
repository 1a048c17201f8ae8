"""A corpus pipeline over the table documents: language, quality, near-duplicates, test items, pieces.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the
columns of documents.  Stages judge what their predecessor kept:

1. language: documents without letters, or in which no language holds two fifths, go;
2. quality: documents that the base rule or a learned rule rejects go;
3. near-duplicates: one document of each class stays, the one with the smallest id;
4. test items: documents that contain a benchmark item go;
5. pieces: every document that is left gets its ids and their number, and the text they give back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmedallion.llm.components import store
from flowmedallion.llm.decontaminate import keep_clean
from flowmedallion.llm.language import keep_known
from flowmedallion.llm.pieces import encode_texts
from flowmedallion.llm.quality import keep_good
from flowmedallion.llm.queries import piece_model
from flowmedallion.llm.registry import table
from flowmedallion.llm.simhash import keep_first


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_known(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first(docs)


def test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_texts(docs, piece_model()).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("test_items", test_items),
    ("pieces", pieces),
]

ORACLE_SQL = None
"""SQL has no form of the learned stages; tests compare the stages with brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
