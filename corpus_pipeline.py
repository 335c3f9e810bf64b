"""The corpus pipeline: quality, near-duplicates, decontamination, mixing, token files.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which :func:`run` writes as Parquet and reads again as
the next stage's documents. All but the last return the columns of documents.

Nulls in any column, empty and very long texts, repeated rows, empty tables and
extra columns pass every stage; what each stage makes of them is said in its
operator's module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm import decontam, gam, mixing, simhash, tokens
from stationflow.llm.common import fresh, ship
from stationflow.session import materialize
from stationflow.sources.bindings import table

# The quality classifier and the tokenizer's files are not SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    ship(spark)
    model = gam.fit(docs, table(spark, sf_dir, "labels"))
    score = fresh("_score", docs.columns)
    return gam.with_score(docs, model, docs.columns, score).filter(F.col(score) >= gam.THRESHOLD).drop(score)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    ship(spark)
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    ship(spark)
    names = []
    for c in ("_words", "_hit", "_from", "_to", "_items"):
        names.append(fresh(c, [*docs.columns, *names]))
    found = decontam.find_contamination(docs, table(spark, sf_dir, "benchmark"), docs.columns, out=names)
    return found.filter(F.col(names[1]) == 0).drop(*names)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights, a row for each time a document is taken."""
    ship(spark)
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, as read back: doc_id, start, n_tokens, ids_crc32."""
    ship(spark)
    return tokens.encode_documents(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("tokenize", tokenize)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
