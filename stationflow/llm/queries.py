"""Registered queries of the corpus operators: key -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stationflow.llm import align, chat, decontam, gam, lattice, lines, mixing, pieces, simhash, suffix, tokens, variants, warc
from stationflow.llm.common import ship
from stationflow.sources.bindings import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    def query(spark: SparkSession, d: str) -> DataFrame:
        ship(spark)
        return fn(spark, d)

    QUERIES[fn.__name__] = query
    return query


@register
def op10_quality_gam(spark, d):
    return gam.classify(table(spark, d, "documents"), table(spark, d, "labels"))


@register
def op2_simhash_gray_index(spark, d):
    return simhash.near_duplicates(table(spark, d, "documents"))


@register
def op6_prefix_decontamination(spark, d):
    return decontam.decontaminate(table(spark, d, "documents"), table(spark, d, "benchmark"))


@register
def op1_low_discrepancy_mix(spark, d):
    return mixing.mix_documents(table(spark, d, "documents"))


@register
def op9_token_parquet(spark, d):
    return tokens.encode_documents(table(spark, d, "documents"))


@register
def op4_crf_line_rules(spark, d):
    return lines.judge(table(spark, d, "documents"), table(spark, d, "labels"))


@register
def op5_relational_chat(spark, d):
    probe = spark.sql(
        "SELECT -1L AS conv_id, 0L AS turn, 'user' AS role, '</s>[INST] ok [/INST]' AS text "
        "UNION ALL SELECT -1L, 1L, 'assistant', '</s>[INST] ok [/INST]'"
    )
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.format_conversations(turns.unionByName(probe)))


@register
def op8_warc_salvage(spark, d):
    return warc.archive_pages(table(spark, d, "pages"))


@register
def op7_subword_lattice(spark, d):
    return lattice.score_documents(table(spark, d, "documents"))


@register
def op3_suffix_family(spark, d):
    return suffix.remove_repeats(table(spark, d, "documents"))


def encoded_and_decoded(docs: DataFrame) -> DataFrame:
    return pieces.digests(pieces.encode_documents(docs, ["doc_id"]))


@register
def op11_distinct_chunk_pieces(spark, d):
    return encoded_and_decoded(table(spark, d, "documents"))


@register
def op12_bloom_variants(spark, d):
    return variants.variants(table(spark, d, "documents"))


@register
def op13_token_alignment(spark, d):
    return align.align_documents(table(spark, d, "documents"))
