"""Registered queries of the operators: thin, whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from recoflow.llm import collocations, decontamination, hard_negatives, html_template, importance, kd_search, language_id, licenses, near_dup, packing, substring_dedup, tool_calls, toxicity
from recoflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {"op2_kd_tree_search": kd_search.ORACLE, "op4_license_digest": licenses.oracle(),
                           "op12_hard_negatives": hard_negatives.ORACLE, "op13_toivonen_collocations": collocations.ORACLE}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_tool_calls(spark, d):
    return tool_calls.link(*tool_calls.derived_calls(table(spark, d, "conversations")))


@query
def op2_kd_tree_search(spark, d):
    return kd_search.top_k(table(spark, d, "embeddings"))


@query
def op3_html_template(spark, d):
    return html_template.extract(table(spark, d, "pages")).select(
        F.col("rest.page_id").alias("page_id"), F.col("rest.url").alias("url"), "text", "n_chars")


@query
def op4_license_digest(spark, d):
    return licenses.scan(table(spark, d, "documents"))


@query
def op5_substring_dedup(spark, d):
    return substring_dedup.remove_repeats(table(spark, d, "documents")).select(
        F.col("rest.doc_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


@query
def op6_minhash_near_dedup(spark, d):
    return near_dup.near_duplicates(table(spark, d, "documents"))


@query
def op8_best_fit_packing(spark, d):
    return packing.pack(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_toxicity(spark, d):
    docs = table(spark, d, "documents")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    training = table(spark, d, "labels").where(fold != 1).select("doc_id", F.col("toxic").alias("label"))
    return toxicity.toxicity_scores(docs, training).select(
        "doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op9_importance_resampling(spark, d):
    return importance.sample_by_importance(table(spark, d, "documents"), table(spark, d, "labels"))


@query
def op10_qgram_decontamination(spark, d):
    return decontamination.matches(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op12_hard_negatives(spark, d):
    return hard_negatives.mine(hard_negatives.relabelled(table(spark, d, "embeddings")))


@query
def op13_toivonen_collocations(spark, d):
    return collocations.collocations(table(spark, d, "documents"))


@query
def op11_language_id(spark, d):
    docs = table(spark, d, "documents")
    held_out = language_id.held_out()
    found = language_id.identify(docs, docs.where(~held_out), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
