"""The operators as registered queries over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.llm import (
    grid_join, jaccard, language, mih, mixing, oracles, packing, pii, quality, sharding, spelling, toxicity, turns, url_rules,
)
from tallystream.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_skip_chain_pii(spark, sf_dir):
    return pii.report(table(spark, sf_dir, "documents"))


def op2_adaptive_jaccard(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op3_lexicon_toxicity(spark, sf_dir):
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_multi_index_hashing(spark, sf_dir):
    return mih.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_association_rules(spark, sf_dir):
    return url_rules.judge(table(spark, sf_dir, "pages"))


def op6_entropy_balancing(spark, sf_dir):
    return mixing.report(table(spark, sf_dir, "documents"))


def op7_label_propagation(spark, sf_dir):
    return sharding.report(table(spark, sf_dir, "documents"))


def op8_variable_best_fit(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_decision_list(spark, sf_dir):
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_subword_language(spark, sf_dir):
    return language.report(table(spark, sf_dir, "documents"))


def op11_reduced_neighbourhood(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_grid_order_join(spark, sf_dir):
    return grid_join.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_weighted_repair(spark, sf_dir):
    return turns.repair(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_skip_chain_pii": op1_skip_chain_pii,
    "op2_adaptive_jaccard": op2_adaptive_jaccard,
    "op3_lexicon_toxicity": op3_lexicon_toxicity,
    "op4_multi_index_hashing": op4_multi_index_hashing,
    "op5_association_rules": op5_association_rules,
    "op6_entropy_balancing": op6_entropy_balancing,
    "op7_label_propagation": op7_label_propagation,
    "op8_variable_best_fit": op8_variable_best_fit,
    "op9_decision_list": op9_decision_list,
    "op10_subword_language": op10_subword_language,
    "op11_reduced_neighbourhood": op11_reduced_neighbourhood,
    "op12_grid_order_join": op12_grid_order_join,
    "op13_weighted_repair": op13_weighted_repair,
}

# Learned models and message passing have no SQL; tests hold those queries against brute
# force, invariants or held-out labels.
ORACLES: dict[str, str] = oracles.ORACLES
