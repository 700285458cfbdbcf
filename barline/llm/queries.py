"""The corpus queries by name, ``(session, data folder) -> DataFrame``, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barline.llm import (
    classifier,
    exact,
    html,
    lattice,
    mixing,
    packing,
    pii,
    rules,
    sharding,
    simhash,
    trie,
    warc,
    whitening,
)
from barline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op1_pii(spark, folder):
    return pii.personal_data(table(spark, folder, "documents"))


@query
def op2_html_extraction(spark, folder):
    return html.main_texts(table(spark, folder, "pages"))


@query
def op3_warc(spark, folder):
    return warc.archived(table(spark, folder, "pages"))


ORACLE["op3_warc"] = warc.ORACLE


@query
def op4_simhash(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op5_packing(spark, folder):
    return packing.packed(table(spark, folder, "documents"))


@query
def op6_exact_dedup(spark, folder):
    return exact.exact_duplicates(table(spark, folder, "documents"))


ORACLE["op6_exact_dedup"] = exact.ORACLE


@query
def op7_sharding(spark, folder):
    return sharding.sharded(table(spark, folder, "documents"))


@query
def op8_quality_rules(spark, folder):
    return rules.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op9_mixing(spark, folder):
    return mixing.mixed(table(spark, folder, "documents"))


ORACLE["op9_mixing"] = mixing.ORACLE


@query
def op10_quality_classifier(spark, folder):
    return classifier.quality_scores(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    )


@query
def op11_conversation_trie(spark, folder):
    return trie.prefix_trie(table(spark, folder, "conversations"))


ORACLE["op11_conversation_trie"] = trie.ORACLE


@query
def op12_embedding_dedup(spark, folder):
    return lattice.near_duplicates(table(spark, folder, "embeddings"))


ORACLE["op12_embedding_dedup"] = lattice.ORACLE


@query
def op13_embedding_whitening(spark, folder):
    return whitening.whitened(table(spark, folder, "embeddings"))
