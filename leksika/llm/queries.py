"""The queries opN_<name>, each its operator over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leksika.llm import additive, language, leaderboard, ngrams, packing, private, quality, ranked, simhash, topk, toxicity, urls
from leksika.llm import pieces as sentencepieces
from leksika.llm.common import table


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.digests(table(spark, sf_dir, "documents"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op9_additive_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return additive.nearest(table(spark, sf_dir, "embeddings"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.perplexities(table(spark, sf_dir, "documents"))


def op11_leaderboard_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaderboard.sale_boards(spark, sf_dir)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank_benchmark(spark, sf_dir)


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.find_private(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_top_k, op2_url_filter, op3_best_fit_packing, op4_quality_classifier, op5_language_id,
        op6_sentencepiece, op7_simhash_near_dedup, op8_toxicity, op9_additive_quantisation, op10_lm_scoring,
        op11_leaderboard_feed, op12_ranked_search, op13_pii,
    )
}

#: The others learn models, hash in ways that DuckDB lacks or use a tokenizer; tests hold them against brute force.
SQL: dict[str, str] = {"op1_exact_top_k": topk.SQL, "op11_leaderboard_feed": leaderboard.SQL, "op12_ranked_search": ranked.SQL}
