"""Registered queries of the corpus operators, each over its whole table with production parameters.

Only exact dedup has a DuckDB twin: noisy-or training, rank merges, flows, sketches, expectation-maximisation, space-filling
curves, p-values, Viterbi and SimHash have no SQL form that DuckDB runs on whole tables. ``tests/llm`` holds each
against a brute-force version or the public library instead.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm import (bpe, exact_dedup, html_extract, line_dedup, mixing, order_minhash, quality, secrets, sharding,
                           simhash_dedup, spelling_variants, token_alignment, toxicity)
from martforge.llm.common import read

RANKS = "byte_bpe_50k.tiktoken"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
REJECT = 0.7


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(toxicity.sample(docs, read(spark, sf_dir, "labels")))
    scored = toxicity.score(docs, model)
    spans = F.array_join(F.transform("offending", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= REJECT).cast("int").alias("predicted"), "n_offending", spans.alias("offending"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN).drop("text")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.against_next(read(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup(docs).select("doc_id", "n_lines", "n_removed", "text")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(read(spark, sf_dir, "documents"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    model = html_extract.train(html_extract.sample(pages))
    return html_extract.extract(pages.select("page_id", "url", "html"), model).drop("html")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(read(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return token_alignment.measure(docs, public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_bpe, op3_mixing, op4_order_minhash, op5_quality, op6_sharding,
                            op7_line_dedup, op8_secrets, op9_html, op10_simhash, op11_spelling, op12_token_alignment, op13_exact_dedup)}
ORACLE: dict[str, str] = {
    "op13_exact_dedup": """
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
                   FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) = 1 AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)""",
}
