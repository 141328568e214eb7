"""Queries of the operators and their DuckDB SQL, for ``__spark_entry__.py``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, chat, pii
from .common import table
from .decontamination import find_hits
from .exact_dedup import exact_groups
from .langid import identify
from .near_dedup import near_duplicates
from .page_text import main_text
from .quality import classify
from .spelling import spelling_variants
from .suffix_dedup import remove_repeats
from .token_counts import derived_edits, recount


#: The tokenizer's rank file and the pattern that cuts texts into words.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    terms = F.transform("terms", lambda s: F.struct(F.lit("term").alias("kind"), s["begin"].alias("begin"),
                                                    s["end"].alias("end")))
    counts = [F.expr(f"size(filter(base, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in pii.KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
                        pii.joined(F.concat("base", terms)).alias("spans"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4, threshold=80)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    added = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(said).alias("text"))
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    read = chat.read_back(chat.format_windows(given.unionByName(added)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    in_order = lambda c: F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("window", c))), lambda x: x[c]), "")
    return (read.select("conv_id", "window", F.size("turns").alias("n"), lines.alias("lines"),
                        F.array_join("targets", "").alias("loss"), "formatted_chars")
            .groupBy("conv_id")
            .agg(F.sum("n").alias("n_turns"), F.sha2(in_order("lines"), 256).alias("turns_sha256"),
                 F.length(in_order("loss")).cast("long").alias("loss_chars"),
                 F.sha2(in_order("loss"), 256).alias("loss_sha256"),
                 F.sum("formatted_chars").cast("long").alias("formatted_chars")))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    edits = derived_edits(F.col("doc_id"), F.col("text"), F.col("source"))
    return recount(docs.select("doc_id", "text", edits.alias("edits")), RANKS, PATTERN)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256",
                       (F.col("n_hit") > 0).alias("contaminated"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    taught = docs.filter(fold != 1).select("doc_id", "text", "lang")
    found = identify(docs, taught)
    return found.select("doc_id", (fold == 1).alias("held_out"), "lang_pred", "score")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"), "embedding", width=64, k=40, rounds=5, seed="2")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_pii": op3_pii,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_near_dedup": op5_near_dedup,
    "op6_chat_format": op6_chat_format,
    "op7_token_counts": op7_token_counts,
    "op8_decontamination": op8_decontamination,
    "op9_language_id": op9_language_id,
    "op10_quality": op10_quality,
    "op11_spelling": op11_spelling,
    "op12_page_text": op12_page_text,
    "op13_centroids": op13_centroids,
}

#: Only where SQL can express the operator over whole tables.
ORACLES: dict[str, str] = {
    "op4_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   translate(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS content
            FROM documents),
        g AS (
            SELECT content, first(doc_id ORDER BY n DESC, doc_id) AS keep_id, count(*) AS group_size
            FROM d GROUP BY content)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept,
               sha256(d.content) AS text_sha256
        FROM d JOIN g ON d.content = g.content""",
    "op13_centroids": centroids.ORACLE,
}
