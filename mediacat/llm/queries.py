"""Queries of this subpackage over the given tables, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

import corpus_pipeline

from . import conversations, decontaminate, infill, language, line_dedup, lm, packing, passages, pieces, quality, simhash, token_counts, warc
from .tables import table

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return keep


@query()
def op1_simhash_near_copies(spark, sf_dir):
    found = simhash.near_copies(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query(line_dedup.SQL)
def op2_line_dedup(spark, sf_dir):
    found = line_dedup.without_shared_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


@query()
def op3_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


@query()
def op4_sentencepiece(spark, sf_dir):
    import public_tokenizers

    return pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])


@query()
def op5_quality_rules(spark, sf_dir):
    return quality.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])


@query(warc.SQL)
def op6_warc(spark, sf_dir):
    return warc.archived(table(spark, sf_dir, "pages"))


@query()
def op7_substring_dedup(spark, sf_dir):
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


@query()
def op8_token_counts(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path, keep=["doc_id"])


@query()
def op9_lm_scores(spark, sf_dir):
    import public_tokenizers

    return lm.score(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op10_benchmark_decontamination(spark, sf_dir):
    found = decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query()
def op11_conversation_repair(spark, sf_dir):
    return conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")))


@query(infill.SQL)
def op12_fill_in_middle(spark, sf_dir):
    return infill.transform(table(spark, sf_dir, "documents"))


@query()
def op13_best_fit_packing(spark, sf_dir):
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
