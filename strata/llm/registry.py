"""Registered queries of the subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm.common import fold, table
from strata.llm.html_main import extract_main_text
from strata.llm.impact_search import exact_top_k
from strata.llm.jaccard_join import near_duplicates
from strata.llm.multiset_hash import fingerprint_edits
from strata.llm.oracles import oracle_sql  # noqa: F401
from strata.llm.packing import pack_documents
from strata.llm.piece_sampling import sample_digest
from strata.llm.pii import KINDS, find_private, render
from strata.llm.quality_model import score_quality
from strata.llm.quality_rules import judge
from strata.llm.spelling import group_variants
from strata.llm.sphere_clusters import cluster_embeddings
from strata.llm.token_files import read_token_files, write_token_files
from strata.llm.toxicity import fit_toxicity, score_toxicity
from strata.session import scratch_path

BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path(BYTE_BPE))
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op4_risk_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", *counts)


def op5_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_private(table(spark, sf_dir, "documents"))
    base = render(F.col("spans"))
    terms = F.transform("terms", lambda s: F.struct(F.lit("term").alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.array_remove(F.transform(kinds, lambda k: k == kind), False)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), F.concat_ws(",", F.nullif(base, F.lit("")), F.nullif(render(terms), F.lit(""))).alias("spans"))


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 3) == 1
    scored, _ = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn=~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 4) == 2
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels"), learn=~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "sentences")


def op9_adaptive_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_digest(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op11_sphere_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_embeddings(table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(table(spark, sf_dir, "documents"))


def op13_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_impact_search": op1_impact_search,
        "op2_token_files": op2_token_files,
        "op3_pattern_packing": op3_pattern_packing,
        "op4_risk_rules": op4_risk_rules,
        "op5_disclosure": op5_disclosure,
        "op6_quality_model": op6_quality_model,
        "op7_host_paths": op7_host_paths,
        "op8_toxicity": op8_toxicity,
        "op9_adaptive_prefixes": op9_adaptive_prefixes,
        "op10_piece_sampling": op10_piece_sampling,
        "op11_sphere_clusters": op11_sphere_clusters,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_multiset_hash": op13_multiset_hash,
    }
