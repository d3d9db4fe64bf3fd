"""Corpus preparation: documents through filters, deduplication, sanitising and packing.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor
kept; all but the last return the columns of ``documents``. `run` writes every
stage to the shared folder and reads it back, so a lost executor costs a
re-read and no stage is computed twice. Tables that a stage stages go when its
result is written, and each stage's result when the next one's is.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.llm.common import fold, fresh, scratch, sent_if_small, staged, table
from strata.llm.jaccard_join import text_groups
from strata.llm.packing import pack_documents
from strata.llm.pii import sanitise
from strata.llm.quality_model import score_quality
from strata.llm.quality_rules import judge


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _meet(docs: DataFrame, rows: DataFrame, how: str, *parts: Column) -> DataFrame:
    """The rows of ``docs`` that ``rows`` names ("left_semi") or does not ("left_anti") by doc_id (null included), text_hash and further columns, which are ``parts`` in ``docs``."""
    names = [fresh(f"{c}_of_row", docs.columns) for c in rows.columns]
    rows = staged(rows.distinct().toDF(*names), "rows")
    strings = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in rows.dtypes if kind == "string"]
    rows = sent_if_small(rows, sum(strings, F.lit(0)))
    on = F.col("doc_id").eqNullSafe(F.col(names[0]))
    for part, name in zip((_text_hash(), *parts), names[1:]):
        on &= part == F.col(name)
    return docs.join(rows, on, how)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality classifier scores below one half, each row by its own text."""
    learn = fold(F.col("doc_id"), 3) != 1
    scored, _ = score_quality(docs, table(spark, sf_dir, "labels"), learn)
    return _meet(docs, scored.where("score < 0.5").select("doc_id", "text_hash"), "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the base rules or the certified cutoffs reject, each row by its own text and language."""
    judged = judge(docs, table(spark, sf_dir, "labels"))
    return _meet(docs, judged.where("not kept").select("doc_id", "text_hash", "stratum"), "left_anti", F.coalesce(F.col("lang").cast("string"), F.lit("")))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of every group of near duplicates: the smallest doc_id, one with a null only where all are null.

    Groups are of texts: different texts of one doc_id stay, equal ones don't.
    Texts without words are in no group and stay.
    """
    groups = text_groups(docs).where("component is not null")
    best = groups.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))).alias("best"))
    best = staged(best.select("component", "best.id", "best.hash"), "kept-rows")
    placed = groups.join(sent_if_small(best, 96), "component")
    kept = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    docs = _meet(docs, placed.where(~kept).select("doc_id", "text_hash"), "left_anti")
    again = placed.where(kept).groupBy("doc_id", "text_hash").count().where("count > 1").select("doc_id", "text_hash")
    hashed = fresh("text_hash", docs.columns)
    copies = _meet(docs, again, "left_semi").withColumn(hashed, _text_hash()).dropDuplicates(["doc_id", hashed]).drop(hashed)
    return _meet(docs, again, "left_anti").unionByName(copies)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and the terms that disclose it by their kinds; n_chars follows the new text."""
    clean = sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    packed = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicate),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: A learnt classifier and a fitted packing have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with scratch(spark) as results:
        before = None
        for name, stage in STAGES:
            with scratch(spark) as own:
                docs = own.kept(staged(stage(spark, docs, sf_dir), f"pipeline-{name}"))
            if before is not None:
                results.drop(before)
            before = docs
        return results.kept(docs)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
