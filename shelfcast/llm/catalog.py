"""The named queries of the text operators: each runs its operator over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    archives,
    decontaminate,
    langid,
    licenses,
    linededup,
    minhash,
    mixing,
    neighbours,
    repair,
    simhash,
    substrings,
    toxicity,
    turntrie,
)
from shelfcast.llm.oracle import LLM_ORACLE
from shelfcast.llm.rows import table
from shelfcast.session import checkpoint_folder

__all__ = ["LLM_ORACLE", "LLM_QUERIES"]


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_folder(spark)}/archives/{uuid.uuid4().hex}"
    archives.write_bundles(table(spark, sf_dir, "pages"), path)
    return archives.full_records(archives.index_bundles(spark, path))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = langid.learn_profiles(documents.filter(langid.learnable()))
    seen = langid.predict_language(documents.select("doc_id", "text"), profiles)
    return seen.select("row.doc_id", langid.held_out("row.doc_id").alias("held_out"), "lang_pred", "score")


def op6_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = linededup.remove_spread_lines(table(spark, sf_dir, "documents"))
    return cut.select("r.doc_id", "n_lines", "n_removed", F.md5("kept").alias("kept_md5"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents"), digest=True)
    return cut.withColumnRenamed("kept", "kept_sha256")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    fingerprint = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return rows.select("doc_id", fingerprint, "component_id")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turntrie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_neighbours": op1_neighbours,
    "op2_decontaminate": op2_decontaminate,
    "op3_archives": op3_archives,
    "op4_mixing": op4_mixing,
    "op5_language": op5_language,
    "op6_line_spread": op6_line_spread,
    "op7_toxicity": op7_toxicity,
    "op8_substrings": op8_substrings,
    "op9_simhash": op9_simhash,
    "op10_licenses": op10_licenses,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_repair": op12_repair,
    "op13_minhash": op13_minhash,
}
