"""A training corpus from `documents`: language, boilerplate, near-duplicates, benchmark passages, and the mix.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but the last return the
columns of documents. Each result is written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import decontaminate, families, langid, linededup, mixing, simhash
from shelfcast.llm.rows import table
from shelfcast.session import materialize

#: Words of a shingle, and bits in which the fingerprints of near-duplicates differ at most.
SHINGLE, BITS = families.SHINGLE, families.BITS


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that a profile was learned for.

    Texts that are null or have no letter go, and those that share no n-gram with any profile: their score is 0, that of
    the greatest possible distance, and they are in no learned language.
    """
    profiles = langid.learn_profiles(docs.filter(langid.learnable()))
    seen = langid.predict_language(docs, profiles)
    return seen.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") > 0)).select("row.*")


def remove_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that many sources share; their number of characters follows the text.

    Texts that fingerprints link count for one source together, so that a page that was copied to many sources, as it
    is or with small changes, keeps its own lines.
    """
    alike = families.near_duplicates(docs)
    cut = linededup.remove_spread_lines(docs, families=alike)
    new = {"text": F.col("kept"), "n_chars": F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("r.n_chars"))}
    return cut.select(*[
        new.get(field.name, F.col(f"r.`{field.name}`")).cast(field.dataType).alias(field.name) for field in docs.schema
    ])


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of texts that fingerprints link.

    A document without an id stays, as it cannot be told from others.
    """
    groups = simhash.near_duplicates(docs, width=SHINGLE, bits=BITS)
    gone = groups.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("__gone")).distinct()
    rows = docs.select(F.struct("*").alias("r"), F.col("doc_id").cast("long").alias("__id"))
    return rows.join(gone.hint("merge"), F.col("__id") == F.col("__gone"), "left_anti").select("r.*")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


STAGES = [
    ("language", keep_known_languages),
    ("line_spread", remove_boilerplate),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mix", mix_sources),
]

#: Profiles, fingerprints and apportionment are beyond SQL; tests compare the pipeline with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
