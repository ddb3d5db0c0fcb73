"""A training corpus from raw documents.

``STAGES`` lists the stages; each takes the session, the documents that its
predecessor kept and the folder of the tables. All but the last return the columns
of ``documents``; the last returns where every token lies in the training sequences.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thumbwheel.llm.mixing import MixConfig, mix_documents
from thumbwheel.llm.neardup import SketchConfig, near_duplicates
from thumbwheel.llm.packing import pack_documents
from thumbwheel.llm.quality import quality_verdicts
from thumbwheel.llm.queries import MIX_TARGETS, labelled_domains
from thumbwheel.llm.substring import remove_repeats
from thumbwheel.llm.words import table
from thumbwheel.session import ensure_work_folder, scratch_path

#: Near copies share 80 % of their five-word shingles; 34 bands of 5 registers miss a pair at 80 % once in 700,000.
NEAR = SketchConfig(percent=80, bands=34, rows=5)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(fn: Stage) -> Stage:
    """A stage may be called on its own: a single-machine session gets a work folder first."""

    @wraps(fn)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ensure_work_folder(spark)
        return fn(spark, docs, sf_dir)

    return call


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules keep; null and empty texts go."""
    verdicts = quality_verdicts(docs, table(spark, sf_dir, "labels"), carry=COLUMNS[1:])
    return verdicts.where("kept").select(*COLUMNS)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, and one row of each document.

    Rows without a doc_id belong to no group and all stay.
    """
    kept = near_duplicates(spark, docs, NEAR).where("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.select(*COLUMNS).join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.where("doc_id is null").select(*COLUMNS))


@stage
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that occur earlier.

    A text that loses nothing keeps its white space, one that loses all its words goes.
    """
    named = docs.withColumn("whole", F.col("text"))
    cut = remove_repeats(spark, named, carry=["whole", "lang", "source"])
    text = F.when(F.col("n_removed") > 0, F.col("text")).otherwise(F.col("whole"))
    left = cut.where("n_words = 0 or n_removed < n_words").select("doc_id", text.alias("text"), "lang", "source")
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@stage
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the fitted mixture wants it, and at least once.

    Rows without a doc_id stay once.
    """
    labelled = labelled_domains(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    rates = mix_documents(spark, docs, labelled, MIX_TARGETS, MixConfig(least=1.0))
    copies = rates.groupBy("doc_id").agg(F.max("copies").alias("copies"))
    wanted = docs.join(copies.where("doc_id is not null"), "doc_id", "left")
    times = F.array_repeat(F.lit(1), F.coalesce("copies", F.lit(1)).cast("int"))
    return wanted.select(*COLUMNS, F.explode(times).alias("copy")).select(*COLUMNS)


@stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in full sequences."""
    return pack_documents(spark, docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicate removal", near_dedup),
    ("substring removal", substring_dedup),
    ("source mixing", source_mixing),
    ("packing", packing),
]

#: No SQL: quality and mixing fit models, packing tokenizes. tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read by the next."""
    ensure_work_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
