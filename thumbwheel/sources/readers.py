"""Readers: named splits, source layouts, completion files, rollout logs."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thumbwheel import schemas
from thumbwheel.operators.reshape import reference_text
from thumbwheel.operators.selection import head_examples
from thumbwheel.sources.split_csv import csv_records

# Names of the source splits and of ours.
SPLIT_NAMES = {"train_prefs": "train", "test_prefs": "test"}


def load_split(
    spark: SparkSession, path: str, split: str, schema: T.StructType | None = None
) -> DataFrame:
    """One split of a table partitioned by ``split``; other partitions are not read."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).where(F.col("split") == split)


def split_union(
    sources: Mapping[str, DataFrame], rename: Mapping[str, str] = SPLIT_NAMES
) -> DataFrame:
    """Several sources as one table, tagged by split."""
    tagged = [df.withColumn("split", F.lit(rename.get(n, n))) for n, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def source_adapter(df: DataFrame, layout: str, n: int | None = None) -> DataFrame:
    """``(ordinal, prompt, reference)`` from either source layout.

    ``chosen_messages``: the stripped second message of ``chosen``.
    ``plain``: the ``completion`` column as it is.
    """
    if layout == "chosen_messages":
        reference = reference_text(F.col("chosen"))
    elif layout == "plain":
        reference = F.col("completion")
    else:
        raise ValueError(f"unknown layout {layout!r}")
    return head_examples(df.select("ordinal", "prompt", reference.alias("reference")), n)


def read_completions(spark: SparkSession, path: str, model: str) -> DataFrame:
    """A ``Text`` CSV (file or folder) as ``(ordinal, model, text)``.

    An ``Ordinal`` column, as ``export_completions_csv`` writes it, is taken as
    it is. Files without one are numbered by the part number in their name
    (parts count as integers, so part 100000 follows part 99999), then by path,
    then by position in the file. A quoted record may span lines, and files are
    divided among tasks wherever Spark divides them. All files have the
    header of the first. An empty completion stays an empty string.
    """
    options = dict(quote='"', escape='"', emptyValue="", nullValue="\u0000", multiLine=True)
    header = spark.read.options(header=True, **options).csv(path).columns
    schema = ", ".join(f"`{name}` string" for name in header)
    records = csv_records(spark, path)
    fields = F.from_csv("text", F.lit(schema), {k: str(v).lower() if v is True else v for k, v in options.items()})
    rows = records.where("record > 1").withColumn("__fields", fields)
    text = F.coalesce(F.col("__fields.Text"), F.lit("")).alias("text")
    if "Ordinal" in header:
        return rows.select(F.col("__fields.Ordinal").cast("long").alias("ordinal"), F.lit(model).alias("model"), text)
    part = F.regexp_extract("file", r"part-(\d+)[^/]*$", 1).try_cast("long")
    # One row per file; the driver lists the same files anyway.
    before = Window.orderBy(part.asc_nulls_last(), "file").rowsBetween(Window.unboundedPreceding, -1)
    files = records.groupBy("file").agg((F.max("in_file") - 1).alias("__n")).select(
        "file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    return rows.join(F.broadcast(files), "file").select(
        (F.col("__before") + F.col("record") - 2).alias("ordinal"), F.lit(model).alias("model"), text
    )


def read_rollouts(spark: SparkSession, path: str) -> DataFrame:
    """A rollout log; a NaN reward logit fails the read instead of winning every argmax."""
    df = spark.read.schema(schemas.ROLLOUTS).parquet(path)
    bad = F.exists("score", F.isnan)
    return df.withColumn(
        "score",
        F.when(bad, F.raise_error(F.lit("NaN reward logit")).cast("array<double>")).otherwise(
            F.col("score")
        ),
    )


def read_policy_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.POLICY_LOG).parquet(path)


def duplicate_samples(rollouts: DataFrame) -> DataFrame:
    """Samples logged more than once; an empty result means slots are well formed."""
    return (
        rollouts.groupBy("update_id", "prompt_id", "sample_idx")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
