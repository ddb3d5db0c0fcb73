"""Writers. Tables are parquet with explicit keys; CSV is an export format only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thumbwheel.functions.text import model_slug
from thumbwheel.schemas import require_columns


def write_unpaired(df: DataFrame, path: str) -> None:
    """All splits, one folder per split."""
    require_columns(df, "split", "label")
    df.write.partitionBy("split").parquet(path)


def write_completions(df: DataFrame, path: str) -> None:
    """Completions with their ordinals, one folder per model slug."""
    require_columns(df, "ordinal", "model", "text")
    (
        df.withColumn("model_name", F.col("model"))
        .withColumn("model", model_slug(F.col("model")))
        .write.partitionBy("model")
        .parquet(path)
    )


def export_completions_csv(df: DataFrame, path: str) -> None:
    """One model's texts as ``Text`` CSV files in ordinal order, the ordinal beside each text."""
    (
        df.orderBy("ordinal")
        .select(F.col("text").alias("Text"), F.col("ordinal").alias("Ordinal"))
        .write.options(header=True, quoteAll=True, quote='"', escape='"', emptyValue="")
        .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )


def _commit(df: DataFrame, path: str, *keys: str) -> None:
    """Replace the folders of the keys that ``df`` has and leave all others: written twice, a key is there once.

    A job that is killed before its commit leaves what was there.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_win_rate(df: DataFrame, path: str, model_columns: tuple[str, ...]) -> None:
    """Win rates with file-safe model names, under the models compared: a comparison made again replaces its rates."""
    require_columns(df, *model_columns)
    for name in model_columns:
        df = df.withColumn(name, model_slug(F.col(name)))
    _commit(df.withColumn("comparison", F.concat_ws("__", *model_columns)), path, "comparison")


def write_metrics(df: DataFrame, path: str, run: str, keys: tuple[str, ...] = ()) -> None:
    """A wide metrics frame as ``(run, keys..., metric, value)`` rows; a run written again replaces its rows."""
    names = [c for c in df.columns if c not in keys]
    long = (
        df.select(*keys, *(F.col(f"`{n}`").cast("double").alias(n) for n in names))
        .unpivot(list(keys), [F.col(f"`{n}`") for n in names], "metric", "value")
        .withColumn("run", F.lit(run))
    )
    _commit(long, path, "run")


def write_bucketed(df: DataFrame, table: str, path: str, key: str = "rollout_id", buckets: int | None = None) -> None:
    """A log table laid out by ``key``: joins and groups by it need no shuffle when it is read.

    ``buckets`` follows ``spark.sql.shuffle.partitions`` unless given; tables that are to
    meet have the same number. The table is registered as ``table`` and lies at ``path``.
    """
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(table)


def write_metrics_batch(path: str, keys: tuple[str, ...] = ()):
    """For ``foreachBatch``: the metrics of a micro-batch under its number; a batch that is repeated replaces itself."""

    def write(df: DataFrame, batch_id: int) -> None:
        write_metrics(df, path, f"batch-{batch_id}", keys)

    return write
