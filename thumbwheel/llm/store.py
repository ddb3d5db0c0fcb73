"""Intermediate tables in the shared work folder, removed when a job no longer needs them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from thumbwheel.session import remove_path, scratch_path


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables written for one job.

    ``keep(df, name)`` writes a table and reads it back, which cuts the lineage:
    a lost executor costs only the tasks that read it. ``drop(name)`` deletes a
    table that nothing reads any more, so that disk holds one generation at a time.
    """

    def __init__(self, spark: SparkSession, job: str):
        self.spark, self.root = spark, scratch_path(spark, job)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        # The table takes the place of the shuffle files behind it, which go when it is written.
        before = self.spark.conf.get(SHUFFLE_CLEANUP, "false")
        self.spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            self._write(df, name)
        finally:
            self.spark.conf.set(SHUFFLE_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def _write(self, df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            remove_path(self.spark, self.path(name))
