"""Model calls as pluggable batch functions.

A function here is a *factory*: it runs once per task, loads whatever it needs
and returns a callable for one batch. Batches are pandas Series of at most
``BATCH_BYTES`` of input (or one row), so a task streams its partition and what it
holds depends neither on the rows nor on their length. Keys pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from thumbwheel.functions.text import judge_prompt, strip
from thumbwheel.operators.judging import read_verdicts
from thumbwheel.session import path_exists

TextFactory = Callable[[], Callable[[pd.Series], pd.Series]]
ScoreFactory = Callable[[], Callable[[pd.Series, pd.Series], pd.Series]]

#: A model gets so much input at a time. Spark's Arrow batches hold 10,000 rows, of whole texts far more.
BATCH_BYTES = 4 << 20


def _cut(batch: pa.RecordBatch, inputs: Sequence[str], size: int) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most ``size`` bytes in ``inputs``, or of one row; nothing is copied."""
    if batch.num_rows <= 1 or sum(batch.column(c).nbytes for c in inputs) <= size:
        yield batch
        return
    half = batch.num_rows // 2
    yield from _cut(batch.slice(0, half), inputs, size)
    yield from _cut(batch.slice(half), inputs, size)


def _map_column(
    df: DataFrame, inputs: Sequence[str], output: str, output_type: T.DataType, factory: Callable
) -> DataFrame:
    """Replace the input columns by ``factory()(*inputs)``."""
    kept = [f for f in df.schema.fields if f.name not in inputs]
    schema = T.StructType([*kept, T.StructField(output, output_type)])
    names = [f.name for f in kept]

    result = to_arrow_type(output_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = factory()
        for whole in batches:
            for batch in _cut(whole, inputs, BATCH_BYTES):
                out = call(*(batch.column(c).to_pandas() for c in inputs))
                columns = [*(batch.column(c) for c in names), pa.Array.from_pandas(pd.Series(out), type=result)]
                yield pa.RecordBatch.from_arrays(columns, [*names, output])

    return df.mapInArrow(run, schema)


def batch_generate(
    df: DataFrame, generate: TextFactory, prompt: str = "prompt", output: str = "text"
) -> DataFrame:
    """Stripped completions for prompts."""
    done = _map_column(df, [prompt], output, T.StringType(), generate)
    return done.withColumn(output, strip(F.col(output)))


def batch_judge(df: DataFrame, judge: TextFactory, instruction: str | None = None) -> DataFrame:
    """Judge (prompt, answer_a, answer_b) rows: prompt, call, cut, parse, winner.

    The judge prompt exists only between the projection and the call.
    """
    extra = {} if instruction is None else {"instruction": instruction}
    asked = df.withColumn(
        "judge_prompt",
        judge_prompt(F.col("prompt"), F.col("answer_a"), F.col("answer_b"), **extra),
    ).drop("prompt", "answer_a", "answer_b")
    return read_verdicts(_map_column(asked, ["judge_prompt"], "raw", T.StringType(), judge))


def batch_score(
    df: DataFrame, score: ScoreFactory, query: str = "query", response: str = "response"
) -> DataFrame:
    """Reward logits per (query, response)."""
    return _map_column(df, [query, response], "score", T.ArrayType(T.DoubleType()), score)


def run_in_parts(
    df: DataFrame, model: Callable[[DataFrame], DataFrame], path: str, key: str = "ordinal", parts: int = 16
) -> DataFrame:
    """``model(df)``, written to ``path`` part by part; what is there from an earlier run is not asked for again.

    ``model`` keeps ``key`` and gives a row for every row (``batch_generate`` or
    ``batch_judge`` with a model bound). Parts are ranges of the unique ``key`` and one
    job each, so a run that dies has lost no more than the part it was at: the rows of
    a part appear at its commit. A later run passes on the keys that are not there, new ones included.
    Rows with a NULL key cannot be told apart and take no part.
    """
    spark = df.sparkSession
    named = df.where(F.col(key).isNotNull())
    schema = model(named).schema
    known = spark.read.schema(schema).parquet(path) if path_exists(spark, path) else None
    todo = named if known is None else named.join(known.select(key), key, "left_anti")
    low, high = todo.agg(F.min(key), F.max(key)).first()
    if low is not None:
        width = -(-(high - low + 1) // parts)
        for start in range(low, high + 1, width):
            within = F.col(key).between(start, min(start + width - 1, high))
            part = named.where(within)
            if known is not None:
                part = part.join(known.where(within).select(key), key, "left_anti")
            model(part).write.mode("append").parquet(path)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
