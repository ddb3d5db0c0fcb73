"""CSV files with records of several lines, read by as many tasks as they have splits.

Lines are read with Spark's text reader, which divides files anywhere. Whether
a split starts inside a quoted field follows from the number of quotes before it: every split
is counted (quotes, and the lines that could begin a record either way), the
counts are added up along each file, and a second reading then knows
where its records begin and how many came before. Records that cross splits are
put together from their pieces; they alone are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thumbwheel.session import scratch_path

SPLIT = ["file", "block"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, line`` in the order of the files; ``block`` is where the line's split starts."""
    read = spark.read.option("lineSep", "\n").text(path)
    return read.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
    )


def _runs(batch: pa.RecordBatch) -> list[tuple[int, int]]:
    """Where the rows of one split begin and end in a batch."""
    block = batch.column(1).to_numpy(zero_copy_only=False)
    file = batch.column(0).dictionary_encode().indices.to_numpy()
    cut = np.flatnonzero((block[1:] != block[:-1]) | (file[1:] != file[:-1])) + 1
    return list(zip([0, *cut.tolist()], [*cut.tolist(), len(block)]))


def _parity_before(quotes: np.ndarray, start: int) -> np.ndarray:
    """For every line whether it starts inside a quoted field."""
    return (start + np.cumsum(quotes) - quotes) % 2


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: quotes, and the records that begin in it if it starts outside or inside a quoted field."""
    current, totals = None, [0, 0, 0]

    def row() -> pa.RecordBatch:
        values = [[current[0]], [current[1]], *([t] for t in totals)]
        kinds = [pa.string(), pa.int64(), *[pa.int64()] * 3]
        names = [*SPLIT, "quotes", "outside", "inside"]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

    for batch in batches:
        for a, b in _runs(batch) if batch.num_rows else ():
            key = batch.column(0)[a].as_py(), batch.column(1)[a].as_py()
            if key != current:
                if current is not None:
                    yield row()
                current, totals = key, [0, 0, 0]
            quotes = batch.column(2).to_numpy()[a:b].astype(np.int64)
            filled = batch.column(3).to_numpy(zero_copy_only=False)[a:b].astype(bool)
            odd = _parity_before(quotes, totals[0])
            totals[0] += int(quotes.sum())
            totals[1] += int((filled & (odd == 0)).sum())
            totals[2] += int((filled & (odd == 1)).sum())
    if current is not None:
        yield row()


def split_starts(lines: DataFrame) -> DataFrame:
    """``file, block, inside, before, in_file``: the state a split starts in and the records before it in its file."""
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    filled = ~F.col("line").isin("", "\r")
    counted = lines.select(*SPLIT, quotes.alias("quotes"), filled.alias("filled")).mapInArrow(
        _count, "file string, block long, quotes long, outside long, inside long"
    )
    # One row per split meets here; the driver lists the same files.
    along = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    odd = F.coalesce(F.sum("quotes").over(along), F.lit(0)) % 2 == 1
    began = F.when(F.col("odd"), F.col("inside")).otherwise(F.col("outside"))
    placed = counted.withColumn("odd", odd).withColumn("began", began)
    return placed.select(
        *SPLIT, F.col("odd").alias("inside"),
        F.coalesce(F.sum("began").over(along), F.lit(0)).alias("before"), F.sum("began").over(whole).alias("in_file"),
    )


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and, where they cross a split, pieces of records (``whole`` false), in order."""
    current, parity, record, parts = None, 0, 0, []
    out: list[tuple] = []

    def finish(whole: bool) -> None:
        if parts:
            out.append((current[0], record, current[1], whole, "\n".join(parts)))
            parts.clear()

    def flush() -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
        columns = list(zip(*out)) or [[]] * 5
        out.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "record", "block", "whole", "text"]
        )

    began_here = False
    for batch in batches:
        for a, b in _runs(batch) if batch.num_rows else ():
            key = batch.column(0)[a].as_py(), batch.column(1)[a].as_py()
            if key != current:
                finish(whole=began_here and parity == 0)
                current, parity = key, int(batch.column(3)[a].as_py())
                # Counting from 1; a piece at the start belongs to the last record before the split.
                record, began_here = batch.column(4)[a].as_py(), False
            for line in batch.column(2).slice(a, b - a).to_pylist():
                if parity == 0:
                    finish(whole=began_here)
                    if line in ("", "\r"):
                        continue
                    record, began_here = record + 1, True
                parts.append(line)
                parity ^= line.count('"') & 1
                if parity == 0:
                    finish(whole=began_here)
                if len(out) >= 4096:
                    yield flush()
    finish(whole=began_here and parity == 0)
    yield flush()


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, record, in_file, text``: every record of the files at ``path``, numbered from 1 in its file.

    Records are separated by line ends outside of double quotes; a quote inside a field is
    written twice, as RFC 4180 has it, and fields that contain none may stand without.
    Empty lines between records are passed over. The header is record 1.
    """
    lines = _lines(spark, path)
    starts = split_starts(lines)
    known = lines.join(F.broadcast(starts), SPLIT).select(*SPLIT, "line", "inside", "before")
    out = scratch_path(spark, "csv-records")
    known.mapInArrow(_assemble, "file string, record long, block long, whole boolean, text string").write.parquet(out)
    pieces = spark.read.parquet(out)
    joined = (
        pieces.where("not whole").groupBy("file", "record")
        .agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("p"))
        .select("file", "record", F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"))
    )
    files = starts.select("file", "in_file").distinct()
    every = pieces.where("whole").select("file", "record", "text").unionByName(joined)
    # The line end that Windows writes has one more character, behind the record.
    text = F.when(F.col("text").endswith("\r"), F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    return every.join(F.broadcast(files), "file").select("file", "record", "in_file", text.alias("text"))
