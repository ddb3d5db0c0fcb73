import csv
import glob
import io

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import plan
from thumbwheel import schemas
from thumbwheel.session import scratch_path, work_root
from thumbwheel.sources import readers, split_csv, writers
from workload import inputs

TEXTS = ["plain", "", 'quote " and ""', "line\nbreak", "comma, \\ backslash", "  spaces  ", "é x", "nan", "a\tb"]


def test_csv_round_trip_keeps_order_and_empty_texts(spark, folder):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(200)]
    df = spark.createDataFrame(rows, "ordinal long, text string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    writers.export_completions_csv(df, f"{folder}/csv")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(glob.glob(f"{folder}/csv/*.csv")) > 1
    got = readers.read_completions(spark, f"{folder}/csv", "m").orderBy("ordinal").collect()
    assert [(r.ordinal, r.text) for r in got] == rows and {r.model for r in got} == {"m"}


def test_csv_from_pandas(spark, folder):
    import pandas as pd

    pd.DataFrame(TEXTS, columns=["Text"]).to_csv(f"{folder}/one.csv", index=False)
    got = readers.read_completions(spark, f"{folder}/one.csv", "m").orderBy("ordinal").collect()
    assert [r.text for r in got] == TEXTS


def test_parts_are_ordered_by_number(spark, folder):
    import os

    os.makedirs(f"{folder}/csv")
    for part, text in ((99999, "first"), (100000, "second"), (100001, "third")):
        with open(f"{folder}/csv/part-{part:05d}-x-c000.csv", "w") as f:
            f.write(f'Text\n"{text}"\n"{text} too"\n')
    got = readers.read_completions(spark, f"{folder}/csv", "m").orderBy("ordinal").collect()
    assert [(r.ordinal, r.text) for r in got] == list(
        enumerate(["first", "first too", "second", "second too", "third", "third too"])
    )


HARD = (
    'Text,Note\r\n"a\n""b"",\n",1\nplain,2\r\n\n"",3\n"\n\nc ""\n",4\n  spaced ,"x\ny"\n"last\r\nline",5'
)


def whole_file_read(text):
    """One task's read of the whole file; either kind of line end may end a record."""
    rows = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    return [r[0] for r in rows[1:]]


def placed_lines(data, cuts):
    """Lines as Spark's text reader deals them: a line is read by the split its start lies in, or ends at."""
    rows, at = [], 0
    for line in data.split(b"\n"):
        if at < len(data):
            rows.append(("f", max([0, *(c for c in cuts if c < at)]), line.decode()))
        at += len(line) + 1
    return rows


@pytest.mark.parametrize("batch", [1, 3, 100])
def test_records_of_several_lines_survive_a_cut_at_every_position(batch):
    data, want = HARD.encode(), whole_file_read(HARD)
    assert len(want) == 6 and want[0] == 'a\n"b",\n'
    for cuts in [(c,) for c in range(1, len(data))] + [tuple(range(1, len(data), k)) for k in (1, 2, 5, 9)]:
        rows = placed_lines(data, cuts)
        arrow = lambda names, *columns: [
            b for b in pa.table(dict(zip(names, map(list, zip(*columns))))).to_batches(batch)
        ]
        file, block, line = zip(*rows)
        counted = [(f, b, x.count('"'), x not in ("", "\r")) for f, b, x in rows]
        stats = pa.Table.from_batches(split_csv._count(iter(arrow("fbqn", *counted)))).to_pylist()
        quotes, before, starts = 0, 0, {}
        for s in stats:
            starts[s["block"]] = (quotes % 2 == 1, before)
            before += s["inside"] if quotes % 2 else s["outside"]
            quotes += s["quotes"]
        known = [(f, b, x, *starts[b]) for f, b, x in rows]
        pieces = pa.Table.from_batches(split_csv._assemble(iter(arrow("fblip", *known)))).to_pylist()
        records = {}
        for p in sorted(pieces, key=lambda p: (p["record"], p["block"])):
            assert not (p["whole"] and p["record"] in records), cuts
            records.setdefault(p["record"], []).append(p["text"])
        texts = ["\n".join(v).removesuffix("\r") for _, v in sorted(records.items())]
        assert sorted(records) == list(range(1, 8)), cuts
        assert [next(csv.reader(io.StringIO(t, newline="")))[0] for t in texts[1:]] == want, cuts


def test_spark_reads_them_in_small_splits(spark, folder):
    with open(f"{folder}/one.csv", "wb") as f:
        f.write(HARD.encode())
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30")
    try:
        rows = readers.read_completions(spark, f"{folder}/one.csv", "m").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [(r.ordinal, r.text) for r in sorted(rows)] == list(enumerate(whole_file_read(HARD)))


def test_a_large_csv_is_read_by_many_tasks(spark, folder):
    rows = [(i, f"line {i}\nsecond, \"line\" of {i}" * (i % 5 + 1)) for i in range(1500)]
    df = spark.createDataFrame(rows, "ordinal long, Text string")
    options = dict(header=True, quoteAll=True, quote='"', escape='"', emptyValue="")
    df.coalesce(1).sortWithinPartitions("ordinal").select("Text").write.options(**options).csv(f"{folder}/csv")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "12000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = split_csv._lines(spark, f"{folder}/csv")
        assert lines.rdd.getNumPartitions() > 8
        assert split_csv.split_starts(lines).where("inside").count() > 0
        got = readers.read_completions(spark, f"{folder}/csv", "m").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((r.ordinal, r.text) for r in got) == rows


def test_split_reads_one_partition(spark, sf_dir, folder):
    pairs = inputs.pairs(spark, sf_dir)
    pairs.write.partitionBy("split").parquet(f"{folder}/p")
    out = readers.load_split(spark, f"{folder}/p", "test", schemas.PAIRS)
    assert "PartitionFilters: [isnotnull(split" in plan(out)
    assert out.count() == pairs.where("split = 'test'").count() > 0


def test_adapter_layouts(spark):
    with pytest.raises(ValueError):
        readers.source_adapter(spark.range(1), "other")
    plain = spark.createDataFrame([(0, "p", " c "), (1, "p", "d")], "ordinal long, prompt string, completion string")
    assert [r.reference for r in readers.source_adapter(plain, "plain", n=1).collect()] == [" c "]


def test_nan_scores_fail_the_read(spark, folder):
    row = (1, 1, 0, 1, [1], [0.0], [0.0], [float("nan"), 1.0], 0.0, 0.0)
    spark.createDataFrame([row], schemas.ROLLOUTS).write.parquet(f"{folder}/r")
    with pytest.raises(Exception, match="NaN reward logit"):
        readers.read_rollouts(spark, f"{folder}/r").collect()


def test_duplicate_samples_are_reported(spark):
    df = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (1, 1, 1)], "update_id long, prompt_id long, sample_idx long")
    assert [tuple(r) for r in readers.duplicate_samples(df).collect()] == [(1, 1, 0, 2)]


def test_runs_are_there_once_however_often_they_are_written(spark, folder):
    one = spark.range(1).select(F.lit(0.5).alias("objective/kl"), F.lit(3).alias("eval_samples"))
    for run in ("first", "second", "second", "first"):
        writers.write_metrics(one, f"{folder}/m", run)
    rows = spark.read.parquet(f"{folder}/m").collect()
    assert len(rows) == 4 and {(r.run, r.metric): r.value for r in rows}[("second", "objective/kl")] == 0.5


def test_a_run_that_dies_leaves_what_was_there(spark, folder):
    frame = lambda x: spark.range(40).repartition(4).select("id", x.alias("kl"))
    writers.write_metrics(frame(F.lit(1.0)), f"{folder}/m", "run", ("id",))
    dying = F.when(F.col("id") == 39, F.raise_error(F.lit("killed")).cast("double")).otherwise(F.lit(2.0))
    with pytest.raises(Exception, match="killed"):
        writers.write_metrics(frame(dying), f"{folder}/m", "run", ("id",))
    assert {r.value for r in spark.read.parquet(f"{folder}/m").collect()} == {1.0}
    writers.write_metrics(frame(F.lit(3.0)), f"{folder}/m", "run", ("id",))
    assert [r.value for r in spark.read.parquet(f"{folder}/m").collect()] == [3.0] * 40


def test_a_comparison_made_again_replaces_its_rates(spark, folder):
    rates = spark.createDataFrame([("a/x", "b", 0.5), ("b", "c", 0.25)], "model_a string, model_b string, rate_b double")
    writers.write_win_rate(rates, f"{folder}/w", ("model_a", "model_b"))
    writers.write_win_rate(rates.where("rate_b > 0.3").withColumn("rate_b", F.lit(0.75)), f"{folder}/w", ("model_a", "model_b"))
    got = {(r.model_a, r.model_b): r.rate_b for r in spark.read.parquet(f"{folder}/w").collect()}
    assert got == {("a_x", "b"): 0.75, ("b", "c"): 0.25}


def test_a_micro_batch_that_is_repeated_replaces_itself(spark, folder):
    write = writers.write_metrics_batch(f"{folder}/m")
    for batch_id, value in ((0, 1.0), (1, 2.0), (1, 2.0)):
        write(spark.range(1).select(F.lit(value).alias("kl")), batch_id)
    assert sorted((r.run, r.value) for r in spark.read.parquet(f"{folder}/m").collect()) == [("batch-0", 1.0), ("batch-1", 2.0)]


def test_scratch_paths_are_fresh_and_in_the_shared_folder(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(work_root(spark)) and work_root(spark) == spark.conf.get("spark.checkpoint.dir")
