import hashlib

import pytest
from pyspark.sql import functions as F

from helpers import plan
from thumbwheel.operators import ordering, selection


def test_shuffle_is_a_fresh_permutation_per_epoch(spark):
    out = ordering.shuffle_batches(spark.range(1000), "id", seed=3, batch=64, micro_batch=16, epochs=2)
    rows = out.collect()
    order = {e: [r.id for r in sorted((r for r in rows if r.ppo_epoch == e), key=lambda r: r.position)] for e in (0, 1)}
    assert sorted(order[0]) == sorted(order[1]) == list(range(1000)) and order[0] != order[1]
    for e in (0, 1):
        assert order[e] == sorted(range(1000), key=lambda i: hashlib.md5(f"3:{e}:{i}".encode()).hexdigest())
    assert all(r.minibatch == r.position // 64 and r.microbatch == r.position % 64 // 16 for r in rows)


def test_shuffle_within_groups(spark):
    df = spark.range(300).withColumn("g", F.when(F.col("id") < 250, 0).otherwise(1))
    rows = ordering.shuffle_batches(df, "id", seed=3, batch=8, micro_batch=4, within=["g"]).collect()
    for g, n in ((0, 250), (1, 50)):
        assert sorted(r.position for r in rows if r.g == g) == list(range(n))


def test_no_data_row_meets_in_one_task(spark):
    df = spark.range(100)
    shown = plan(ordering.shuffle_batches(df, "id", seed=1, batch=8, micro_batch=4))
    assert "SinglePartition" not in shown


def stream(lengths, separator, block):
    """Brute force: the concatenated stream cut into full blocks."""
    tokens = [(d, i) for d, n in lengths for i in range(n + separator)]
    return {b: tokens[b * block : (b + 1) * block] for b in range(len(tokens) // block)}


@pytest.mark.parametrize("lengths", [
    [(d, (d * 37) % 23) for d in range(60)],
    [(0, 500), (1, 0), (2, 3), (3, 64)],
    [(0, 3)],
])
def test_packing_equals_brute_force(spark, lengths):
    df = spark.createDataFrame(lengths, "doc long, n long").repartition(5)
    spans = ordering.pack_sequences(spark, df, ["doc"], F.col("n"), block=32).collect()
    want = stream(lengths, 1, 32)
    got = {b: [] for b in want}
    for r in sorted(spans, key=lambda r: (r.block, r.doc)):
        got[r.block] += [(r.doc, i) for i in range(r.from_token, r.to_token)]
    assert got == want


def test_block_tokens_fill_every_block(spark):
    docs = spark.createDataFrame([(d, [d] * (d % 9)) for d in range(50)], "doc long, ids array<int>")
    docs = docs.unionByName(spark.createDataFrame([(50, list(range(100_000)))], docs.schema))
    sizes = docs.select("doc", (F.size("ids") + 1).cast("long").alias("n"))
    starts = ordering.running_offsets(spark, sizes, ["doc"], "n")
    out = {r.block: r.input_ids for r in ordering.block_tokens(starts, docs, ["doc"], "ids", block=16, eos=-1).collect()}
    flat = [t for d in range(50) for t in [d] * (d % 9) + [-1]] + [*range(100_000), -1]
    assert out == {b: flat[b * 16 : (b + 1) * 16] for b in range(len(flat) // 16)}


@pytest.mark.parametrize("side", ["left", "right"])
def test_pad_batch(spark, side):
    df = spark.createDataFrame([(i, list(range(1, 2 + i % 5))) for i in range(10)], "o long, ids array<int>")
    rows = {r.o: r for r in ordering.pad_batch(df, "ids", "o", 4, pad=0, side=side).collect()}
    for o, r in rows.items():
        real = list(range(1, 2 + o % 5))
        width = max(1 + x % 5 for x in range(10) if x // 4 == o // 4)
        fill = [0] * (width - len(real))
        assert r.ids == (real + fill if side == "right" else fill + real)
        assert sum(r.attention_mask) == len(real) and len(r.attention_mask) == width


def test_head_is_pushed_to_the_scan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = selection.head_examples(docs, 10, ordinal="doc_id", dense=True)
    assert "LessThan(doc_id,10)" in plan(out) and out.count() == 10
    assert selection.head_examples(docs, None) is docs
    with pytest.raises(ValueError):
        selection.head_examples(docs, 10**6, ordinal="doc_id", strict=True)


@pytest.mark.parametrize("keys", [range(1, 21), range(0, 100, 7), [3, 1, 50, 2, 40, 90]])
def test_head_takes_positions_of_any_keys(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "ordinal long").repartition(3)
    assert sorted(r.ordinal for r in selection.head_examples(df, 5).collect()) == sorted(keys)[:5]


def test_length_filter_is_inclusive_and_tokenizes_once(spark, sf_dir):
    df = spark.createDataFrame([(0, "a"), (1, "a b"), (2, "a b c"), (3, "")], "id long, t string")
    out = selection.max_length_filter(df, F.split("t", " "), 2)
    assert sorted((r.id, len(r.input_ids)) for r in out.collect()) == [(0, 1), (1, 2), (3, 1)]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    shown = plan(selection.max_length_filter(docs, F.split("text", " "), 2).select("doc_id", F.size("input_ids")))
    assert shown.count("split(text") == 1


def test_report_top_first_batch(spark):
    df = spark.range(100).withColumnRenamed("id", "ordinal")
    assert [r.ordinal for r in selection.report_top(df, n=5, first_batch_of=3).collect()] == [0, 1, 2]
