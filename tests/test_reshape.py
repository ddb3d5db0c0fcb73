import pytest
from pyspark.sql import functions as F

from helpers import plan
from thumbwheel import schemas
from thumbwheel.operators import reshape
from thumbwheel.plans import datasets
from workload import inputs

MSG = "array<struct<role:string,content:string>>"
PAIR = f"example_id long, split string, prompt string, chosen {MSG}, rejected {MSG}"


@pytest.fixture
def pairs(spark):
    rows = [
        (1, "train", "q1", [("user", "q1"), ("assistant", "good")], [("user", "q1")]),
        (2, "test", "q2", [("user", "q2"), ("assistant", " ok\t\n")], [("assistant", "bad")]),
    ]
    return spark.createDataFrame(rows, PAIR)


def test_unpivot_is_interleaved_and_labelled(pairs):
    out = reshape.pairs_to_unpaired(pairs).orderBy("example_id", "branch").collect()
    assert [(r.example_id, r.branch, r.label) for r in out] == [(1, 0, 1), (1, 1, 0), (2, 0, 1), (2, 1, 0)]
    assert out[1].completion == [("user", "q1")]


def test_label_types(pairs):
    out = reshape.pairs_to_unpaired(pairs, "bool")
    assert dict(out.dtypes)["label"] == "boolean"
    assert out.where("label").count() == 2
    with pytest.raises(ValueError):
        reshape.pairs_to_unpaired(pairs, "float")


def test_unpivot_doubles_rows_without_a_shuffle(spark, sf_dir, folder):
    path = f"{folder}/pairs"
    inputs.pairs(spark, sf_dir).write.parquet(path)
    stored = spark.read.schema(schemas.PAIRS).parquet(path)
    out = datasets.build_kto_dataset(stored)
    assert out.count() == 2 * stored.count()
    assert out.where("label").count() == stored.count()
    shown = plan(out)
    assert "Exchange" not in shown and "Python" not in shown
    assert "score_chosen" not in shown.split("ReadSchema")[1]


def test_keep_assistant_may_leave_nothing(pairs):
    out = reshape.keep_assistant(reshape.pairs_to_unpaired(pairs))
    sizes = {(r.example_id, r.branch): len(r.completion) for r in out.collect()}
    assert sizes == {(1, 0): 1, (1, 1): 0, (2, 0): 1, (2, 1): 1}


def test_reference_text_strips_and_tolerates_short_lists(pairs):
    out = pairs.select(
        reshape.reference_text(F.col("chosen")).alias("c"), reshape.reference_text(F.col("rejected")).alias("r")
    ).collect()
    assert [(r.c, r.r) for r in out] == [("good", None), ("ok", None)]


def test_drop_columns_names_missing_ones(pairs):
    with pytest.raises(ValueError, match="prompt_id"):
        reshape.drop_columns(pairs)


def test_prompt_to_chat(pairs):
    assert reshape.prompt_to_chat(pairs).first()["prompt"] == [("user", "q1")]


def test_repeat_prompts(spark):
    out = reshape.repeat_prompts(spark.range(3), 2)
    assert sorted((r.id, r.sample_idx) for r in out.collect()) == [(i, s) for i in range(3) for s in range(2)]
    with pytest.raises(ValueError):
        reshape.repeat_prompts(spark.range(1), 0)


def test_long_conversations_continue_on_further_rows(spark):
    turns = spark.range(10).select(
        F.lit(7).alias("c"), F.col("id").alias("t"), F.lit("user").alias("r"), F.col("id").cast("string").alias("x")
    )
    out = reshape.assemble_messages(turns, "c", "t", "r", "x", turns_per_row=4).orderBy("segment").collect()
    assert [[m.content for m in r.messages] for r in out] == [list("0123"), list("4567"), list("89")]
    whole = [m.content for r in out for m in r.messages]
    assert whole == [r.x for r in turns.orderBy("t").collect()]


def test_neighbouring_replies_spread_one_conversation(spark):
    roles = ["system", "user", "assistant", "user", "assistant", "assistant", "user", "assistant"]
    turns = spark.createDataFrame([(1, i, r, f"t{i}") for i, r in enumerate(roles)], "conv_id long, turn long, role string, text string")
    out = reshape.neighbouring_replies(turns)
    assert [(r.turn, r.prompt, r.chosen, r.rejected) for r in out.collect()] == [(1, "t1", "t2", "t4")]
    assert "Window" not in plan(out)
