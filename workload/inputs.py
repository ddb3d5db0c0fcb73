"""Engine inputs derived from the given tables (recipes in FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thumbwheel.operators.reshape import message, neighbouring_replies
from thumbwheel.operators.rollouts import RolloutConfig

CONFIG = RolloutConfig(
    stop_id=1, eos_id=1, pad_id=0, kl_coef=0.0625, cliprange=0.2, missing_eos_penalty=1.0, k=2
)
MODELS = ("acme/base-2b", "acme/sft-2b", "acme/kto-2b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference pairs from neighbouring replies of ``conversations``."""
    # White space around the preferred reply: reading a reference has to strip it.
    base = neighbouring_replies(table(spark, sf_dir, "conversations")).withColumn(
        "chosen", F.concat(F.lit("\n "), "chosen", F.lit(" \t"))
    )
    dialogue = lambda reply: F.array(
        message("user", F.col("prompt")), message("assistant", F.col(reply))
    )
    quarters = lambda c: (F.length(c) % 21).cast("double") / 4
    return base.select(
        (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("example_id"),
        F.when(F.col("conv_id") % 10 == 0, "test").otherwise("train").alias("split"),
        F.concat(F.lit("p"), F.col("conv_id").cast("string")).alias("prompt_id"),
        "prompt",
        dialogue("chosen").alias("messages"),
        dialogue("chosen").alias("chosen"),
        dialogue("rejected").alias("rejected"),
        quarters("chosen").alias("score_chosen"),
        quarters("rejected").alias("score_rejected"),
    )


def thumbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unpaired feedback: labelled documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return docs.join(labels, "doc_id")


def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three models whose completion lists differ in length."""
    parts = (("pages", "page_id", "html"), ("documents", "doc_id", "text"), ("benchmark", "item_id", "text"))
    out = None
    for model, (name, key, text) in zip(MODELS, parts):
        one = table(spark, sf_dir, name).select(
            F.col(key).alias("ordinal"), F.lit(model).alias("model"), F.col(text).alias("text")
        )
        out = one if out is None else out.unionByName(one)
    return out


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One prompt per document: a request and the document's whole text."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ordinal"),
        F.concat(F.lit(" Describe "), "source", F.lit(":\n"), "text", F.lit("\t")).alias("prompt"),
    )


def raw_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One judge text per document: its own text, then a verdict of one of nine kinds.

    Kinds: plain A and B, tie, a mark before the phrase, no phrase, two phrases,
    white space around the mark, more text after it, and a mark that is none of
    the three. The three models take turns as candidates.
    """
    key = F.col("doc_id")
    said = F.element_at(
        F.array(
            *map(
                F.lit,
                (
                    " The answer is [[A]]", "The answer is [[B]] \t", "The answer is [[C]]",
                    "I prefer [[A]]. The answer is [[A]]", "no verdict",
                    "The answer is A? no. The answer is [[B]]", "The answer is \n\t [[A]] \n",
                    "short. The answer is [[B]] and more [[A]]", "The answer is [[D]]",
                ),
            )
        ),
        (key % 9 + 1).cast("int"),
    )
    model = lambda k: (
        F.when(k % 3 == 0, MODELS[0]).when(k % 3 == 1, MODELS[1]).otherwise(MODELS[2])
    )
    turn = F.length("text")
    return table(spark, sf_dir, "documents").select(
        key.alias("example_id"),
        model(turn).alias("model"),
        model(turn).alias("model_a"),
        model(turn + 1).alias("model_b"),
        F.concat(F.lit("\n "), "text", F.lit("\n"), said, F.lit("\n")).alias("raw"),
    )


def _steps(n: Column, f) -> Column:
    return F.transform(F.sequence(F.lit(0).cast("long"), n - 1), f)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.sum("l_partkey").alias("a"), F.sum("l_suppkey").alias("b"))
        .withColumn("n", F.col("a") % 5 + 4)
        .withColumn("rollout_id", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    )


def _dyadic(n: Column, start: Column, step: Column | int, mod: int, parts: int) -> Column:
    return _steps(n, lambda i: ((start + i * step) % mod + 1).cast("double") / parts)


def rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rollout per (order, line number); the order is the prompt, the line the sample."""
    a, b, n = F.col("a"), F.col("b"), F.col("n")
    negative = lambda values: F.transform(values, lambda x: -x)
    update = F.col("l_orderkey") % 16 + 1
    return _lines(spark, sf_dir).select(
        update.alias("update_id"),
        F.col("l_orderkey").alias("prompt_id"),
        (F.col("l_linenumber") - 1).cast("long").alias("sample_idx"),
        "rollout_id",
        _steps(n, lambda i: (F.lit(1) + (a + i * 7) % 11).cast("int")).alias("response"),
        negative(_dyadic(n, b, 3, 17, 16)).alias("logp"),
        negative(_dyadic(n, b, 5, 13, 16)).alias("ref_logp"),
        F.array(
            ((a % 9) - 4).cast("double") / 4, ((b % 7) - 3).cast("double") / 4
        ).alias("score"),
        (update * 30.0).alias("elapsed"),
        (F.lit(1.0) / (update * 4)).alias("lr"),
    )


def policy_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two optimisation epochs over every rollout, in other slots and with other values each time."""
    b, n, epoch = F.col("b"), F.col("n"), F.col("ppo_epoch")
    rows = _lines(spark, sf_dir).withColumn("ppo_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(1).cast("long"))))
    return rows.select(
        "rollout_id",
        "ppo_epoch",
        ((F.floor(F.col("l_orderkey") / 16).cast("long") + epoch) % 4).alias("minibatch"),
        ((F.col("l_linenumber") - 1 + epoch) % 2).cast("long").alias("microbatch"),
        F.transform(_dyadic(n, b + epoch, epoch * 2 + 11, 19, 16), lambda x: -x).alias("new_logp"),
        _dyadic(n, b + epoch * 3, 13, 10, 8).alias("token_entropy"),
    )


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as logits: four positions over a vocabulary of sixteen."""
    return (
        table(spark, sf_dir, "embeddings")
        .select("vec_id", F.posexplode("embedding").alias("d", "x"))
        .select(
            F.col("vec_id").alias("rollout_id"),
            F.floor(F.col("d") / 16).cast("long").alias("pos"),
            (F.col("d") % 16).cast("long").alias("token"),
            F.col("x").cast("double").alias("logit"),
            ((F.col("vec_id") + F.floor(F.col("d") / 16)) % 16).alias("chosen"),
        )
    )


def strided_logits(n: int) -> Column:
    """All embedding values as ``n`` logits: value i counts towards logit i mod n."""
    values = F.col("embedding").cast("array<double>")
    total = lambda j: F.aggregate(
        F.filter(values, lambda _, i: i % n == j), F.lit(0.0), lambda acc, x: acc + x
    )
    return F.array(*(total(j) for j in range(n)))


def feedback_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as thumbs-up, errors as thumbs-down, other events neither."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") == "purchase", True)
        .when(F.col("event_type") == "error", False)
        .alias("up"),
    )
