"""Every operator as a query over the given tables. Results have scalar columns only."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thumbwheel import schemas
from thumbwheel.functions import rollout as R
from thumbwheel.functions import text as X
from thumbwheel.functions import tokens as K
from thumbwheel.operators import inference, judging, kto, metrics, ordering, pairing, reshape
from thumbwheel.operators import rollouts as RO
from thumbwheel.operators import selection, skew
from thumbwheel.plans import datasets, evaluation, training_log
from thumbwheel.session import release_shuffles, remove_path, scratch_path
from thumbwheel.sources import readers, writers
from thumbwheel.streaming import feedback
from workload import inputs as I
from workload import judges
from workload.inputs import CONFIG as CFG

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def ids_text(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), ",")


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Round the named columns, or all doubles, to six places (after exp, ln or a mean)."""
    picked = names or [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.select(*(r6(f"`{c}`").alias(c) if c in picked else F.col(f"`{c}`") for c in df.columns))


# --- sources and sinks -------------------------------------------------------


@query
def load_split(spark, d):
    path = scratch_path(spark, "pairs")
    I.pairs(spark, d).write.partitionBy("split").parquet(path)
    train = readers.load_split(spark, path, "train", schemas.PAIRS)
    return train.select(
        "example_id", "split", "prompt_id", "prompt", "score_chosen", "score_rejected"
    )


@query
def split_union(spark, d):
    docs = I.table(spark, d, "documents").select(F.col("doc_id").alias("example_id"), "text")
    pages = I.table(spark, d, "pages").select(
        F.col("page_id").alias("example_id"), F.col("html").alias("text")
    )
    return readers.split_union({"train_prefs": docs, "test_prefs": pages})


@query
def source_adapter(spark, d):
    chosen = I.pairs(spark, d).withColumn("ordinal", F.col("example_id"))
    plain = I.table(spark, d, "documents").select(
        F.col("doc_id").alias("ordinal"), F.col("source").alias("prompt"), F.col("text").alias("completion")
    )
    tagged = lambda df, layout: readers.source_adapter(df, layout).withColumn("layout", F.lit(layout))
    return tagged(chosen, "chosen_messages").unionByName(tagged(plain, "plain"))


@query
def assemble_messages(spark, d):
    conv = I.table(spark, d, "conversations")
    out = reshape.assemble_messages(conv, "conv_id", "turn", "role", "text", turns_per_row=8)
    return out.select(
        "conv_id",
        "segment",
        F.size("messages").cast("long").alias("n_messages"),
        reshape.messages_text(F.col("messages")).alias("rendered"),
    )


@query
def read_completions(spark, d):
    path = scratch_path(spark, "completions-csv")
    docs = I.table(spark, d, "documents").select(F.col("doc_id").alias("ordinal"), "text")
    writers.export_completions_csv(docs, path)
    return readers.read_completions(spark, path, I.MODELS[0])


@query
def read_completions_unnumbered(spark, d):
    """Texts of several lines from files without an ordinal column, numbered by place."""
    path = scratch_path(spark, "completions-csv")
    docs = I.table(spark, d, "documents").select("doc_id", F.col("text").alias("Text"))
    options = dict(header=True, quoteAll=True, quote='"', escape='"', emptyValue="")
    kept = dict(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    docs.orderBy("doc_id").select("Text").write.options(**options, **kept).csv(path)
    return readers.read_completions(spark, path, I.MODELS[0])


@query
def write_unpaired(spark, d):
    path = scratch_path(spark, "unpaired")
    writers.write_unpaired(datasets.build_unpaired_dataset(I.pairs(spark, d)), path)
    return spark.read.parquet(path).select(
        "example_id",
        "branch",
        "split",
        "label",
        reshape.messages_text(F.col("completion")).alias("completion"),
    )


@query
def write_completions(spark, d):
    path = scratch_path(spark, "completions")
    writers.write_completions(I.completions(spark, d), path)
    return spark.read.parquet(path).select("ordinal", "model", "model_name", "text")


@query
def write_win_rate(spark, d):
    path = scratch_path(spark, "win-rates")
    rates = judging.win_rate_1v1(judging.read_verdicts(I.raw_verdicts(spark, d)))
    # Written twice: a comparison made again replaces its rates.
    writers.write_win_rate(rates.withColumn("rate_a", F.lit(0.0)), path, ("model_a", "model_b"))
    writers.write_win_rate(rates, path, ("model_a", "model_b"))
    return rounded(spark.read.parquet(path).drop("comparison"))


@query
def write_metrics(spark, d):
    path = scratch_path(spark, "metrics")
    feedback_rows = I.thumbs(spark, d)
    logits = F.array((F.length("text") % 5).cast("double"), (F.length("text") % 3).cast("double"))
    evaluated = metrics.accuracy(feedback_rows, logits, F.col("label"), ["lang"])
    counted = evaluated.withColumnRenamed("n", "eval_samples")
    # A retried job writes its run again.
    writers.write_metrics(counted, path, "pointwise", ("lang",))
    writers.write_metrics(counted, path, "pointwise", ("lang",))
    return rounded(spark.read.parquet(path).select("run", "lang", "metric", "value"))


# --- projections, reshaping, chat formatting ---------------------------------


@query
def drop_columns(spark, d):
    out = reshape.drop_columns(I.pairs(spark, d))
    return out.select(
        *(c for c in out.columns if c not in ("chosen", "rejected")),
        reshape.messages_text(F.col("chosen")).alias("chosen"),
        reshape.messages_text(F.col("rejected")).alias("rejected"),
    )


@query
def prompt_to_chat(spark, d):
    out = reshape.prompt_to_chat(I.pairs(spark, d))
    return out.select("example_id", reshape.messages_text(F.col("prompt")).alias("prompt"))


def _unpaired_scalars(df: DataFrame) -> DataFrame:
    return df.select(
        "example_id",
        "branch",
        "split",
        reshape.messages_text(F.col("prompt")).alias("prompt"),
        reshape.messages_text(F.col("completion")).alias("completion"),
        F.size("completion").cast("long").alias("n_messages"),
        "label",
    )


@query
def pairs_to_unpaired(spark, d):
    out = reshape.pairs_to_unpaired(reshape.drop_columns(I.pairs(spark, d)))
    return out.select(
        "example_id",
        "branch",
        "split",
        "prompt",
        reshape.messages_text(F.col("completion")).alias("completion"),
        "label",
    )


@query
def keep_assistant(spark, d):
    conv = I.table(spark, d, "conversations")
    windows = reshape.assemble_messages(conv, "conv_id", "turn", "role", "text", turns_per_row=8)
    out = reshape.keep_assistant(windows, "messages")
    return out.select(
        "conv_id",
        "segment",
        F.size("messages").cast("long").alias("n_messages"),
        reshape.messages_text(F.col("messages")).alias("rendered"),
    )


@query
def assistant_turns(spark, d):
    turns = reshape.assistant_turns(I.table(spark, d, "conversations"))
    return turns.select("conv_id", "turn", F.concat("role", F.lit("="), "text").alias("rendered"))


@query
def build_kto_dataset(spark, d):
    return _unpaired_scalars(datasets.build_kto_dataset(I.pairs(spark, d)))


@query
def build_unpaired_dataset(spark, d):
    return _unpaired_scalars(datasets.build_unpaired_dataset(I.pairs(spark, d)))


@query
def reference_text(spark, d):
    return I.pairs(spark, d).select(
        "example_id", reshape.reference_text(F.col("chosen")).alias("reference")
    )


@query
def render_chat(spark, d):
    return I.pairs(spark, d).select("example_id", X.render_chat(F.col("chosen")).alias("text"))


@query
def render_simple_chat(spark, d):
    return I.pairs(spark, d).select(
        "example_id", X.render_simple_chat(F.col("rejected")).alias("text")
    )


@query
def label_names(spark, d):
    named = I.thumbs(spark, d).select("doc_id", X.label_name(F.col("label")).alias("label_name"))
    return named.withColumn("label_id", X.label_id(F.col("label_name")))


@query
def repeat_prompts(spark, d):
    return reshape.repeat_prompts(I.prompts(spark, d), 2)


# --- filters, limits, sampling, batching -------------------------------------


@query
def head_examples(spark, d):
    return selection.head_examples(I.prompts(spark, d), 150)


@query
def eval_sample(spark, d):
    return selection.eval_sample(I.prompts(spark, d))


@query
def max_length_filter(spark, d):
    docs = I.table(spark, d, "documents").select("doc_id", "text")
    short = selection.max_length_filter(docs, K.words(F.col("text")), 2048, "words")
    return short.select("doc_id", F.size("words").cast("long").alias("n_tokens"))


@query
def drop_error_verdicts(spark, d):
    judged = judging.read_verdicts(I.raw_verdicts(spark, d))
    return selection.drop_error_verdicts(judged).select("example_id", "verdict", "winner")


@query
def shuffle_batches(spark, d):
    orders = I.table(spark, d, "orders").select("o_orderkey")
    return ordering.shuffle_batches(orders, "o_orderkey", seed=7, batch=64, micro_batch=8, epochs=2)


@query
def shuffle_within_updates(spark, d):
    rollouts = I.rollouts(spark, d).select("update_id", "rollout_id")
    return ordering.shuffle_batches(
        rollouts, "rollout_id", seed=7, batch=64, micro_batch=8, within=["update_id"]
    )


@query
def report_top(spark, d):
    report = completions_report(spark, d).withColumnRenamed("rollout_id", "ordinal")
    return selection.report_top(report, n=5)


# --- token sequences ---------------------------------------------------------


@query
def tokenize(spark, d):
    docs = I.table(spark, d, "documents").select("doc_id", K.token_ids(F.col("text")).alias("ids"))
    return docs.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.aggregate("ids", F.lit(0).cast("long"), lambda acc, x: acc + x).alias("id_sum"),
        F.get("ids", F.lit(0)).alias("first_id"),
        F.get("ids", F.size("ids") - 1).alias("last_id"),
    )


@query
def tokenize_plugin(spark, d):
    """A tokenizer plugged in as a pandas UDF; it gives the ids of the built-in one."""
    plugged = F.pandas_udf(judges.crc_tokenizer, "array<int>")
    docs = I.table(spark, d, "documents").select("doc_id", plugged("text").alias("ids"))
    return docs.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.aggregate("ids", F.lit(0).cast("long"), lambda acc, x: acc + x).alias("id_sum"),
    )


@query
def rloo_prompts(spark, d):
    prompts = I.table(spark, d, "documents").select(
        F.col("doc_id").alias("ordinal"), F.col("text").alias("prompt")
    )
    out = datasets.rloo_prompts(prompts, K.token_ids, k=2, batch_size=32)
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return out.select(
        "ordinal", "batch_id", "sample_idx", F.size("input_ids").cast("long").alias("width"),
        total("attention_mask").alias("n_real"), total("input_ids").alias("id_sum"),
        F.get("input_ids", F.size("input_ids") - 1).alias("last_id"),
    )


@query
def sft_packing(spark, d):
    turns = I.table(spark, d, "conversations")
    return datasets.sft_spans(spark, turns, K.token_ids, 2048)


@query
def kto_training_rows(spark, d):
    out = datasets.kto_training_rows(I.pairs(spark, d), K.token_ids, max_prompt=12, max_length=40)
    return out.select(
        "example_id", "branch", "split", "label",
        F.size("prompt_ids").cast("long").alias("prompt_tokens"),
        F.size("completion_ids").cast("long").alias("completion_tokens"),
    )


@query
def reward_training_rows(spark, d):
    """Rendered, tokenized and length-limited completions with their labels."""
    unpaired = datasets.build_unpaired_dataset(I.pairs(spark, d))
    rows = datasets.reward_training_rows(
        unpaired, X.render_chat(F.col("completion")), K.token_ids, max_length=2048
    )
    return rows.select(
        "example_id", "branch", "split", "label", F.size("input_ids").cast("long").alias("n_tokens")
    )


@query
def pack_sequences(spark, d):
    docs = I.table(spark, d, "documents")
    return ordering.pack_sequences(spark, docs, ["doc_id"], K.token_count(F.col("text")), 2048)


@query
def packed_block_tokens(spark, d):
    path = scratch_path(spark, "token-ids")
    docs = I.table(spark, d, "documents")
    docs.select("doc_id", K.token_ids(F.col("text")).alias("ids")).write.parquet(path)
    ids = spark.read.parquet(path)
    sizes = ids.select("doc_id", (F.size("ids") + 1).cast("long").alias("n_stream"))
    starts = ordering.running_offsets(spark, sizes, ["doc_id"], "n_stream")
    blocks = ordering.block_tokens(starts, ids, ["doc_id"], "ids")
    return blocks.select(
        "block",
        F.size("input_ids").cast("long").alias("n_tokens"),
        F.aggregate("input_ids", F.lit(0).cast("long"), lambda acc, x: acc + x).alias("id_sum"),
        F.get("input_ids", F.lit(0)).alias("first_id"),
        F.get("input_ids", F.lit(2047)).alias("last_id"),
    )


@query
def truncate_prompt(spark, d):
    """Every document's text as a prompt, the text of the next document id as the completion, empty if there is none."""
    ids = I.table(spark, d, "documents").select("doc_id", K.token_ids(F.col("text")).alias("ids"))
    answers = ids.select((F.col("doc_id") - 1).alias("doc_id"), F.col("ids").alias("answer"))
    none = F.array().cast("array<int>")
    paired = ids.join(answers, "doc_id", "left").withColumn("answer", F.coalesce("answer", none))
    prompt, completion = K.truncate_pair(F.col("ids"), F.col("answer"), 512, 2048)
    return paired.select("doc_id", prompt.alias("p"), completion.alias("c")).select(
        "doc_id",
        F.size("p").cast("long").alias("prompt_tokens"),
        F.size("c").cast("long").alias("completion_tokens"),
        F.get("p", F.lit(0)).alias("prompt_first"),
        F.get("p", F.size("p") - 1).alias("prompt_last"),
        F.get("c", F.lit(0)).alias("completion_first"),
        F.get("c", F.size("c") - 1).alias("completion_last"),
    )


def _padded(spark, d, side: str) -> DataFrame:
    docs = I.table(spark, d, "documents").select("doc_id", K.token_ids(F.col("text")).alias("ids"))
    out = ordering.pad_batch(docs, "ids", "doc_id", 32, pad=0, side=side)
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return out.select(
        "doc_id",
        "batch_id",
        F.lit(side).alias("side"),
        F.size("ids").cast("long").alias("width"),
        total("attention_mask").alias("n_real"),
        total("ids").alias("id_sum"),
        F.get("ids", F.lit(0)).alias("first_id"),
        F.get("ids", F.size("ids") - 1).alias("last_id"),
    )


@query
def pad_batch(spark, d):
    return _padded(spark, d, "right")


@query
def pad_batch_left(spark, d):
    return _padded(spark, d, "left")


@query
def truncate_at_stop(spark, d):
    cut = K.truncate_at_stop(F.col("response"), CFG.stop_id, CFG.pad_id)
    return I.rollouts(spark, d).select("rollout_id", ids_text(cut).alias("truncated"))


@query
def sequence_length(spark, d):
    return RO.sized_rollouts(I.rollouts(spark, d), CFG).select("rollout_id", "sequence_length")


@query
def padding_mask(spark, d):
    masked = RO.masked_rollouts(I.rollouts(spark, d), CFG)
    return masked.select(
        "rollout_id",
        F.greatest(F.size("logp") - F.col("sequence_length") - 1, F.lit(0)).alias("n_masked"),
        K.array_sum(F.col("logp")).alias("logp_sum"),
        K.array_sum(F.col("ref_logp")).alias("ref_logp_sum"),
    )


@query
def contains_eos(spark, d):
    return RO.sized_rollouts(I.rollouts(spark, d), CFG).select("rollout_id", "has_eos")


@query
def num_eos(spark, d):
    n = F.sum(K.count_token(F.col("response"), CFG.eos_id)).alias("num_eos_tokens")
    return I.rollouts(spark, d).groupBy("update_id").agg(n)


@query
def log_softmax_gather(spark, d):
    out = RO.log_softmax_gather(I.logits(spark, d), temperature=0.7)
    return rounded(out.select("rollout_id", "pos", "logp"))


@query
def log_softmax_generation(spark, d):
    """Generation logits are used as they are, without a temperature."""
    return rounded(RO.log_softmax_gather(I.logits(spark, d)).select("rollout_id", "pos", "logp"))


@query
def log_softmax_arrays(spark, d):
    """Array logits to log-probability and entropy in one row expression."""
    rows = I.table(spark, d, "embeddings").select(
        F.col("vec_id").alias("rollout_id"),
        F.transform(
            F.sequence(F.lit(0), F.lit(3)), lambda p: F.slice("embedding", p * 16 + 1, F.lit(16))
        ).alias("logits"),
        F.transform(F.sequence(F.lit(0), F.lit(3)), lambda p: (F.col("vec_id") + p) % 16).alias("response"),
    )
    log = RO.log_from_logits(rows, "logits", entropy="token_entropy", temperature=0.7)
    flat = log.select("rollout_id", F.posexplode(F.arrays_zip("logp", "token_entropy")).alias("pos", "x"))
    return rounded(
        flat.select("rollout_id", F.col("pos").cast("long").alias("pos"), "x.logp", F.col("x.token_entropy").alias("entropy"))
    )


@query
def token_entropy(spark, d):
    out = RO.log_softmax_gather(I.logits(spark, d), temperature=0.7)
    return rounded(out.select("rollout_id", "pos", "entropy"))


# --- joins -------------------------------------------------------------------


@query
def pair_reference_candidate(spark, d):
    docs = I.table(spark, d, "documents").select(F.col("doc_id").alias("ordinal"), "text")
    pages = I.table(spark, d, "pages").select(
        F.col("page_id").alias("ordinal"), F.col("html").alias("text")
    )
    return pairing.pair_reference_candidate(docs, pages)


@query
def pair_unmatched(spark, d):
    """How many documents and pages the positional pairing keeps and loses."""
    docs = I.table(spark, d, "documents").select(F.col("doc_id").alias("ordinal"))
    pages = I.table(spark, d, "pages").select(F.col("page_id").alias("ordinal"))
    return pairing.unmatched_counts(docs, pages)


@query
def pair_two_models(spark, d):
    return pairing.pair_two_models(I.completions(spark, d), I.MODELS[0], I.MODELS[1])


@query
def attach_prompts(spark, d):
    pairs = pairing.pair_two_models(I.completions(spark, d), I.MODELS[0], I.MODELS[1])
    return pairing.attach_prompts(pairs, I.prompts(spark, d))


@query
def all_pairs_tournament(spark, d):
    return pairing.tournament(I.completions(spark, d), pairing.round_robin(I.MODELS))


# --- aggregations ------------------------------------------------------------


@query
def accuracy(spark, d):
    """Logits of ten classes: the sums of every tenth of the 64 values."""
    rows = I.table(spark, d, "embeddings")
    return rounded(metrics.accuracy(rows, I.strided_logits(10), F.col("label")))


def _judged(spark, d) -> DataFrame:
    return judging.read_verdicts(I.raw_verdicts(spark, d))


@query
def win_rate_vs_reference(spark, d):
    return rounded(judging.win_rate_vs_reference(_judged(spark, d)))


@query
def win_rate_1v1(spark, d):
    return rounded(judging.win_rate_1v1(_judged(spark, d)))


@query
def verdict_distribution(spark, d):
    return rounded(judging.verdict_distribution(_judged(spark, d)))


@query
def eval_samples(spark, d):
    return metrics.eval_samples(datasets.build_kto_dataset(I.pairs(spark, d)))


@query
def label_balance(spark, d):
    return metrics.label_balance(I.thumbs(spark, d), ["lang"])


@query
def pairwise_reward_eval(spark, d):
    pairs = I.pairs(spark, d)
    out = metrics.pairwise_reward_eval(
        pairs, F.col("score_chosen"), F.col("score_rejected"), ["split"]
    )
    return rounded(out)


@query
def pointwise_reward_eval(spark, d):
    rows = I.table(spark, d, "embeddings").select(
        I.strided_logits(2).alias("logits"),
        (F.col("label") % 2).alias("label"),
    )
    return rounded(metrics.pointwise_reward_eval(rows, F.col("logits"), F.col("label")))


def _mismatched_sums(pairs: DataFrame) -> DataFrame:
    """A stand-in for the two models: log-probabilities of a response to a prompt that is not its own."""

    def logp(step: int, mod: int) -> Column:
        at = lambda token, i: (F.col("prompt_id") + token * step + i) % mod + 1
        return K.array_sum(F.transform("response", lambda token, i: -at(token, i).cast("double") / 16))

    return pairs.withColumn("logp_sum", logp(7, 17)).withColumn("ref_logp_sum", logp(5, 13))


def _kto_points(spark, d) -> DataFrame:
    rows = I.rollouts(spark, d).select("update_id", "rollout_id", "prompt_id", "response")
    return kto.kto_reference_point(
        spark, rows, "update_id", "rollout_id", "prompt_id", "response", _mismatched_sums
    )


@query
def kto_mismatched_pairs(spark, d):
    rows = I.rollouts(spark, d).select("update_id", "rollout_id", "prompt_id", "response")
    pairs = kto.mismatched_pairs(spark, rows, "update_id", "rollout_id", "prompt_id", "response")
    return pairs.select("update_id", "rollout_id", "other", "prompt_id", F.size("response").cast("long").alias("n_tokens"))


@query
def kto_reference_point(spark, d):
    return rounded(_kto_points(spark, d))


@query
def kto_objective(spark, d):
    rewards = RO.response_sums(_rewards(spark, d))
    rows = rewards.select(
        "update_id",
        "rollout_id",
        "logp_sum",
        (F.col("logp_sum") - F.col("kl")).alias("ref_logp_sum"),
        F.col("reward_score").cast("int").alias("label"),
    )
    with_z = kto.with_reference_point(rows, _kto_points(spark, d), "update_id", "rollout_id")
    return rounded(metrics.kto_objective(with_z, "update_id", beta=0.1), "loss")


# --- rollout mathematics -----------------------------------------------------


def _rewards(spark, d, **options) -> DataFrame:
    return RO.rollout_rewards(RO.sized_rollouts(I.rollouts(spark, d), CFG), CFG, **options)


@query
def sequence_kl(spark, d):
    return _rewards(spark, d).select("rollout_id", "kl")


@query
def non_score_reward(spark, d):
    return _rewards(spark, d).select("rollout_id", "non_score_reward")


@query
def eos_penalty(spark, d):
    masked = RO.sized_rollouts(I.rollouts(spark, d), CFG)
    lowered = R.penalise_missing_eos(F.col("score"), F.col("has_eos"), CFG.missing_eos_penalty)
    return masked.select("rollout_id", lowered.alias("s")).select(
        "rollout_id",
        F.get("s", F.lit(0)).alias("logit0"),
        F.get("s", F.lit(1)).alias("logit1"),
    )


@query
def thumbs_score(spark, d):
    return I.rollouts(spark, d).select("rollout_id", R.thumbs_score(F.col("score")).alias("thumbs"))


@query
def rlhf_reward(spark, d):
    return _rewards(spark, d).select("rollout_id", "reward_score", "rlhf_reward")


@query
def rlhf_reward_after_argmax(spark, d):
    """The variant in which a missing end really costs reward."""
    out = _rewards(spark, d, penalty_after_argmax=True)
    return out.select("rollout_id", "reward_score", "rlhf_reward")


_ADVANTAGE = ("update_id", "prompt_id", "rollout_id", "rlhf_reward", "advantage")


@query
def rloo_advantage(spark, d):
    return training_log.scored_rollouts(I.rollouts(spark, d), CFG).select(*_ADVANTAGE)


@query
def rloo_advantage_any_k(spark, d):
    slim = _rewards(spark, d).select("update_id", "prompt_id", "rollout_id", "rlhf_reward")
    return RO.rloo_advantage_any_k(slim).select(*_ADVANTAGE)


@query
def rloo_advantage_paired(spark, d):
    rewards = _rewards(spark, d, scalar_reward=True)
    return RO.rloo_advantage(rewards, CFG.k).select(*_ADVANTAGE)


def _policy(spark, d) -> DataFrame:
    return training_log.policy_rollouts(I.rollouts(spark, d), I.policy_log(spark, d), CFG)


def _policy_sums(spark, d) -> DataFrame:
    return RO.policy_sums(I.policy_log(spark, d), RO.sized_rollouts(I.rollouts(spark, d), CFG))


@query
def importance_ratio(spark, d):
    sums = _policy_sums(spark, d)
    mean = F.try_divide(F.col("token_ratio_sum"), F.col("n_tokens"))
    ratio = R.sequence_ratio(F.col("new_logp_sum"), F.col("logp_sum"))
    return sums.select(
        "rollout_id", "ppo_epoch", r6(ratio).alias("ratio"), r6(mean).alias("token_ratio_mean")
    )


@query
def ppo_clip_loss(spark, d):
    out = _policy(spark, d).groupBy("update_id").agg(F.avg("loss").alias("policy_loss"))
    return rounded(out)


@query
def clip_fraction(spark, d):
    out = _policy(spark, d).groupBy("update_id").agg(F.avg("is_clipped").alias("clipfrac"))
    return rounded(out)


@query
def approx_kl(spark, d):
    sums = _policy_sums(spark, d)
    squared = F.pow(F.col("new_logp_sum") - F.col("logp_sum"), F.lit(2))
    updates = I.rollouts(spark, d).select("rollout_id", "update_id")
    out = sums.join(updates, "rollout_id").groupBy("update_id").agg((F.avg(squared) * 0.5).alias("approx_kl"))
    return rounded(out)


@query
def slot_stats(spark, d):
    return rounded(training_log.training_slot_stats(I.rollouts(spark, d), I.policy_log(spark, d), CFG))


@query
def update_metrics(spark, d):
    out = training_log.training_metrics(
        I.rollouts(spark, d), I.policy_log(spark, d), CFG, batch_size=512, n_train=1000
    )
    return rounded(out)


def _bucketed(spark, d) -> tuple[DataFrame, DataFrame]:
    """The two logs as tables laid out by rollout."""
    tables = []
    for log in (I.rollouts, I.policy_log):
        path = scratch_path(spark, log.__name__)
        name = os.path.basename(path).replace("-", "_")
        writers.write_bucketed(log(spark, d), name, path)
        tables.append(spark.table(name))
    return tuple(tables)


@query
def slot_stats_bucketed(spark, d):
    return rounded(training_log.training_slot_stats(*_bucketed(spark, d), CFG))


@query
def update_metrics_bucketed(spark, d):
    return rounded(training_log.training_metrics(*_bucketed(spark, d), CFG, batch_size=512, n_train=1000))


@query
def objective_entropy(spark, d):
    masked = RO.masked_rollouts(I.rollouts(spark, d), CFG)
    logged = RO.sequence_entropy(F.col("logp"))
    valid = RO.sequence_entropy(F.col("logp"), F.col("sequence_length"))
    return rounded(
        masked.groupBy("update_id").agg(
            F.avg(logged).alias("entropy"), F.avg(valid).alias("entropy_unmasked_only")
        )
    )


@query
def completions_report(spark, d):
    prompts = I.prompts(spark, d).select(
        F.col("ordinal").alias("prompt_id"), F.col("prompt").alias("query")
    )
    report = RO.completions_report(prompts, I.rollouts(spark, d), CFG)
    return report.withColumn("score", R.thumbs_score(F.col("score")))


# --- judge operators ---------------------------------------------------------


def _asked(spark, d) -> DataFrame:
    pairs = pairing.pair_two_models(I.completions(spark, d), I.MODELS[0], I.MODELS[1])
    return pairing.attach_prompts(pairs, I.prompts(spark, d))


@query
def judge_prompt(spark, d):
    built = X.judge_prompt(F.col("prompt"), F.col("answer_a"), F.col("answer_b"), "Pick one.")
    return _asked(spark, d).select("ordinal", built.alias("judge_prompt"))


@query
def cut_at_stop_string(spark, d):
    return I.raw_verdicts(spark, d).select("example_id", X.cut_at_stop(F.col("raw")).alias("cut"))


@query
def parse_verdict(spark, d):
    return I.raw_verdicts(spark, d).select(
        "example_id",
        X.parse_verdict(F.col("raw")).alias("verdict_uncut"),
        X.parse_verdict(X.cut_at_stop(F.col("raw"))).alias("verdict"),
    )


@query
def verdict_to_winner(spark, d):
    return _judged(spark, d).select("example_id", "winner")


@query
def flip_order(spark, d):
    asked = _asked(spark, d).withColumns({"model_a": F.lit(I.MODELS[0]), "model_b": F.lit(I.MODELS[1])})
    flipped = judging.flip_order(asked, ("ordinal", "model_a", "model_b"), seed=3)
    by_length = F.when(F.length("answer_a") > F.length("answer_b"), 0).when(
        F.length("answer_b") > F.length("answer_a"), 1
    )
    return flipped.withColumn("shown_winner", by_length).select(
        "ordinal",
        "flipped",
        "answer_a",
        "answer_b",
        "shown_winner",
        judging.unflip_winner(F.col("shown_winner"), F.col("flipped")).alias("winner"),
    )


@query
def batch_generate(spark, d):
    docs = I.table(spark, d, "documents").select(
        F.col("doc_id").alias("ordinal"), F.col("text").alias("prompt")
    )
    return inference.batch_generate(docs, judges.echo_generator)


@query
def batch_judge(spark, d):
    return inference.batch_judge(_asked(spark, d), judges.length_judge)


@query
def batch_score(spark, d):
    rows = I.thumbs(spark, d).select(
        "doc_id", F.col("source").alias("query"), F.col("text").alias("response")
    )
    scored = inference.batch_score(rows, judges.length_scorer)
    return scored.select(
        "doc_id",
        F.get("score", F.lit(0)).alias("logit0"),
        F.get("score", F.lit(1)).alias("logit1"),
    )


@query
def generate_completions(spark, d):
    prompts = I.prompts(spark, d)
    return evaluation.generate_completions(prompts, judges.echo_generator, I.MODELS[2])


@query
def batch_generate_resumed(spark, d):
    """A first run that got through a part of the prompts, and a second that does the rest."""
    path = scratch_path(spark, "generated")
    docs = I.table(spark, d, "documents").select(F.col("doc_id").alias("ordinal"), F.col("text").alias("prompt"))
    generate = lambda df: inference.batch_generate(df, judges.echo_generator)
    inference.run_in_parts(docs.where("ordinal % 10 < 4"), generate, path, parts=2)
    return inference.run_in_parts(docs, generate, path, parts=4)


@query
def batch_judge_resumed(spark, d):
    path = scratch_path(spark, "judged")
    judge = lambda df: inference.batch_judge(df, judges.length_judge)
    inference.run_in_parts(_asked(spark, d).where("ordinal % 3 = 0"), judge, path, parts=2)
    return inference.run_in_parts(_asked(spark, d), judge, path, parts=4)


@query
def judge_against_reference(spark, d):
    examples = readers.source_adapter(
        I.table(spark, d, "documents").select(
            F.col("doc_id").alias("ordinal"),
            F.concat_ws(" ", F.lit("Describe"), "source", F.lit("in"), "lang").alias("prompt"),
            F.col("text").alias("completion"),
        ),
        "plain",
    )
    every = I.completions(spark, d)
    return rounded(evaluation.judge_against_reference(examples, every, judges.length_judge))


@query
def judge_matches(spark, d):
    return rounded(
        evaluation.judge_matches(
            I.prompts(spark, d),
            I.completions(spark, d),
            pairing.round_robin(I.MODELS),
            judges.length_judge,
            flip_seed=3,
        )
    )


# --- scalar functions --------------------------------------------------------


@query
def model_slug(spark, d):
    rows = I.table(spark, d, "customer")
    name = F.concat_ws("/", "c_mktsegment", "c_name")
    return rows.select("c_custkey", X.model_slug(name).alias("slug"))


@query
def run_name(spark, d):
    rows = I.table(spark, d, "orders")
    name = X.run_name(
        F.lit("logs/rloo_unpaired"),
        F.concat(F.lit("acme/base_"), "o_orderstatus"),
        F.concat(F.lit("hub/prefs_"), F.col("o_custkey").cast("string")),
        F.col("o_orderdate"),
    )
    return rows.select("o_orderkey", name.alias("run_name"))


# --- streams -----------------------------------------------------------------

# An end-of-stream row far in the future moves the watermark past every window.
END_OF_STREAM = "2100-01-01 00:00:00"


def _end_of_stream(spark: SparkSession, schema: T.StructType, ts: str) -> DataFrame:
    return spark.range(1).select(
        *(
            F.to_timestamp(F.lit(END_OF_STREAM)).alias(f.name)
            if f.name == ts
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )


def _stream_of(spark: SparkSession, table: DataFrame, ts: str | None, name: str) -> DataFrame:
    """A file stream over a table; with ``ts``, an end-of-stream row closes its windows."""
    path = scratch_path(spark, name)
    table.write.parquet(path)
    if ts is not None:
        _end_of_stream(spark, table.schema, ts).write.mode("append").parquet(path)
    return feedback.read_table_stream(spark, path, table.schema, "*.parquet")


def _drained(spark: SparkSession, stream: DataFrame, name: str, keyed_state: bool = False) -> DataFrame:
    path = scratch_path(spark, name)
    feedback.drain_to_table(stream, f"{path}/table", f"{path}/checkpoint", keyed_state)
    return spark.read.schema(stream.schema).parquet(f"{path}/table")


def _epoch_seconds(df: DataFrame) -> DataFrame:
    return rounded(df.withColumn("window_start", F.unix_seconds("window_start")))


def _delivered_again(df: DataFrame, key: str) -> DataFrame:
    """Every seventh row comes twice."""
    times = F.when(F.col(key) % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("__copy", F.explode(times)).drop("__copy")


@query
def stream_unpaired(spark, d):
    pairs = reshape.drop_columns(I.pairs(spark, d))
    stream = feedback.stream_unpaired(_stream_of(spark, pairs, None, "pair-stream"))
    flat = stream.select(
        "example_id",
        "branch",
        "split",
        "prompt",
        reshape.messages_text(F.col("completion")).alias("completion"),
        "label",
    )
    return _drained(spark, flat, "unpaired-stream")


@query
def stream_thumbs_rate(spark, d):
    stream = _stream_of(spark, I.feedback_events(spark, d), "ts", "thumbs-stream")
    rates = feedback.stream_thumbs_rate(stream, "ts", F.col("up"))
    return _epoch_seconds(_drained(spark, rates, "thumbs-rate"))


@query
def stream_unpaired_repeated(spark, d):
    """A feed of pairs in which some come twice."""
    seconds = F.lit(1_700_000_000) + F.col("example_id") % 86_400
    pairs = reshape.drop_columns(I.pairs(spark, d)).withColumn("ts", F.timestamp_seconds(seconds))
    feed = _stream_of(spark, _delivered_again(pairs, "example_id"), "ts", "pair-feed")
    # The row that ends the feed moves the clock and is no pair.
    stream = feedback.stream_unpaired(feed, key=["example_id"], ts="ts", watermark="1 day").where("example_id is not null")
    flat = stream.select(
        "example_id", "branch", "split", "prompt", reshape.messages_text(F.col("completion")).alias("completion"), "label"
    )
    return _drained(spark, flat, "unpaired-feed")


@query
def stream_thumbs_rate_repeated(spark, d):
    events = _delivered_again(I.feedback_events(spark, d), "event_id")
    stream = _stream_of(spark, events, "ts", "thumbs-feed")
    rates = feedback.stream_thumbs_rate(stream, "ts", F.col("up"), key=["event_id"])
    return _epoch_seconds(_drained(spark, rates, "thumbs-feed-rate"))


def _arrival() -> Column:
    """Samples of a slot lie a second, eleven minutes or an hour apart."""
    apart = F.element_at(F.array(F.lit(1), F.lit(660), F.lit(3600)), (F.col("prompt_id") % 3 + 1).cast("int"))
    seconds = F.col("update_id") * 613 + F.col("prompt_id") % 97 * 3 + F.col("sample_idx") * apart
    return F.timestamp_seconds(F.lit(1_700_000_037) + seconds)


#: Lines for a slice of the steps and a part of their feed, up to ``MOST_SLICES``.
SLICE_LINES, MOST_SLICES = 500_000, 8


def _by_time(table: DataFrame, ts: str, parts: int) -> list[DataFrame]:
    """The rows in at most ``parts`` tables of about the same size, each later than the one before."""
    at = F.unix_micros(ts)
    shares = [i / parts for i in range(1, parts)]
    (row,) = table.select(F.percentile_approx(at, shares or [0.5], 1000).alias("bounds")).collect()
    bounds = sorted(set(row.bounds or [])) if shares else []
    if not bounds:
        return [table]
    between = [(at > low) & (at <= high) for low, high in zip(bounds, bounds[1:])]
    return [table.where(c) for c in (at <= bounds[0], *between, (at > bounds[-1]) | at.isNull())]


def _drained_by_time(spark: SparkSession, table: DataFrame, ts: str, parts: int, streamed, name: str) -> DataFrame:
    """A feed of a table that arrives in parts, in the order of time: a part is worked off and deleted before the next comes.

    So shuffles and state are those of a part. Without that order a part would be late after the one before.
    """
    feed, out = scratch_path(spark, f"{name}-feed"), scratch_path(spark, name)
    pieces = _by_time(table, ts, parts)
    for i, piece in enumerate(pieces):
        piece.write.parquet(f"{feed}/{i}")
        if i == len(pieces) - 1:
            _end_of_stream(spark, table.schema, ts).write.mode("append").parquet(f"{feed}/{i}")
        stream = streamed(feedback.read_table_stream(spark, f"{feed}/*", table.schema, "*.parquet", files_per_trigger=None))
        with feedback.bounded_state(spark):
            feedback.drain_to_table(stream, f"{out}/table", f"{out}/checkpoint", keyed_state=True)
        release_shuffles(spark)
        remove_path(spark, f"{feed}/{i}")
    remove_path(spark, feed)
    return spark.read.schema(stream.schema).parquet(f"{out}/table")


@query
def stream_update_metrics(spark, d):
    slices = min(MOST_SLICES, 1 + I.table(spark, d, "lineitem").count() // SLICE_LINES)
    path, known = scratch_path(spark, "steps"), scratch_path(spark, "known-slots")
    for steps in training_log.sliced_rollout_steps(I.rollouts(spark, d), I.policy_log(spark, d), CFG, slices):
        steps.withColumn("ts", _arrival()).select(*feedback.STEP_COLUMNS, "ts").write.mode("append").parquet(path)
    release_shuffles(spark)
    steps = spark.read.parquet(path)
    # What the trainer knows beforehand: rows of a slot, slots of an update.
    slots = steps.groupBy(*metrics.SLOT).agg(F.count(F.lit(1)).alias("slot_rows"))
    updates = slots.groupBy("update_id").agg(F.count(F.lit(1)).alias("n_slots"))
    # Written, its size is known: the steps need no shuffle to meet a few slots.
    slots.join(updates, "update_id").write.parquet(known)
    rows = _delivered_again(steps.join(spark.read.parquet(known), list(metrics.SLOT)), "rollout_id")
    # The rows of a slot may come in any parts: none is given up while the feed lasts.
    (span,) = steps.agg((F.max("ts") - F.min("ts")).alias("span")).collect()
    patience = feedback.PATIENCE + (span.span or dt.timedelta(0))

    def streamed(feed: DataFrame) -> DataFrame:
        return feedback.stream_update_metrics(feed, batch_size=512, k=CFG.k, n_train=1000, patience=patience)

    out = _drained_by_time(spark, rows, "ts", slices, streamed, "update-metrics")
    for worked_off in (path, known):
        remove_path(spark, worked_off)
    return rounded(out)


@query
def stream_rloo_advantage(spark, d):
    rewards = training_log.scored_rollouts(I.rollouts(spark, d), CFG).withColumn("ts", _arrival())
    rows = rewards.select("update_id", "prompt_id", "sample_idx", "rollout_id", "rlhf_reward", "ts")
    stream = _stream_of(spark, _delivered_again(rows, "rollout_id"), "ts", "rollout-stream")
    return _drained(spark, feedback.stream_rloo_advantage(stream, CFG.k), "stream-advantage", keyed_state=True)
