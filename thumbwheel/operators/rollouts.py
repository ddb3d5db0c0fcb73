"""Logged rollouts to masked KL, rewards, leave-one-out advantages and losses."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thumbwheel.functions import rollout as R
from thumbwheel.functions import tokens as K
from thumbwheel.operators.skew import attach_group_sums, lookup_join


@dataclass(frozen=True)
class RolloutConfig:
    stop_id: int | None = 1
    eos_id: int = 1
    pad_id: int = 0
    kl_coef: float = 0.05
    cliprange: float = 0.2
    missing_eos_penalty: float | None = 1.0
    k: int = 2


def sized_rollouts(df: DataFrame, cfg: RolloutConfig = RolloutConfig()) -> DataFrame:
    """Truncated response, index of its last token, and whether it ends."""
    return (
        df.withColumn("truncated", K.truncate_at_stop(F.col("response"), cfg.stop_id, cfg.pad_id))
        .withColumn("sequence_length", K.sequence_length(F.col("truncated"), cfg.pad_id))
        .withColumn("has_eos", K.contains_token(F.col("truncated"), cfg.eos_id))
    )


def masked_rollouts(df: DataFrame, cfg: RolloutConfig = RolloutConfig()) -> DataFrame:
    """Sized rollouts with the masked positions of all log-probabilities filled."""
    sized = sized_rollouts(df, cfg)
    for name in ("logp", "ref_logp"):
        sized = sized.withColumn(name, K.mask_after(F.col(name), F.col("sequence_length")))
    return sized


def _valid(name: str) -> Column:
    """The unmasked positions.

    Sums over masked arrays follow from these: a masked position adds 0 to a
    difference and ``INVALID_LOGPROB`` to a plain sum, so padding is never
    walked through.
    """
    return K.keep_start(F.col(name), F.col("sequence_length") + 1)


def _n_masked(name: str) -> Column:
    n = F.size(name)
    return n - F.least(F.greatest(F.col("sequence_length") + 1, F.lit(0)), n)


def rollout_rewards(
    df: DataFrame,
    cfg: RolloutConfig = RolloutConfig(),
    scalar_reward: bool = False,
    penalty_after_argmax: bool = False,
) -> DataFrame:
    """Score, KL term and reward of each sized or masked rollout; no shuffle.

    ``scalar_reward`` takes the first logit as the reward (a one-logit model)
    instead of the 0/1 argmax. ``penalty_after_argmax`` lets the missing-EOS
    penalty reach the 0/1 score, which it otherwise cannot change.
    """
    kl = R.sequence_kl(_valid("logp"), _valid("ref_logp"))
    penalised = R.penalise_missing_eos(F.col("score"), F.col("has_eos"), cfg.missing_eos_penalty)
    if scalar_reward:
        value = F.get(penalised, F.lit(0))
    elif penalty_after_argmax and cfg.missing_eos_penalty is not None:
        value = R.thumbs_score(F.col("score")) - F.when(F.col("has_eos"), 0.0).otherwise(
            cfg.missing_eos_penalty
        )
    else:
        value = R.thumbs_score(penalised)
    return (
        df.withColumn("kl", kl)
        .withColumn("non_score_reward", F.lit(-cfg.kl_coef) * F.col("kl"))
        .withColumn("reward_score", value)
        .withColumn("rlhf_reward", F.col("reward_score") + F.col("non_score_reward"))
    )


def rloo_advantage(df: DataFrame, k: int) -> DataFrame:
    """Leave-one-out advantage inside each prompt's slot of ``k`` samples.

    The slot is part of the partition key, so the window spans at most ``k``
    rows however often a prompt is repeated; more fail the query. A lone sample
    gets NULL.
    """
    keyed = df.withColumn("slot", F.floor(F.col("sample_idx") / F.lit(k)).cast("long"))
    group = Window.partitionBy("update_id", "prompt_id", "slot")
    return keyed.withColumn(
        "advantage",
        R.leave_one_out(
            F.col("rlhf_reward"),
            F.sum("rlhf_reward").over(group),
            R.at_most(F.count(F.lit(1)).over(group), k),
        ),
    )


def rloo_advantage_any_k(df: DataFrame) -> DataFrame:
    """The same over all samples of a prompt, however many there are.

    Group sums are aggregated and joined back, so a prompt with a third of all
    rollouts is spread over tasks.
    """
    sums = {"__total": F.col("rlhf_reward"), "__n": F.lit(1)}
    joined = attach_group_sums(df, ["update_id", "prompt_id"], sums, "rollout_id")
    return joined.withColumn(
        "advantage", R.leave_one_out(F.col("rlhf_reward"), F.col("__total"), F.col("__n"))
    ).drop("__total", "__n")


def response_sums(df: DataFrame) -> DataFrame:
    """Log-probability sum and token count of sized rollouts, as if masked positions held their fill."""
    fill = F.lit(K.INVALID_LOGPROB) * _n_masked("logp")
    return df.withColumn("logp_sum", K.array_sum(_valid("logp")) + fill).withColumn(
        "n_tokens", F.size("logp").cast("long")
    )


def policy_sums(policy_log: DataFrame, sized: DataFrame) -> DataFrame:
    """Sums over tokens of every policy row (rollout and epoch); no array in the result.

    ``policy_log`` has ``rollout_id``, ``new_logp``, ``token_entropy`` and its slot;
    the old log-probabilities come from the rollout itself, sent once.
    """
    own = response_sums(sized).select("rollout_id", "logp", "sequence_length", "logp_sum", "n_tokens")
    fill = F.lit(K.INVALID_LOGPROB) * _n_masked("logp")
    return (
        policy_log.join(own, "rollout_id")
        .withColumn("new_logp_sum", K.array_sum(_valid("new_logp")) + fill)
        .withColumn(
            "token_ratio_sum",
            R.token_ratio_sum(_valid("new_logp"), _valid("logp")) + _n_masked("logp"),
        )
        .withColumn("entropy_sum", K.array_sum(F.col("token_entropy")))
        .drop("logp", "new_logp", "token_entropy", "sequence_length")
    )


def steps_of_rollouts(policy_log: DataFrame) -> DataFrame:
    """The policy log as one row per rollout: ``steps``, one entry per epoch.

    Entropies are added up first and do not travel. A window puts the entries together: an aggregation
    into lists sorts and writes its rows once before and once after the shuffle, and gets no fewer bytes for it.
    """
    step = F.struct("ppo_epoch", "minibatch", "microbatch", "new_logp", "entropy_sum")
    of = Window.partitionBy("rollout_id").orderBy("ppo_epoch")
    every = of.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        policy_log.where(F.col("rollout_id").isNotNull())
        .withColumn("entropy_sum", K.array_sum(F.col("token_entropy")))
        .select("rollout_id", step.alias("step"), "ppo_epoch")
        .select("rollout_id", F.collect_list("step").over(every).alias("steps"), F.row_number().over(of).alias("nth"))
        .where("nth = 1")
        .drop("nth")
    )


def summed_steps(sized: DataFrame) -> DataFrame:
    """Replaces ``new_logp`` in ``steps`` by its sums against the rollout's ``logp``."""
    last = F.col("sequence_length") + 1
    masked = _n_masked("logp")

    def sums(step: Column) -> Column:
        new = K.keep_start(step["new_logp"], last)
        return F.struct(
            step["ppo_epoch"].alias("ppo_epoch"),
            step["minibatch"].alias("minibatch"),
            step["microbatch"].alias("microbatch"),
            (K.array_sum(new) + F.lit(K.INVALID_LOGPROB) * masked).alias("new_logp_sum"),
            (R.token_ratio_sum(new, _valid("logp")) + masked).alias("token_ratio_sum"),
            step["entropy_sum"].alias("entropy_sum"),
        )

    return sized.withColumn("steps", F.transform("steps", sums))


def policy_terms(df: DataFrame, cfg: RolloutConfig = RolloutConfig()) -> DataFrame:
    """Ratio and clipped-loss terms of rollouts with sums and an advantage; scalars only."""
    loss, clipped = R.clipped_losses(F.col("advantage"), F.col("ratio"), cfg.cliprange)
    return (
        df.withColumn("ratio", R.sequence_ratio(F.col("new_logp_sum"), F.col("logp_sum")))
        .withColumn("loss_plain", loss)
        .withColumn("loss_clipped", clipped)
        .withColumn("loss", F.greatest("loss_plain", "loss_clipped"))
        .withColumn("is_clipped", (F.col("loss_clipped") > F.col("loss_plain")).cast("double"))
        .withColumn("log_ratio_sq", F.pow(F.col("new_logp_sum") - F.col("logp_sum"), F.lit(2)))
    )


def sequence_entropy(logp: Column, last: Column | None = None) -> Column:
    """Sum of -logp. Masked positions count as -1 each; with ``last`` they are left out."""
    values = logp if last is None else F.slice(logp, F.lit(1), F.least(last + 1, F.size(logp)))
    return F.negative(K.array_sum(values))


def decode_ids(ids: Column) -> Column:
    """Token ids as text; a tokenizer's decoder is passed in its place."""
    return F.array_join(ids.cast("array<string>"), " ")


# The column names of the report.
def completions_report(
    prompts: DataFrame,
    rollouts: DataFrame,
    cfg: RolloutConfig = RolloutConfig(),
    decode: Callable[[Column], Column] = decode_ids,
) -> DataFrame:
    """Query, truncated response and score of every logged completion.

    ``prompts`` has one row per ``prompt_id``; a prompt sampled very often is
    spread over tasks by ``lookup_join``. A completion whose prompt is not listed
    has a NULL query.
    """
    responses = rollouts.select(
        "prompt_id",
        "rollout_id",
        decode(K.truncate_at_stop(F.col("response"), cfg.stop_id, cfg.pad_id)).alias(
            "model response"
        ),
        "score",
    )
    joined = lookup_join(responses, prompts.select("prompt_id", "query"), ["prompt_id"], "rollout_id", "left")
    return joined.select("rollout_id", "query", "model response", "score")


def log_softmax_gather(
    logits: DataFrame,
    keys: tuple[str, ...] = ("rollout_id", "pos"),
    temperature: float | None = None,
) -> DataFrame:
    """Log-probability of the drawn token and entropy per position, from long logits.

    Input rows: keys, ``token``, ``logit`` and the drawn ``chosen`` token.
    ``temperature`` divides the logits (None: they are used as they are). Sums
    of exponentials are kept relative to 256-wide bands of the logits, so any
    finite logits are safe and each task can add up its part first: one
    aggregation shuffles partial sums, the second meets a handful of bands.
    """
    band = 256.0
    x = F.col("logit") if temperature is None else F.col("logit") / F.lit(temperature + 1e-7)
    e = F.exp(F.col("x") - F.col("band") * band)
    partial = (
        logits.select(*keys, "token", "chosen", x.alias("x"))
        .withColumn("band", F.floor(F.col("x") / band))
        .groupBy(*keys, "band")
        .agg(
            F.sum(e).alias("s"),
            F.sum(e * F.col("x")).alias("sx"),
            F.max(F.when(F.col("token") == F.col("chosen"), F.col("x"))).alias("picked"),
        )
    )
    bands = F.collect_list(F.struct("band", "s", "sx", "picked"))
    shift = lambda b: F.exp((b["band"] - F.col("top")) * band)
    total = lambda f: F.aggregate(
        "bands", F.lit(0.0), lambda acc, b: acc + b[f] * shift(b)
    )
    return (
        partial.groupBy(*keys)
        .agg(bands.alias("bands"), F.max("band").alias("top"), F.max("picked").alias("picked"))
        .withColumn("__s", total("s"))
        .withColumn("log_z", F.log("__s") + F.col("top") * band)
        .select(
            *keys,
            (F.col("picked") - F.col("log_z")).alias("logp"),
            (F.col("log_z") - total("sx") / F.col("__s")).alias("entropy"),
        )
    )


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def token_statistics(logits: Column, token: Column, temperature: float | None = None) -> Column:
    """``logp`` of the drawn token and ``entropy``, from an array of logits; one row expression."""
    scale = 1.0 if temperature is None else temperature + 1e-7
    scaled = F.transform(logits, lambda x: x.cast("double") / F.lit(scale))

    def sums(x: Column, top: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("sx"))
        add = lambda acc, v: _let(
            F.exp(v - top), lambda e: F.struct((acc["s"] + e).alias("s"), (acc["sx"] + e * v).alias("sx"))
        )
        return F.aggregate(x, start, add)

    def of(x: Column, top: Column, total: Column) -> Column:
        log_z = top + F.log(total["s"])
        return F.struct(
            (F.get(x, token.cast("int")) - log_z).alias("logp"),
            (log_z - total["sx"] / total["s"]).alias("entropy"),
        )

    return _let(
        scaled, lambda x: _let(F.array_max(x), lambda top: _let(sums(x, top), lambda total: of(x, top, total)))
    )


def log_from_logits(
    df: DataFrame,
    logits: str,
    response: str = "response",
    logp: str = "logp",
    entropy: str | None = None,
    temperature: float | None = None,
) -> DataFrame:
    """Replace ``logits`` (an array per position) by the log columns: no shuffle, no Python.

    Applied to a sampled response's policy and reference logits it makes a
    rollout row; to the logits of an optimisation step, with ``entropy``, a row
    of the policy log.
    """
    found = F.transform(
        F.arrays_zip(F.col(logits).alias("logits"), F.col(response).alias("token")),
        lambda p: token_statistics(p["logits"], p["token"], temperature),
    )
    out = df.withColumn("__stats", found).withColumn(logp, F.col("__stats.logp"))
    if entropy is not None:
        out = out.withColumn(entropy, F.col("__stats.entropy"))
    return out.drop("__stats", logits)
