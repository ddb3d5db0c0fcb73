"""Explicit table schemas. Every table carries a key because Spark rows have no position."""

from pyspark.sql import types as T

MESSAGE = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]
)
MESSAGES = T.ArrayType(MESSAGE)

PAIRS = T.StructType(
    [
        T.StructField("example_id", T.LongType()),
        T.StructField("split", T.StringType()),
        T.StructField("prompt_id", T.StringType()),
        T.StructField("prompt", T.StringType()),
        T.StructField("messages", MESSAGES),
        T.StructField("chosen", MESSAGES),
        T.StructField("rejected", MESSAGES),
        T.StructField("score_chosen", T.DoubleType()),
        T.StructField("score_rejected", T.DoubleType()),
    ]
)

ROLLOUTS = T.StructType(
    [
        T.StructField("update_id", T.LongType()),
        T.StructField("prompt_id", T.LongType()),
        T.StructField("sample_idx", T.LongType()),
        T.StructField("rollout_id", T.LongType()),
        T.StructField("response", T.ArrayType(T.IntegerType())),
        T.StructField("logp", T.ArrayType(T.DoubleType())),
        T.StructField("ref_logp", T.ArrayType(T.DoubleType())),
        T.StructField("score", T.ArrayType(T.DoubleType())),
        T.StructField("elapsed", T.DoubleType()),
        T.StructField("lr", T.DoubleType()),
    ]
)

# One row per rollout, optimisation epoch and slot.
POLICY_LOG = T.StructType(
    [
        T.StructField("rollout_id", T.LongType()),
        T.StructField("ppo_epoch", T.LongType()),
        T.StructField("minibatch", T.LongType()),
        T.StructField("microbatch", T.LongType()),
        T.StructField("new_logp", T.ArrayType(T.DoubleType())),
        T.StructField("token_entropy", T.ArrayType(T.DoubleType())),
    ]
)

def require_columns(df, *names: str) -> None:
    """Fail early, and name every missing column at once."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
