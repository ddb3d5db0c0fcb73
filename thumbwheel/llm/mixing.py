"""Mixing sources to target weights with soft membership.

A naive Bayes classifier over hashed words, fitted on a bounded labelled sample,
gives every document a posterior over domains; the prior is that of the
document's source. Non-negative rates (how often to use a document) are then
fitted so that the expected tokens of each domain match the targets: least
squares by projected gradient from rate 1, each step one aggregation over a slim
table. Everything runs on DataFrame functions; the driver sees one number per
domain and step.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thumbwheel.llm.store import Scratch


@dataclass(frozen=True)
class MixConfig:
    buckets: int = 4096  # of hashed words
    labelled: int = 8000  # rows the classifier is fitted on, at most
    evidence: float = 20.0  # words of evidence that a long text is worth
    prior_weight: float = 5.0  # labelled rows that the overall prior counts in a source's
    steps: int = 60
    unwritten: int = 6  # steps between two writes of the rates
    tolerance: float = 0.002  # of a domain's target
    least: float = 0.0  # rate of any document; 1 keeps all of them in the mixture
    most: float = 64.0  # rate of any document, and so of its copies
    headroom: float = 1.01  # of the budget, so that no rate falls below 1 by rounding
    seed: int = 17


def space_words(text: Column) -> Column:
    """Whole text as words; one separator character keeps the split off the regex engine."""
    return F.split(F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     "), " ")


def _bucket(word: Column, cfg: MixConfig) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(cfg.buckets)).cast("int")


def labelled_sample(docs: DataFrame, labelled: DataFrame, domains: list[str], cfg: MixConfig) -> DataFrame:
    """``source, text, domain`` of the labelled rows with the smallest hash of doc_id."""
    chosen = (
        labelled.where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains))
        .groupBy("doc_id").agg(F.min("domain").alias("domain"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(cfg.labelled)
    )
    # At most cfg.labelled keys, whatever the size of the tables.
    return docs.select("doc_id", "source", "text").join(F.broadcast(chosen), "doc_id").drop("doc_id")


def _log_shares(counts: DataFrame, keys: list[str], domains: list[str], smoothing: Column) -> DataFrame:
    """Columns ``l_<i>``: log share of each domain's count that falls on a key."""
    wide = counts.groupBy(*keys).agg(
        *(F.sum(F.when(F.col("domain") == d, F.col("n")).otherwise(0)).alias(f"n_{i}") for i, d in enumerate(domains))
    )
    return wide.select(*keys, *(F.log(F.col(f"n_{i}") + smoothing).alias(f"l_{i}") for i in range(len(domains))))


def domain_posteriors(
    spark: SparkSession, docs: DataFrame, labelled: DataFrame, domains: list[str], cfg: MixConfig, scratch: Scratch
) -> DataFrame:
    """``row, doc_id, source, n_tokens`` and ``p_0 .. p_n``: one row per row of ``docs``.

    ``row`` numbers the rows of this table. Texts without words keep the prior of their source.
    """
    k = range(len(domains))
    sample = scratch.keep(labelled_sample(docs, labelled, domains, cfg), "sample")
    totals = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    n_all = sum(totals.values())
    overall = [(totals.get(d, 0) + 1) / (n_all + len(domains)) for d in domains]

    words = sample.select("domain", F.explode(space_words(F.col("text"))).alias("word")).where("word != ''")
    counts = words.groupBy(_bucket(F.col("word"), cfg).alias("bucket"), "domain").agg(F.count("*").alias("n"))
    # One row per bucket: bounded by cfg.buckets.
    likely = scratch.keep(_log_shares(counts, ["bucket"], domains, F.lit(0.5)), "likelihood")
    sums = likely.agg(*(F.sum(F.exp(f"l_{i}")).alias(f"s_{i}") for i in k)).first()
    size = [F.log(F.lit(float(sums[f"s_{i}"] or 1.0))) for i in k]
    likely = likely.select("bucket", *((F.col(f"l_{i}") - size[i]).alias(f"l_{i}") for i in k))

    # One row per source of the sample: bounded by cfg.labelled.
    by_source = sample.groupBy("source", "domain").agg(F.count("*").alias("n"))
    priors = by_source.groupBy("source").agg(
        F.sum("n").alias("n"),
        *(F.sum(F.when(F.col("domain") == d, F.col("n")).otherwise(0)).alias(f"n_{i}") for i, d in enumerate(domains)),
    ).where("source is not null").select(
        "source",
        *(
            F.log((F.col(f"n_{i}") + cfg.prior_weight * overall[i]) / (F.col("n") + cfg.prior_weight)).alias(f"prior_{i}")
            for i in k
        ),
    )
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "source", "text"
    )
    spoken = rows.select("row", "doc_id", "source", F.explode(space_words(F.col("text"))).alias("word")).withColumn(
        "bucket", F.when(F.col("word") != "", _bucket(F.col("word"), cfg))
    )
    known = spoken.join(F.broadcast(likely), "bucket", "left")
    # A task reads a text as a whole, so one row per document leaves it.
    evidence = known.groupBy("row", "doc_id", "source").agg(
        F.count("bucket").alias("n_tokens"), F.count("l_0").alias("n_known"), *(F.sum(f"l_{i}").alias(f"l_{i}") for i in k)
    )
    weight = F.lit(cfg.evidence) / (F.col("n_known") + cfg.evidence)
    score = [
        F.coalesce(F.col(f"prior_{i}"), F.log(F.lit(overall[i]))) + F.coalesce(F.col(f"l_{i}") * weight, F.lit(0.0))
        for i in k
    ]
    scored = evidence.join(F.broadcast(priors), "source", "left").select(
        "row", "doc_id", "source", "n_tokens", *(s.alias(f"s_{i}") for i, s in enumerate(score))
    )
    top = F.greatest(*(F.col(f"s_{i}") for i in k)) if len(domains) > 1 else F.col("s_0")
    odds = scored.select("row", "doc_id", "source", "n_tokens", *(F.exp(F.col(f"s_{i}") - top).alias(f"e_{i}") for i in k))
    total = sum((F.col(f"e_{i}") for i in k), F.lit(0.0))
    return scratch.keep(
        odds.select("row", "doc_id", "source", "n_tokens", *((F.col(f"e_{i}") / total).alias(f"p_{i}") for i in k)),
        "posteriors",
    )


def fit_rates(
    posteriors: DataFrame, targets: list[float], cfg: MixConfig, scratch: Scratch
) -> tuple[DataFrame, float]:
    """``posteriors`` with a ``rate`` for every document, and the largest miss left, as a share of its target.

    The budget is the least number of tokens with which the mixture needs to
    thin out no domain, so rates below 1 come from shared membership only; rates
    are projected on ``cfg.least`` to ``cfg.most``. Minimises the squared misses of all
    domains, each in units of its own curvature. Targets that no rates between the
    two bounds reach, and those that ``cfg.steps`` steps don't, show in the miss.
    """
    k = range(len(targets))
    tokens = F.col("n_tokens")
    products = {
        (i, j): F.sum(tokens * F.col(f"p_{i}") * F.col(f"p_{j}")).alias(f"m_{i}_{j}") for i in k for j in k if i <= j
    }
    first = posteriors.agg(*(F.sum(tokens * F.col(f"p_{i}")).alias(f"s_{i}") for i in k), *products.values()).first()
    have = [first[f"s_{i}"] or 0.0 for i in k]
    curve = [max(first[f"m_{i}_{i}"] or 0.0, 1e-9) for i in k]
    # Rows of the scaled curvature add up to a bound of its largest eigenvalue.
    step = 1 / max(
        sum((first[f"m_{min(i, j)}_{max(i, j)}"] or 0.0) / (curve[i] * curve[j]) ** 0.5 for j in k) or 1.0 for i in k
    )
    wanted_sum = sum(targets)
    budget = cfg.headroom * max((have[i] * wanted_sum / targets[i] for i in k if targets[i] > 0), default=0.0)
    wanted = [budget * t / wanted_sum for t in targets]

    if not wanted_sum or not any(have):
        return posteriors.withColumn("rate", F.lit(1.0)), 0.0
    current, pending, written = posteriors.withColumn("rate", F.lit(1.0)), [], None
    for turn in range(cfg.steps + 1):
        sums = current.agg(*(F.sum(F.col("rate") * tokens * F.col(f"p_{i}")).alias(f"s_{i}") for i in k)).first()
        miss = [(sums[f"s_{i}"] or 0.0) - wanted[i] for i in k]
        # A domain that is not wanted misses by its share of all tokens.
        largest = max(abs(m) / (w if w > 0 else budget) for m, w in zip(miss, wanted))
        if largest <= cfg.tolerance or turn == cfg.steps:
            break
        down = sum((F.col(f"p_{i}") * (step * miss[i] / curve[i]) for i in k), F.lit(0.0))
        current = current.withColumn("rate", F.least(F.greatest(F.col("rate") - down, F.lit(cfg.least)), F.lit(cfg.most)))
        pending.append(turn)
        if len(pending) == cfg.unwritten:
            name = f"rates-{turn}"
            current = scratch.keep(current, name)
            if written:
                scratch.drop(written)
            pending, written = [], name
    return current, largest


def mix_documents(
    spark: SparkSession,
    docs: DataFrame,
    labelled: DataFrame,
    targets: Mapping[str, float],
    cfg: MixConfig = MixConfig(),
) -> DataFrame:
    """Rates that bring ``docs`` to the ``targets`` (domain to share of tokens).

    ``labelled`` has doc_id and domain. One row per row of ``docs``: doc_id,
    source, n_tokens, ``p_<domain>`` for every target, rate and ``copies`` (the rate
    rounded up or down by a hash of doc_id and row, so that its expectation is the rate), and for the whole
    fit ``largest_miss``, the largest miss of a domain as a share of its target, and ``converged``, whether
    that is within the tolerance. A target that cannot be met, like one for a domain that no document belongs to,
    is missed and says so; no document has more than ``cfg.most`` copies.
    Null and empty texts have no tokens and the posterior of their source; null
    sources and sources without labels have the overall prior. Repeated rows each have a
    rate of their own. Without labelled rows all posteriors are equal.
    """
    scratch = Scratch(spark, "mixing")
    domains = list(targets)
    posteriors = domain_posteriors(spark, docs, labelled, domains, cfg, scratch)
    rates, miss = fit_rates(posteriors, [targets[d] for d in domains], cfg, scratch)
    share = F.pmod(F.xxhash64("doc_id", "row", F.lit(cfg.seed)), F.lit(1 << 30)) / float(1 << 30)
    copies = (F.floor("rate") + (share < F.col("rate") - F.floor("rate")).cast("long")).cast("long")
    return rates.select(
        "doc_id", "source", "n_tokens", *(F.col(f"p_{i}").alias(f"p_{d}") for i, d in enumerate(domains)), "rate",
        copies.alias("copies"), F.lit(miss).alias("largest_miss"), F.lit(miss <= cfg.tolerance).alias("converged"),
    )
