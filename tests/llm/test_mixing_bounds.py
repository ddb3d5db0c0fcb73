"""Targets that cannot be met, and the bounds of the rates."""

import pytest

from thumbwheel.llm import mixing

DOCS = "doc_id long, source string, text string"


def corpus(spark, n=300):
    rows = [(i, "s" + str(i % 3), "alpha beta gamma " * 5 if i % 2 else "uno dos tres " * 5) for i in range(n)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(0, n, 3)], "doc_id long, domain string")


def test_a_domain_without_documents_is_missed_and_nothing_explodes(spark):
    docs, labelled = corpus(spark)
    out = mixing.mix_documents(spark, docs, labelled, {"a": 0.4, "b": 0.3, "zz": 0.3}).toPandas()
    assert len(out) == 300 and not out.converged.any() and out.largest_miss.nunique() == 1
    assert out.rate.max() <= 64 and out.copies.max() <= 64


def test_targets_in_reach_converge(spark):
    docs, labelled = corpus(spark)
    out = mixing.mix_documents(spark, docs, labelled, {"a": 0.4, "b": 0.6}).toPandas()
    assert out.converged.all() and out.largest_miss.max() <= mixing.MixConfig().tolerance
    tight = mixing.mix_documents(spark, docs, labelled, {"a": 0.1, "b": 0.9}, mixing.MixConfig(most=2.0)).toPandas()
    assert tight.rate.max() <= 2.0 and not tight.converged.any()


def test_few_steps_say_that_they_were_too_few(spark):
    docs, labelled = corpus(spark, 60)
    out = mixing.mix_documents(spark, docs, labelled, {"a": 0.1, "b": 0.9}, mixing.MixConfig(steps=1)).toPandas()
    assert len(out) == 60 and out.largest_miss.iloc[0] > 0.002 and not out.converged.any()
    none = mixing.mix_documents(spark, docs, labelled, {"a": 0.0, "b": 0.0}).toPandas()
    assert (none.rate == 1.0).all()


def test_extra_columns_with_clashing_names(spark):
    docs, labelled = corpus(spark, 40)
    extra = docs.selectExpr("*", "1 row", "2 rate", "'x' copies", "3 l_0", "4 p_0", "5 n_tokens")
    out = mixing.mix_documents(spark, extra, labelled.selectExpr("*", "7 source", "8 text"), {"a": 0.5, "b": 0.5})
    assert out.count() == 40
