"""The queries of this package: registered, right where SQL can tell, and whole."""

import re

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from thumbwheel.llm.queries import QUERIES
from workload.compare import compare, duckdb_connection


def test_each_operator_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and set(QUERIES) | {"pipeline"} <= set(queries())


@pytest.mark.parametrize("name", [
    "op1_warc", "op2_substring_dedup", "op3_near_duplicates", "op10_license_scan", "op12_url_filter", "op13_phrase_mining",
])
def test_query_matches_sql(spark, sf_dir, name):
    assert name in oracle_sql()
    ok, note = compare(spark, duckdb_connection(sf_dir), sf_dir, name)
    assert ok, note


@pytest.mark.parametrize("name,table,key", [
    ("op4_source_mixing", "documents", "doc_id"), ("op5_packing", "documents", "doc_id"),
    ("op7_toxicity", "documents", "doc_id"), ("op8_quality_rules", "documents", "doc_id"),
    ("op9_html_extraction", "pages", "page_id"), ("op11_embedding_whitening", "embeddings", "vec_id"),
])
def test_query_covers_its_table(spark, sf_dir, name, table, key):
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    out = queries()[name](spark, sf_dir)
    assert out.select(key).distinct().count() == rows.count()


def test_pipeline(spark, sf_dir):
    """Every stage against a plain version of its contract on the stage's own input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    frames = []
    for name, stage in corpus_pipeline.STAGES:
        path = corpus_pipeline.scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        frames.append((name, before.toPandas(), docs.toPandas()))
    assert [n for n, _, _ in frames] == [
        "quality rules", "near-duplicate removal", "substring removal", "source mixing", "packing",
    ]
    assert all(list(after.columns) == columns for _, _, after in frames[:-1])

    from tests_llm_brute import components, passages

    _, before, after = frames[0]
    words = before.text.fillna("").map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t)))
    assert set(after.doc_id) <= set(before.doc_id[words >= 10]) and len(after) > 0.75 * len(before)
    _, before, after = frames[1]
    # The stage's near copies share 80 % of their shingles; 85 % is the contract of op3's query.
    roots = components(list(zip(before.doc_id, before.text)), percent=80)
    assert set(after.doc_id) == set(roots.values()) and len(after) == len(set(after.doc_id))
    _, before, after = frames[2]
    kept = {d: t for d, n, gone, t in passages(list(zip(before.doc_id, before.text))) if gone < n}
    assert set(after.doc_id) == set(kept)
    assert all(" ".join(t.encode().split() and [w.decode() for w in t.encode().split()]) == kept[d] for d, t in zip(after.doc_id, after.text))
    _, before, after = frames[3]
    assert set(after.doc_id) <= set(before.doc_id) and len(after) >= 0.99 * len(before)
    times = after.groupby("doc_id").size()
    assert times.groupby(before.set_index("doc_id").lang.reindex(times.index)).mean().max() > 1.05
    _, before, after = frames[4]
    assert set(after.doc_id) == set(before.doc_id)
    sizes = after.groupby("sequence_id").length.sum().sort_index()
    assert (sizes.iloc[:-1] == 2048).all()


def test_pipeline_over_odd_rows(spark):
    """Nulls, empty and repeated rows go through every stage; an empty table stays empty."""
    folder = corpus_pipeline.scratch_path(spark, "odd")
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text, "en", "s", 3), (1, text, "en", "s", 3), (2, text + " more", "de", None, None),
            (3, None, None, "s", None), (4, "", "en", "s", 0), (None, "other " * 3 + text[::-1], None, None, None),
            (None, text.upper(), "en", "s", 1), (5, "\n".join(f"line {i} of many" for i in range(9)), "fr", "t", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, 1, 0) for i in (1, 2, 5)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    empty = docs.limit(0)
    for name, step in corpus_pipeline.STAGES:
        seen.append(sorted((r.doc_id or 0) for r in step(spark, docs, folder).select("doc_id").collect()))
        out = corpus_pipeline.scratch_path(spark, "odd-stage")
        step(spark, docs, folder).write.parquet(out)
        docs = spark.read.parquet(out)
        assert step(spark, empty, folder).count() == 0
    assert seen[0] == [0, 0, 1, 1, 2, 5] and seen[1] == [0, 0, 1, 5]
    assert seen[2] == [0, 0, 1, 5] and set(seen[3]) == {0, 1, 5} == set(seen[4])
