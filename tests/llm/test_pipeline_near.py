"""The near-duplicate stage of the pipeline removes near copies from a similarity of 0.80 on."""

import corpus_pipeline
from tests_llm_brute import components


def test_stage_at_80(spark, sf_dir):
    """Copies that share 92, 80 and 79 of 100 shingles: the last stays."""
    words = [f"w{i}" for i in range(94)]  # 90 shingles
    near = lambda tag, keep: " ".join(words[:keep] + [f"{tag}{i}" for i in range(94 - keep)])
    # k shared words give k - 4 shared shingles out of 180 - (k - 4): 80 of 100 at 84, 79 of 101 at 83.
    rows = [(1, near("a", 94)), (2, near("b", 84)), (3, near("c", 83)), (4, near("d", 90))]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert set(components(rows, 80).values()) == {1, 3}
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()} == {1, 3}


def test_stage_over_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, sf_dir).toPandas()
    roots = components(list(zip(kept.doc_id, kept.text)), 80)
    out = [r.doc_id for r in corpus_pipeline.near_dedup(spark, spark.createDataFrame(kept), sf_dir).collect()]
    assert sorted(out) == sorted(set(roots.values()))
