"""Every query finds k neighbours, however few its nearest leaves hold."""

import numpy as np
from pyspark.sql import functions as F

from thumbwheel.llm import ann


def test_leaves_with_few_rows_are_not_the_end(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 8))
    vectors = np.repeat(centres, 3, axis=0) + rng.normal(size=(120, 8)) * 0.01
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    # Leaves of about three rows, and a calibration that is content with the first of them.
    cfg = ann.AnnConfig(leaf_sample=3, branching=4, recall=0.05, block=16)
    out = ann.search(spark, df, F.lit(True), cfg).collect()
    ranks = {}
    for r in out:
        ranks.setdefault(r.query_id, []).append(r["rank"])
    assert set(ranks) == set(range(120)) and all(sorted(x) == [1, 2, 3, 4, 5] for x in ranks.values())
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    assert all(abs(r.score - unit[r.query_id] @ unit[r.vec_id]) < 1e-12 for r in out)


def test_the_queue_goes_on_until_enough_rows_are_held():
    tree = ann.build_tree(np.eye(8), ann.AnnConfig(leaf_sample=1, branching=8))
    order = ann.leaves_in_order(tree, np.eye(8)[0])
    held = {leaf: 1 for leaf in order}
    assert ann.leaves_in_order(tree, np.eye(8)[0], 2, held, 6) == order[:6]
    assert ann.leaves_in_order(tree, np.eye(8)[0], 7, held, 6) == order[:7]
    assert ann.leaves_in_order(tree, np.eye(8)[0], 1, {}, 6) == order
