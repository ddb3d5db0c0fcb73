"""Plan checks over all registered queries."""

import re

import pytest

from helpers import plan
from workload.queries import REGISTRY

PYTHON_ALLOWED = {
    "batch_generate", "batch_judge", "batch_score",
    "generate_completions", "judge_against_reference", "judge_matches", "tokenize_plugin",
}
BATCH = sorted(n for n in REGISTRY if not n.startswith("stream_"))


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    return {n: plan(REGISTRY[n](spark, sf_dir)) for n in BATCH}


def test_no_cross_joins(plans):
    assert [n for n, p in plans.items() if re.search("CartesianProduct|NestedLoopJoin", p)] == []


def test_python_only_where_models_plug_in(plans):
    used = {n for n, p in plans.items() if re.search("MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroups", p)}
    assert used == PYTHON_ALLOWED


def test_only_totals_meet_in_one_task(plans):
    """A single-partition exchange sits directly on a partial aggregate or on aggregated totals."""
    bad = []
    for name, p in plans.items():
        lines = p.split("\n")
        for line, below in zip(lines, lines[1:]):
            if "Exchange SinglePartition" in line and not re.search(r"Aggregate\(keys?=", below):
                bad.append((name, below.strip()[:200]))
    assert bad == []
