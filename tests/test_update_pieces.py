from thumbwheel.operators import ordering
from workload.queries import REGISTRY


def test_an_update_is_ranked_in_pieces(spark, sf_dir, monkeypatch):
    """No task ranks a whole update: the number of pieces follows the shuffle partitions."""
    real, seen = ordering.shuffle_batches, []
    monkeypatch.setattr(ordering, "shuffle_batches", lambda *a, **k: seen.append(k.get("buckets")) or real(*a, **k))
    assert REGISTRY["shuffle_within_updates"](spark, sf_dir).count() > 0 and seen == [None]
