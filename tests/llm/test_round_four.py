"""op12: anchors meet all rows without passing through the driver."""

from collections import Counter

from tidepool.llm import hard_negatives as H

from .test_round_three import VECTORS, plain_negatives, vector_rows


def test_no_anchors_are_broadcast(spark, monkeypatch):
    """However small the anchors' table looks, as with equal vectors; several parts and blocks of both sides."""
    for name, n in (("PART_ROWS", 40), ("BLOCK_ROWS", 16), ("BLOCK_ANCHORS", 4), ("PART_ANCHORS", 8), ("LEAST_ANCHORS", 3), ("GROUP_ROWS", 30)):
        monkeypatch.setattr(H, name, n, raising=False)
    plans, search = [], H._search
    monkeypatch.setattr(H, "_search", lambda pairs, *rest: plans.append(pairs._jdf.queryExecution().executedPlan().toString()) or search(pairs, *rest))
    rows = vector_rows(8, 60)
    rows += [(20_000 + 100 * i, rows[3][1], i % 2, None, None) for i in range(30)]
    got = H.mine_embeddings(spark.createDataFrame(rows, VECTORS))
    assert Counter(map(tuple, got.collect())) == plain_negatives(rows)
    assert len(plans) == 2 and not any("Broadcast" in p for p in plans)
