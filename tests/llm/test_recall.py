"""Recall of the permutation index where the share of a block, not the least number, rules."""

import numpy as np

from riskloom.llm import permutation


def test_recall_on_one_block_of_several_thousand_rows(spark, monkeypatch):
    monkeypatch.setattr(permutation, "LEAST", 8)
    monkeypatch.setattr(permutation, "blocks_for", lambda rows: 1)
    random = np.random.default_rng(4)
    centres = random.normal(size=(60, 32))
    x = centres[random.integers(0, 60, 3000)] + 0.6 * random.normal(size=(3000, 32))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>")
    found = permutation.search(rows, rows.where("id % 50 = 0"), 5).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 3000, 50):
        cosine = unit @ unit[q]
        cosine[q] = -2
        hits += len(set(np.argsort(-cosine)[:5].tolist()) & {r.vec_id for r in found if r.query_id == q})
    assert hits >= 0.9 * 5 * 60
