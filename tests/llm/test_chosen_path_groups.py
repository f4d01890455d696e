"""Groups of near copies in the chosen-path join: few candidates, exact exclusions, nodes below the first level."""

import random

import numpy as np
import pyarrow as pa

from riskloom.llm import chosen_path
from riskloom.llm.jaccard import parities, shingle_sets
from tests.llm.test_chosen_path import brute, ordered


def group(rng, size, words=120, most=0.06):
    """Copies of one text with up to this share of its words replaced: about half of their pairs link."""
    base = [f"b{i}" for i in range(words)]
    out = []
    for _ in range(size):
        share = rng.random() * most
        out.append(" ".join(f"r{rng.random()}" if rng.random() < share else word for word in base))
    return out


def test_candidates_of_a_group_grow_with_its_members(spark, monkeypatch):
    joins, start = [], chosen_path.Join.__init__
    monkeypatch.setattr(chosen_path.Join, "__init__", lambda self, *args: (start(self, *args), joins.append(self))[0])
    rows = list(enumerate(group(random.Random(3), 400)))
    found = chosen_path.components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert ordered(found.collect()) == brute(rows)
    assert joins[0].tried.count() < 8 * len(rows)  # of 79,800 pairs


def test_nodes_below_the_first_level(spark, monkeypatch):
    for name, value in (("STAR", 0.4), ("OPEN", 0.4), ("BLOCK", 8), ("DEPTH", 4)):
        monkeypatch.setattr(chosen_path, name, value)
    rng = random.Random(7)
    rows = list(enumerate(group(rng, 60, most=0.12) + group(rng, 30, words=40, most=0.1)))
    found = chosen_path.components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert ordered(found.collect()) == brute(rows)


def test_parities_exclude_no_link_and_most_others():
    rng = random.Random(11)
    texts = group(rng, 80) + group(rng, 20, words=1600, most=0.08)
    ((_, found, edges),) = shingle_sets(pa.array(["", *texts]), 4)
    sets = [set(found[a:b].tolist()) for a, b in zip(edges[:-1], edges[1:])][1:]
    bits, n = parities(found, edges).slice(1), np.diff(edges)[1:]  # a slice, as of a cell
    x, y = np.triu_indices(len(sets), 1)
    similar = np.array([len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in zip(x, y)])
    near = chosen_path._near(x, y, n, bits, 80)
    assert near[similar >= 0.8].all() and (similar >= 0.8).sum() > 200
    far = (similar < 0.7) & (n[x] < 1500) & (n[y] < 1500)
    assert far.sum() > 200 and near[far].mean() < 0.02


def test_spanning_forest_takes_the_most_alike():
    rng = np.random.default_rng(2)
    x, y = np.triu_indices(40, 1)
    kept = (rng.random(len(x)) < 0.3) & ((x < 25) == (y < 25))  # two trees
    x, y = x[kept] * 3, y[kept] * 3
    weight = rng.integers(36, 65, len(x)).astype(np.uint8)
    found = chosen_path.spanning(x, y, weight)

    def kruskal():
        root, total, pairs = {i: i for i in [*x, *y]}, 0, 0
        for at in np.argsort(-weight.astype(int), kind="stable"):
            if root[x[at]] != root[y[at]]:
                old, new = root[x[at]], root[y[at]]
                root = {i: new if r == old else r for i, r in root.items()}
                total, pairs = total + int(weight[at]), pairs + 1
        return total, pairs

    assert (int(weight[found].sum()), len(found)) == kruskal()
    assert len(chosen_path.spanning(x[:0], y[:0], weight[:0])) == 0
