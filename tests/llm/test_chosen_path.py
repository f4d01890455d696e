"""The chosen-path join against brute force: sketches, hubs, deep nodes, edge cases, the whole query."""

import random
import re

import numpy as np
import pytest

from riskloom.llm import chosen_path
from riskloom.llm.jaccard import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=4):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1)))


def brute(rows, percent=80):
    """Sorted (doc_id, n, component, kept) by comparing all pairs of different sets."""
    null = -(2**63)
    sets = [(null if i is None else i, shingles(text)) for i, text in rows]
    distinct = sorted({s for _, s in sets if s}, key=len)
    parent = {s: s for s in distinct}

    def root(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if len(a) * 100 < len(b) * percent:
                break
            common = len(a & b)
            if 100 * common >= percent * (len(a) + len(b) - common) and root(a) is not root(b):
                parent[root(a)] = root(b)
    least = {}
    for key, s in sets:
        if s:
            least[root(s)] = min(least.get(root(s), key), key)
    plain = lambda key: None if key == null else key
    out = [(key, len(s), least[root(s)] if s else key) for key, s in sets]
    return ordered((plain(key), n, plain(low), key == low) for key, n, low in out)


def ordered(rows):
    return sorted((tuple(row) for row in rows), key=str)


def test_sketches_agree_as_often_as_sets_are_similar():
    import pyarrow as pa

    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join(words[:320] + [f"x{i}" for i in range(80)])]
    agree = []
    for shift in range(30):
        changed = [text.replace("w", f"w{shift}_").replace("x", f"x{shift}_") for text in texts]
        ((_, found, edges),) = shingle_sets(pa.array(changed), 4)
        a, b = chosen_path.sketches(found, edges)
        agree.append((a == b).mean())
    similar = 317 / (397 * 2 - 317)
    assert abs(np.mean(agree) - similar) < 0.03
    assert 0.03 < np.std(agree) < 0.1  # as of 64 independent coordinates


def test_a_node_never_chooses_a_coordinate_twice_and_branches_as_wanted():
    rng = np.random.default_rng(1)
    node, used = rng.integers(0, 2**63, 20_000).astype(np.uint64), np.zeros(20_000, np.uint64)
    sketch = rng.integers(0, 2**32, (20_000, 64)).astype(np.uint32)
    children = 0
    for _ in range(10):
        parts = chosen_path.branched(node, used, sketch, 80)
        children = sum(len(row) for row, _, _ in parts)
        assert abs(children / len(node) - 1.25) < 0.02
        row, node, taken = parts[0]
        assert (np.bitwise_count(taken) == np.bitwise_count(used[row]) + 1).all()
        used = taken


def edited(rng, words, share):
    return [rng.choice("uvwxyz") * 3 + str(rng.random()) if rng.random() < share else word for word in words]


@pytest.mark.parametrize("small", [False, True])
def test_groups_of_near_copies(spark, monkeypatch, small):
    """Chains of edits, a large group around one text, and texts that share long passages."""
    if small:  # nearly all nodes have to branch or get a hub
        monkeypatch.setattr(chosen_path, "STAR", 0.4)
        monkeypatch.setattr(chosen_path, "OPEN", 0.4)
        monkeypatch.setattr(chosen_path, "BLOCK", 2)
        monkeypatch.setattr(chosen_path, "DEPTH", 2)
    rng = random.Random(5)
    base = [f"b{rng.randrange(3000)}" for _ in range(150)]
    texts = [" ".join(edited(rng, base, 0.01)) for _ in range(150)]
    chain = [f"c{i}" for i in range(120)]
    for step in range(30):
        chain = chain[3:] + [f"n{step}_{i}" for i in range(3)]
        texts.append(" ".join(chain))
    for _ in range(60):
        texts.append(" ".join([f"s{i}" for i in range(100)] + [f"o{rng.random()}" for _ in range(rng.randrange(10, 60))]))
    texts += texts[:40] + [text.upper() for text in texts[150:160]]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert ordered(chosen_path.components(frame).collect()) == brute(rows)


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "a b"), (7, "a  b"), (8, "a b c d e f g h")]
    rows += [(9, long), (10, long + " more words here"), (10, long + " more words here"), (None, long), (None, None)]
    rows += [(12, "p q r s t u v w x y z a b c d e"), (12, "p q r s t u v w x y z a b c d e f"), (12, "other text"), (-3, "a B")]
    wide = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, key string, sid int, n int")
    assert ordered(chosen_path.components(wide).collect()) == brute(rows)
    assert chosen_path.components(wide.where("false")).count() == 0


def test_query_equals_brute_force(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = chosen_path.query(spark, folder)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert ordered(found.collect()) == brute([tuple(row) for row in rows])
