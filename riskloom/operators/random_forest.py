"""Random forest on binned features, grown and applied as Spark jobs (M6).

Every feature is cut into at most ``BINS`` bins at exact quantiles of the training rows. A row's
weight in a tree is a Poisson(1) draw by the hash of the row and the tree, so a forest depends on
rows and seed only. Nodes of over ``LOCAL`` rows are split level by level: tasks count the classes
of every bin, the counts are added by node, and the driver learns the chosen splits. The rows below
such a node are then dealt by (tree, node) and each group, of at most about ``LOCAL`` rows, grows
its subtree (see :mod:`growth`). Both ways choose the same splits, as counts are whole numbers.

Subtrees stay a table in the shared folder, since their size grows with the rows. Rows that are scored are
dealt to the subtrees too: once for each ``BUNDLE`` of trees that are a subtree each, else by (tree, node).
Shares are multiples of ``1 / UNIT``, so that their sums are exact and do not depend on the order.

A node draws sqrt(features), rounded up, of those that differ among its rows, and takes the split of
least Gini impurity, ties to the first one drawn and the smallest bin. A node of one class, of
equal rows or at the depth limit is a leaf.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import growth
from riskloom.operators.growth import BINS, GOLDEN, drawn, joined, leaves, mix, pack, seen_in
from riskloom.operators.growth import children_keys as _children
from riskloom.operators.ordered import running, sliced
from riskloom.session import pinned

LOCAL = 6_000_000  # 8 bytes each with up to seven features
OPEN_NODES = 4096  # whose counts a task holds at once: below 4 kB each with seven features
BUNDLE = 4
UNIT = 2.0**42  # sums of up to 2,048 shares are exact
# Least 53-bit draws that give weights of 1 to 15.
_POISSON = [math.ceil(p * 2**53) for p in np.cumsum([math.exp(-1) / math.factorial(k) for k in range(15)])]


def grow(x: np.ndarray, seen: np.ndarray, key: int, levels: int, weights) -> tuple[np.ndarray, ...]:
    """Feature (-1: leaf), bin, left child and share of class 1 of every node below one.

    ``x`` has a line of bins per feature, ``seen`` is 16 * class + weight of each row.
    """
    return growth.grow(seen_in(pack(x), seen), len(x), key, levels, weights)


@dataclass(frozen=True)
class RandomForest:
    """``top``: the nodes that are no subtree, roots first; ``subtrees``: (node, the arrays of :func:`grow`)."""

    columns: tuple[str, ...]
    cuts: list[np.ndarray]
    trees: int
    top: tuple[np.ndarray, ...]
    below: np.ndarray
    subtrees: DataFrame


def _cuts(rows: DataFrame, n: int, columns: Sequence[str]) -> list[np.ndarray]:
    """Upper ends of all bins but the last: every value if there are few, else the exact quantiles."""
    if n <= LOCAL:
        return _ranked_cuts(rows, columns)
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).alias("v")) for i, c in enumerate(columns)]))
    counts = pinned(rows.select(values.alias("s")).groupBy("s.f", "s.v").agg(F.count(F.lit(1)).alias("n")))
    distinct = {row.f: row["count"] for row in counts.groupBy("f").count().collect()}
    few = [f for f, values in distinct.items() if values <= BINS]
    many = counts.where(~F.col("f").isin(few))
    upto = running(sliced(many, ["f", "v"]), ["f"], ["v"], sums={"upto": "n"})
    # The first value at or beyond each quantile: at most BINS + 1 rows a feature.
    found = upto.groupBy("f", F.expr(f"upto * {BINS} div {n}").alias("i")).agg(F.min("v").alias("v"))
    found = found.where(f"i BETWEEN 1 AND {BINS - 1}").select("f", "v") if len(few) < len(distinct) else counts.limit(0).select("f", "v")
    found = found.union(counts.where(F.col("f").isin(few)).select("f", "v")) if few else found
    cuts: dict[int, list[float]] = {f: [] for f in range(len(columns))}
    for row in found.collect():
        cuts[row.f].append(row.v)
    return [np.unique(cuts[f])[: -1 if f in few else None] for f in range(len(columns))]


def _ranked_cuts(rows: DataFrame, columns: Sequence[str]) -> list[np.ndarray]:
    """The same for rows of which one task can sort a feature: 8 bytes each."""

    def stack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"f": range(len(columns)), "v": [batch[name].to_numpy(float).tobytes() for name in columns]})

    def rank(group: pd.DataFrame) -> pd.DataFrame:
        values = np.frombuffer(bytearray().join(group.pop("v")))
        values.sort()
        last = np.append(values[1:] != values[:-1], True)  # of its equals
        if np.count_nonzero(last) <= BINS:
            cuts = values[last][:-1]
        else:
            # From which place on a value ends at or beyond a quantile.
            least = -(-np.arange(1, BINS) * len(values) // BINS)
            cuts = np.unique(values[least - 1])
            cuts = cuts[cuts < values[-1]]
        return pd.DataFrame({"f": group["f"].iloc[:1], "v": [cuts.tobytes()]})

    stacked = _spread(rows.select(*columns).mapInPandas(stack, "f int, v binary"), "f", len(columns))
    found = {row.f: np.frombuffer(row.v) for row in stacked.groupBy("f").applyInPandas(rank, "f int, v binary").collect()}
    return [found.get(f, np.empty(0)) for f in range(len(columns))]


def _binned(batch: pd.DataFrame, columns: Sequence[str], cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, batch[name].to_numpy(float), "left") for name, c in zip(columns, cuts)]).astype(np.uint8)


def _bagged(batch: pd.DataFrame, seed: int, tree: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows that are in a tree, and 16 * class + weight."""
    salt = mix(np.array([seed * 1_000_003 + tree + 1], np.uint64) * GOLDEN)
    chance = mix(batch["h"].to_numpy().view(np.uint64) ^ salt) >> np.uint64(11)
    place = np.flatnonzero(chance >= _POISSON[0])
    seen, chance = 16 * (batch["label"].to_numpy() == 1).take(place).astype(np.uint8), chance.take(place)
    for least in _POISSON:
        seen += chance >= least
    return place, seen


def _by_node(at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(at, kind="stable")
    for places in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
        if len(places):
            yield int(at[places[0]]), places


def _split_top(rows: DataFrame, columns, cuts, top, wanted: np.ndarray, keys: np.ndarray, trees: int, seed: int, weights):
    """(node, feature, bin, rows of both classes on the left, and on the right) of some large nodes; feature -1 at a leaf."""
    shared = rows.sparkSession.sparkContext.broadcast((top, wanted, keys))
    width = len(columns)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nodes, wanted, _ = shared.value
        number = np.full(len(nodes[0]), -1)
        number[wanted] = np.arange(len(wanted))
        found = np.zeros(len(wanted) * width * BINS * 2, np.int64)
        for batch in batches:
            x = _binned(batch, columns, cuts)
            for tree in range(trees):
                place, seen = _bagged(batch, seed, tree)
                own = number[leaves(nodes, x[:, place], np.full(len(place), tree))]
                place, seen, own = place[own >= 0], seen[own >= 0], own[own >= 0]
                for f in range(width if len(own) else 0):
                    np.add.at(found, ((own * width + f) * BINS + x[f, place]) * 2 + (seen > 15), (seen & 15).astype(np.int64))
        found = found.reshape(len(wanted), -1)
        some = np.flatnonzero(found.any(1))
        yield pd.DataFrame({"node": wanted[some].astype(np.int32), "counts": [line.tobytes() for line in found[some]]})

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        node = int(group["node"].iloc[0])
        counts = sum(np.frombuffer(part, np.int64) for part in group["counts"]).reshape(width, BINS, 2)
        total, constant = counts[0].sum(0), (counts.sum(2) > 0).sum(1) < 2
        result = [node, -1, 0, *total.tolist(), 0, 0]
        if total.all() and not constant.all():
            chosen = drawn(shared.value[2][[node]], constant[None])
            (turn,), (cut,), lefts = growth.best(joined(*counts[chosen].transpose(3, 0, 1, 2)), chosen >= 0, weights)
            result = [node, int(chosen[0, turn]), int(cut), *lefts[:, 0].tolist(), *(total - lefts[:, 0]).tolist()]
        return pd.DataFrame([result], columns=["node", "feature", "cut", "l0", "l1", "r0", "r1"])

    counted = rows.mapInPandas(count, "node int, counts binary").groupBy("node")
    return counted.applyInPandas(choose, "node int, feature int, cut int, l0 long, l1 long, r0 long, r1 long").collect()


def _top(rows: DataFrame, n: int, columns, cuts, trees: int, depth: int, seed: int, weights):
    """Nodes above the subtrees, which of them are the roots of subtrees, keys and depths."""
    feature, cut, left = [-1] * trees, [0] * trees, [0] * trees
    share, level, size = [0.0] * trees, [0] * trees, [n] * trees
    keys = list(mix(np.arange(1, trees + 1, dtype=np.uint64) * GOLDEN ^ np.uint64(seed)))
    leaf = [False] * trees

    def arrays():
        return np.array(feature, np.int16), np.array(cut, np.uint8), np.array(left, np.int32), np.rint(np.array(share) * UNIT) / UNIT

    large = list(range(trees)) if n > LOCAL and depth else []
    while large:
        some, large = large[:OPEN_NODES], large[OPEN_NODES:]
        wanted = np.array(some)
        found = _split_top(rows, columns, cuts, arrays(), wanted, np.array(keys, np.uint64), trees, seed, weights)
        for row in sorted(found, key=lambda row: row.node):
            at, sides = row.node, [(row.l0, row.l1), (row.r0, row.r1)]
            if row.feature < 0:
                leaf[at], (zeros, ones) = True, sides[0]
                share[at] = weights[1] * ones / (weights[1] * ones + weights[0] * zeros)
                continue
            feature[at], cut[at], left[at] = row.feature, row.cut, len(feature)
            for (zeros, ones), key in zip(sides, _children(np.array([keys[at]], np.uint64))):
                if zeros + ones > LOCAL and level[at] + 1 < depth:
                    large.append(len(feature))
                for line, value in ((feature, -1), (cut, 0), (left, 0), (keys, key), (level, level[at] + 1), (size, zeros + ones)):
                    line.append(value)
                share.append(weights[1] * ones / (weights[1] * ones + weights[0] * zeros))
                leaf.append(level[-1] >= depth)
    below = (np.array(feature) < 0) & ~np.array(leaf)
    return arrays(), below, np.array(keys, np.uint64), np.array(level)


def fit(train: DataFrame, columns: Sequence[str], keys: Sequence[str], weights, partitions: int, trees: int, depth: int, seed: int) -> RandomForest:
    """``keys`` tell rows apart, as well as can be; ``weights`` are those of classes 0 and 1."""
    columns, keys = list(columns), list(keys)
    values = [F.col(name).cast("double").alias(name) for name in columns]
    # Rows that are equal in everything get numbers, so that each one is drawn for itself.
    plain = train.select(*[name for name in keys if name not in columns], "label", *values)
    copies = F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))).alias("_copy")
    rows = plain.groupBy(*plain.columns).count().select("*", copies)
    named = rows.select(F.xxhash64(*plain.columns, "_copy").alias("h"), "label", *columns)
    rows = pinned(named.repartition(partitions, "h"))
    n = rows.count()
    cuts = _cuts(rows, n, columns)
    top, below, node_keys, levels = _top(rows, n, columns, cuts, trees, depth, seed, weights)
    shared = rows.sparkSession.sparkContext.broadcast((top, below, node_keys, levels))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nodes, below, *_ = shared.value
        for batch in batches:
            x = _binned(batch, columns, cuts)
            packed, dealt = pack(x), []
            for tree in range(trees):
                place, seen = _bagged(batch, seed, tree)
                inside = seen_in(packed.take(place, axis=0), seen)
                if below[tree]:
                    dealt.append((tree, inside.tobytes()))
                    continue
                at = leaves(nodes, x.take(place, axis=1), np.full(len(place), tree))
                dealt += [(node, inside.take(own, axis=0).tobytes()) for node, own in _by_node(at) if below[node]]
            dealt = [part for part in dealt if part[1]]
            yield pd.DataFrame(dealt, columns=["node", "rows"])

    def grow_one(group: pd.DataFrame) -> pd.DataFrame:
        node = int(group["node"].iloc[0])
        rows = np.frombuffer(b"".join(group.pop("rows")), np.int64).reshape(-1, len(columns) // 8 + 1)
        _, _, node_keys, levels = shared.value
        *grown, share = growth.grow(rows, len(columns), int(node_keys[node]), depth - int(levels[node]), weights)
        parts = [part.tobytes() for part in (*grown, np.rint(share * UNIT) / UNIT)]
        return pd.DataFrame([[node, *parts]], columns=["node", "feature", "cut", "left", "share"])

    dealt = _spread(rows.mapInPandas(deal, "node int, rows binary"), "node", int(below.sum()))
    grown = dealt.groupBy("node").applyInPandas(grow_one, "node int, feature binary, cut binary, left binary, share binary")
    return RandomForest(tuple(columns), cuts, trees, top, below, pinned(grown))


def _spread(dealt: DataFrame, by: str, groups: int) -> DataFrame:
    """Dealt by group number in turn, so that no partition holds many more groups than others."""
    parts = max(8 * dealt.sparkSession.sparkContext.defaultParallelism, groups // 8)
    return dealt.repartitionById(max(1, min(groups, parts)), F.col(by))


def probability(forest: RandomForest, df: DataFrame, out: str) -> DataFrame:
    """``df`` with the mean share of class 1 in the leaves of all trees."""
    columns, cuts, trees = list(forest.columns), forest.cuts, forest.trees
    numbered = pinned(df.withColumn("_row", F.monotonically_increasing_id()))
    zero = F.lit(0.0)
    values = [F.coalesce(F.nanvl(F.col(name).cast("double"), zero), zero).alias(name) for name in columns]
    shared = df.sparkSession.sparkContext.broadcast((forest.top, forest.below))
    whole = bool(forest.below[:trees].all())
    together = BUNDLE if whole else 1
    # No group has more than about LOCAL rows; the subtrees go to each slice of them.
    slices = max(1, -(-numbered.count() // LOCAL))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nodes, _ = shared.value
        for batch in batches:
            if not len(batch):
                continue
            x, number = _binned(batch, columns, cuts), batch["_row"].to_numpy()
            packed, chunk, dealt = pack(x), int(number[0]), []
            own = int(mix(number[:1].view(np.uint64))[0]) % slices
            if whole:
                # The first bundle tells which rows these are.
                parts, numbers = packed.tobytes(), [number.tobytes()] + [b""] * trees
                dealt += [(g * slices + own, chunk, numbers[g], parts) for g in range(-(-trees // together))]
            for tree in range(0 if whole else trees):
                for node, at in _by_node(leaves(nodes, x, np.full(len(number), tree))):
                    dealt.append((node * slices + own, chunk, number[at].tobytes(), packed.take(at, axis=0).tobytes()))
            yield pd.DataFrame(dealt, columns=["group", "chunk", "row", "x"])

    def reach(key: tuple, rows: pd.DataFrame, subtrees: pd.DataFrame) -> pd.DataFrame:
        nodes, below = shared.value
        parts = [np.frombuffer(part, np.int64).reshape(-1, len(columns) // 8 + 1) for part in rows.pop("x")]
        shares, first = [np.zeros(len(part)) for part in parts], key[0] // slices * together
        for node in range(first, min(first + together, len(below))) if parts else ():
            found = subtrees[subtrees["node"] == node]
            if len(found):
                kinds = (np.int16, np.uint8, np.int32, np.float64)
                tree = [np.frombuffer(found[name].iloc[0], kind) for name, kind in zip(("feature", "cut", "left", "share"), kinds)]
                steps = growth.steps(tree)
            for part, share in zip(parts, shares):
                if len(found):
                    share += tree[3].take(growth.reached(steps, part))
                else:  # a tree that drew no row, where both classes weigh the same, or a leaf above the subtrees
                    share += 0.5 if below[node] else nodes[3][node]
        return pd.DataFrame({"chunk": rows["chunk"], "row": rows["row"], "share": [share.tobytes() for share in shares]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        number = np.unique(np.frombuffer(b"".join(group["row"]), np.int64))
        total = np.zeros(len(number))
        for row, share in zip(group["row"], group["share"]):
            at = np.searchsorted(number, np.frombuffer(row, np.int64)) if row else slice(None)
            total[at] += np.frombuffer(share, np.float64)
        return pd.DataFrame({"_row": number, out: total / trees})

    groups = -(-trees // together) if whole else len(forest.below)
    dealt = numbered.select("_row", *values).mapInPandas(deal, "group int, chunk long, row binary, x binary")
    copies = forest.subtrees.select("*", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
    group = F.floor(F.col("node") / together) * slices + F.col("slice")
    subtrees = copies.withColumn("group", group.cast("int")).drop("slice")
    both = [_spread(side, "group", groups * slices).groupBy("group") for side in (dealt, subtrees)]
    shares = both[0].cogroup(both[1]).applyInPandas(reach, "chunk long, row binary, share binary")
    scores = shares.groupBy("chunk").applyInPandas(add, f"_row long, {out} double")
    return numbered.join(scores, "_row").select(*df.columns, out)
