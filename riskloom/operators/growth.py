"""One tree grown from binned rows, in NumPy.

A row is packed into bytes: a bin per feature and, in the last one, 16 * class + weight, so that
rows are parted by moving whole words. Nodes of over ``ALONE`` rows are split one by one; smaller
ones wait until they are ``BLOCK`` rows together and are then split side by side, level by level.
Memory stays at a few copies of the packed rows, however deep the tree.
"""

from __future__ import annotations

import math

import numpy as np

BINS = 32
BLOCK = 1 << 16
ALONE = 1 << 13
NODES = 512  # of a block whose bins are counted at once
COMPARED = 128  # nodes whose splits are compared at once: below 100 kB for each array
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = 32  # counts of both classes in one number, those of class 1 above
_ZEROS = (1 << _SHIFT) - 1


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def children_keys(keys: np.ndarray) -> np.ndarray:
    """Keys of both children of each node, in turn."""
    return mix(keys[:, None] + np.array([1, 2], np.uint64) * GOLDEN).ravel()


def drawn(keys: np.ndarray, constant: np.ndarray) -> np.ndarray:
    """Features that each node may split by, in the order drawn; -1 where too few differ."""
    width = constant.shape[1]
    chance = mix(keys[:, None] ^ (np.arange(3, width + 3, dtype=np.uint64) * GOLDEN)) >> np.uint64(1)
    chance[constant] = np.uint64(2**64 - 1)
    picked = np.argsort(chance, axis=1, kind="stable")[:, : math.ceil(math.sqrt(width))]
    return np.where(np.take_along_axis(constant, picked, 1), -1, picked)


def pack(x: np.ndarray) -> np.ndarray:
    """Words of each row; ``x`` has a line of bins per feature."""
    rows = np.zeros((x.shape[1], 8 * (len(x) // 8 + 1)), np.uint8)
    rows[:, : len(x)] = x.T
    return rows.view(np.int64)


def seen_in(rows: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """``rows`` with 16 * class + weight in the byte left for it."""
    rows[:, -1] |= seen.astype(np.int64) << 56
    return rows


def joined(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return zeros + (ones << _SHIFT)


def _impurity(counts: np.ndarray, weights) -> np.ndarray:
    zeros, ones = (counts & _ZEROS).astype(float), (counts >> _SHIFT).astype(float)
    zeros *= weights[0]
    ones *= weights[1]
    total = zeros + ones
    zeros *= ones
    zeros /= total
    return zeros


def best(counts: np.ndarray, usable: np.ndarray, weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Turn, last bin on the left, and rows of both classes on the left, of the best split of each node.

    ``counts`` has the joined counts of (node, turn, bin); every node has a turn that is usable.
    """
    turn, cut, lefts = (np.empty(len(counts), np.int64) for _ in range(3))
    for first in range(0, len(counts), COMPARED):
        some = slice(first, first + COMPARED)
        upto = counts[some].cumsum(2)
        with np.errstate(invalid="ignore"):  # an empty side has no impurity
            cost = _impurity(upto, weights)
            cost += _impurity(upto[..., -1:] - upto, weights)
        np.fmin(cost, np.inf, out=cost)
        cost[~usable[some]] = np.inf
        at = cost.reshape(len(cost), -1).argmin(1)
        turn[some], cut[some] = at // BINS, at % BINS
        lefts[some] = upto.reshape(len(cost), -1)[np.arange(len(at)), at]
    return turn, cut, np.stack([lefts & _ZEROS, lefts >> _SHIFT])


class _Tree:
    """Nodes so far. A group of nodes is a tuple of the rows, in the order of nodes, and of their numbers
    of rows, keys, levels below, places in the tree and counts of both classes."""

    def __init__(self, width: int, weights):
        self.width, self.weights = width, weights
        self.turns = math.ceil(math.sqrt(width))
        self.made, self.splits, self.shares = 1, [], []
        self.starts = np.arange(BLOCK + ALONE) * 8 * (width // 8 + 1)

    def add_shares(self, ids: np.ndarray, counts: np.ndarray) -> None:
        zeros, ones = counts
        self.shares.append((ids, self.weights[1] * ones / (self.weights[1] * ones + self.weights[0] * zeros)))

    def add_split(self, keys, levels, ids, by, cut, lefts, totals) -> tuple[np.ndarray, ...]:
        """Keys, levels, places and counts of the children: all left ones, then all right ones."""
        at = self.made + 2 * np.arange(len(ids))
        self.made += 2 * len(ids)
        self.splits.append((ids, by, cut, at))
        ids, counts = np.concatenate([at, at + 1]), np.concatenate([lefts, totals - lefts], 1)
        self.add_shares(ids, counts)
        return children_keys(keys).reshape(-1, 2).T.ravel(), np.concatenate([levels, levels]) - 1, ids, counts

    def split_alone(self, rows, sizes, keys, levels, ids, totals) -> list[tuple]:
        """The children of one large node."""
        differ = [np.bitwise_or.reduce(rows[:, word] ^ rows[0, word]) for word in range(rows.shape[1])]
        constant = np.array([differ]).view(np.uint8)[:, : self.width] == 0
        if constant.all():
            return []
        chosen = drawn(keys, constant)
        found = np.zeros((self.turns, 32 * BINS), np.int64)
        for first in range(0, len(rows), BLOCK):
            part = rows[first : first + BLOCK]
            seen = (part[:, -1] >> 56) * BINS
            for turn, f in enumerate(chosen[0]):
                if f >= 0:
                    found[turn] += np.bincount((part[:, f // 8] >> f % 8 * 8 & 255) + seen, minlength=32 * BINS)
        zeros, ones = np.einsum("w,tcwb->ctb", np.arange(16), found.reshape(self.turns, 2, 16, BINS))
        turn, cut, lefts = best(joined(zeros, ones)[None], chosen >= 0, self.weights)
        f = int(chosen[0, turn[0]])
        side = (rows[:, f // 8] >> f % 8 * 8 & 255) <= cut[0]
        keys, levels, ids, counts = self.add_split(keys, levels, ids, chosen[0, turn], cut, lefts, totals)
        parts = [rows.compress(side, axis=0), rows.compress(~side, axis=0)]
        return [(p, np.array([len(p)]), keys[[i]], levels[[i]], ids[[i]], counts[:, [i]]) for i, p in enumerate(parts)]

    def split_block(self, rows, sizes, keys, levels, ids, totals) -> tuple:
        """The children of all nodes of a block that can be split."""
        starts = np.cumsum(sizes) - sizes
        differ = np.bitwise_or.reduceat(rows ^ np.repeat(rows[starts], sizes, axis=0), starts, axis=0)
        constant = differ.view(np.uint8)[:, : self.width] == 0
        split = ~constant.all(1)
        if not split.all():
            constant = constant[split]
            rows, sizes, keys, levels, ids, totals = _only(split, rows, sizes, keys, levels, ids, totals)
            starts = np.cumsum(sizes) - sizes
            if not len(ids):
                return rows, sizes, keys, levels, ids, totals
        chosen, ends = drawn(keys, constant), starts + sizes
        flat, weight = rows.view(np.uint8).ravel(), rows[:, -1] >> 56
        weight = ((weight & 15) << (weight >> 4) * _SHIFT).astype(float)
        found = []
        for first in range(0, len(ids), NODES):
            some = slice(first, min(first + NODES, len(ids)))
            inside, own = slice(starts[first], ends[some.stop - 1]), sizes[some]
            cell = np.repeat(np.arange(len(own)) * BINS, own)
            counts = np.empty((len(own), self.turns, BINS), np.int64)
            for turn in range(self.turns):
                at = np.repeat(chosen[some, turn], own)
                at += self.starts[inside]
                by = flat.take(at, mode="clip")
                by &= BINS - 1  # of a turn without feature, whose counts are not used
                counts[:, turn] = np.bincount(cell + by, weight[inside], len(own) * BINS).reshape(-1, BINS)
            found.append(best(counts, chosen[some] >= 0, self.weights))
        turn, cut, lefts = (np.concatenate(parts, -1) for parts in zip(*found))
        by = chosen[np.arange(len(ids)), turn]
        side = flat.take(np.repeat(by, sizes) + self.starts[: len(rows)]) <= np.repeat(cut.astype(np.uint8), sizes)
        on_left = np.add.reduceat(side, starts, dtype=np.int64)
        children = self.add_split(keys, levels, ids, by, cut, lefts, totals)
        rows = np.concatenate([rows.compress(side, axis=0), rows.compress(~side, axis=0)])
        return rows, np.concatenate([on_left, sizes - on_left]), *children

    def arrays(self) -> tuple[np.ndarray, ...]:
        feature, cut, left = np.full(self.made, -1, np.int16), np.zeros(self.made, np.uint8), np.zeros(self.made, np.int32)
        share = np.empty(self.made)
        for ids, by, most, at in self.splits:
            feature[ids], cut[ids], left[ids] = by, most, at
        for ids, of in self.shares:
            share[ids] = of
        return feature, cut, left, share


def _only(wanted: np.ndarray, rows, sizes, keys, levels, ids, totals) -> tuple:
    if not wanted.all():
        rows = rows.compress(np.repeat(wanted, sizes), axis=0)
    return rows, sizes[wanted], keys[wanted], levels[wanted], ids[wanted], totals[:, wanted]


def grow(rows: np.ndarray, width: int, key: int, levels: int, weights) -> tuple[np.ndarray, ...]:
    """Feature (-1: leaf), bin, left child and share of class 1 of every node, the root first.

    ``rows`` are packed; the right child follows the left one.
    """
    tree = _Tree(width, weights)
    totals = (np.bincount(rows[:, -1] >> 56, minlength=32).reshape(2, 16) @ np.arange(16))[:, None]
    tree.add_shares(np.array([0]), totals)
    left = [(rows, np.array([len(rows)]), np.array([key], np.uint64), np.array([levels]), np.array([0]), totals)]
    waiting, held = [], 0
    del rows
    while left or waiting:
        if left:
            node = left.pop()
            if not node[3][0] or not node[5].all():
                continue
            if len(node[0]) > ALONE:
                left += tree.split_alone(*node)
                continue
            waiting.append(node)
            held += len(node[0])
        if held >= BLOCK or not left:
            *parts, counts = zip(*waiting)
            block, waiting, held = (*map(np.concatenate, parts), np.concatenate(counts, 1)), [], 0
            while len(block[4]):
                block = _only((block[3] > 0) & block[5].all(0), *block)
                if len(block[4]):
                    block = tree.split_block(*block)
    return tree.arrays()


def leaves(tree: tuple[np.ndarray, ...], x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The leaf that each column of ``x`` reaches from the node ``at``."""
    feature, cut, left = tree[:3]
    at, going = at.copy(), np.flatnonzero(feature[at] >= 0)
    while len(going):
        here = at[going]
        at[going] = left[here] + (x[feature[here], going] > cut[here])
        going = going[feature[at[going]] >= 0]
    return at


def steps(tree: tuple[np.ndarray, ...]) -> np.ndarray:
    """Left child, feature and bin of every node in one number; a leaf is its own left child."""
    feature, cut, left = (part.astype(np.int64) for part in tree[:3])
    leaf = feature < 0
    left, feature, cut = np.where(leaf, np.arange(len(left)), left), np.where(leaf, 0, feature), np.where(leaf, 255, cut)
    return left << 24 | feature << 8 | cut


def reached(steps: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The leaf that each packed row reaches from the root."""
    flat, result = rows.view(np.uint8).ravel(), np.zeros(len(rows), np.int64)
    starts = np.arange(len(rows)) * (8 * rows.shape[1])
    places, node = None, np.full(len(rows), steps[0])
    while len(node):
        for _ in range(4):
            by = flat.take((node >> 8 & 0xFFFF) + starts)
            at = (node >> 24) + (by > (node & 255))
            node = steps.take(at)
        going = (node & 255) < 255
        ended = ~going
        if places is None:
            result[ended], places = at.compress(ended), np.flatnonzero(going)
        else:
            result[places.compress(ended)], places = at.compress(ended), places.compress(going)
        node, starts = node.compress(going), starts.compress(going)
    return result
