"""A run-length grammar of a sequence by recompression, and longest common extensions on it.

Block compression replaces every maximal run of one symbol by a symbol of its own, pair
compression every neighbouring pair (left, right) of a two-colouring of the symbols. They
alternate until all symbols differ. Equal stretches are compressed alike except near their
ends, so two equal stretches are compared in a few symbols per round, whatever their length:
upwards while both positions begin a symbol of the next round, downwards after the first
difference. Runs are skipped at once. Names stand for equal content only, so a match is exact;
colours only decide how many symbols a comparison takes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from riskloom.llm.hashing import mix


@dataclass(frozen=True)
class Round:
    """One compression: symbols before it, the group of each, where groups begin (and the end)."""

    symbols: np.ndarray
    group: np.ndarray
    heads: np.ndarray
    blocks: bool


def _named(heads: np.ndarray, symbols: np.ndarray, second: np.ndarray, free: int) -> tuple[np.ndarray, int]:
    """Symbols of the groups: a group of one keeps its symbol, others are named by their content."""
    names = symbols[heads[:-1]].copy()
    longer = np.flatnonzero(np.diff(heads) > 1)
    if len(longer):
        content = names[longer] << np.int64(32) | second[longer]
        _, which = np.unique(content, return_inverse=True)
        names[longer] = free + which
        free += int(which.max()) + 1
    return names, free


def _grouped(begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    heads = np.append(np.flatnonzero(begins), len(begins)).astype(np.int32)
    return heads, (np.cumsum(begins) - 1).astype(np.int32)


class Grammar:
    """``sequence`` holds non-negative numbers; its first and last one must occur nowhere else."""

    def __init__(self, sequence: np.ndarray):
        symbols, free = sequence.astype(np.int64), int(sequence.max(initial=0)) + 1
        self.rounds: list[Round] = []
        while len(symbols) > len(np.unique(symbols)):
            begins = np.ones(len(symbols), bool)
            begins[1:] = symbols[1:] != symbols[:-1]
            if not begins.all():
                heads, group = _grouped(begins)
                self.rounds.append(Round(symbols.astype(np.int32), group, heads, True))
                symbols, free = _named(heads, symbols, np.diff(heads).astype(np.int64), free)
            seed = np.uint64(len(self.rounds) << 33)
            colour = (mix(symbols.astype(np.uint64) + seed) & np.uint64(1)).astype(bool)
            right = ~colour[:-1] & colour[1:]
            left = colour[:-1] & ~colour[1:]
            paired = right if right.sum() >= left.sum() else left
            if not paired.any():
                # All symbols have one colour: another seed colours them anew.
                self.rounds.append(Round(symbols.astype(np.int32), *_grouped(np.ones(len(symbols), bool))[::-1], False))
                continue
            begins = np.ones(len(symbols), bool)
            begins[1:] = ~paired
            heads, group = _grouped(begins)
            self.rounds.append(Round(symbols.astype(np.int32), group, heads, False))
            second = symbols[np.minimum(heads[:-1] + 1, len(symbols) - 1)]
            symbols, free = _named(heads, symbols, second, free)

    def extension(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """How many symbols from ``i`` and ``j`` on agree (to the left, if ``back``); ``i`` <> ``j``."""
        at = np.stack([i, j]).astype(np.int64)
        level = np.zeros(len(i), np.int32)
        sign = -1 if back else 1

        def reach(step: Round, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Symbols up to the end of the group, and whether the place is its first one."""
            group = step.group[place]
            begin, end = step.heads[group].astype(np.int64), step.heads[group + 1].astype(np.int64)
            left = place - begin + 1 if back else end - place
            return left, left == end - begin

        def equal(step: Round, own: np.ndarray) -> np.ndarray:
            return step.symbols[at[0, own]] == step.symbols[at[1, own]]

        active = np.arange(len(i))
        for number, step in enumerate(self.rounds):
            rising = []
            while len(active):
                level[active] = number
                active = active[equal(step, active)]
                left, first = reach(step, at[:, active])
                both = first.all(axis=0)
                rising.append(active[both])
                left, active = left[:, ~both].min(axis=0), active[~both]
                at[:, active] += sign * left
            active = np.concatenate(rising) if rising else active
            at[:, active] = step.group[at[:, active]]
            level[active] = number + 1
        # Symbols of the last round all differ, so everything that got there falls again.
        for number in range(len(self.rounds) - 1, -1, -1):
            step = self.rounds[number]
            active = np.flatnonzero(level > number)
            heads = step.heads
            at[:, active] = heads[at[:, active] + 1] - 1 if back else heads[at[:, active]]
            while len(active):
                active = active[equal(step, active)]
                left, _ = reach(step, at[:, active])
                at[:, active] += sign * (left.min(axis=0) if step.blocks else 1)
        return np.abs(at[0] - i)
