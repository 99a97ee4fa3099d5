"""Double arrays: transitions (state, code) → state in flat arrays, for many
states at once.

A transition is in slot ``base[state] + code`` and holds there if
``check[slot]`` names the state; ``target[slot]`` is where it leads. The rows of
states are shifted against each other until no two fall into one slot.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Places that are tried together for a state with more than one transition.
TRIES = 64


@dataclass(frozen=True)
class DoubleArray:
    base: np.ndarray
    check: np.ndarray
    target: np.ndarray

    def advance(self, states: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(hit, next)`` of each state on its code; ``next`` holds where ``hit``."""
        slots = self.base[states] + codes
        return self.check[slots] == states, self.target[slots]


def double_array(parents: np.ndarray, codes: np.ndarray, children: np.ndarray, states: int, width: int) -> DoubleArray:
    """Arrays of the transitions ``parents[i]`` on ``codes[i]`` → ``children[i]``.

    States are below ``states``, codes below ``width`` and positive; a state has a
    code once. Code 0 is no transition of any state.
    """
    if len(codes) and int(codes.min()) < 1:
        raise ValueError("codes start at 1")
    order = np.lexsort((codes, parents))
    parents, codes, children = parents[order], codes[order], children[order]
    base = np.zeros(max(states, 1), dtype=np.int32)
    size = 2 * len(codes) + 2 * width + TRIES
    check, target = np.full(size, -1, dtype=np.int32), np.zeros(size, dtype=np.int32)
    owners, starts, counts = np.unique(parents, return_index=True, return_counts=True)
    rnd = np.random.default_rng(len(codes))
    # states of many transitions first, while there is room
    for k in np.argsort(-counts, kind="stable")[: int((counts > 1).sum())]:
        row = codes[starts[k] : starts[k] + counts[k]]
        rounds = 0
        while True:
            at = rnd.integers(0, len(check) - width, TRIES)
            free = np.flatnonzero((check[at[:, None] + row] < 0).all(axis=1))
            if len(free):
                break
            rounds += 1
            if rounds % 4 == 0:  # too full for this row
                more = max(width, len(check) // 4)
                check = np.concatenate([check, np.full(more, -1, dtype=np.int32)])
                target = np.concatenate([target, np.zeros(more, dtype=np.int32)])
        base[owners[k]] = at[free[0]]
        slots = at[free[0]] + row
        check[slots], target[slots] = owners[k], children[starts[k] : starts[k] + counts[k]]
    # one transition fits any free slot beyond the largest code
    alone = np.flatnonzero(counts == 1)
    free = np.flatnonzero(check[width : len(check) - width] < 0) + width
    if len(free) < len(alone):
        more = len(alone) - len(free)
        free = np.concatenate([free, np.arange(more) + len(check) - width])
        check = np.concatenate([check, np.full(more, -1, dtype=np.int32)])
        target = np.concatenate([target, np.zeros(more, dtype=np.int32)])
    slots = free[: len(alone)]
    one = starts[alone]
    base[owners[alone]] = slots - codes[one]
    check[slots], target[slots] = owners[alone], children[one]
    return DoubleArray(base, check, target)
