"""Sequences side by side: a step of all lanes is one array operation."""

from __future__ import annotations

import heapq

import numpy as np


class Lanes:
    """Sequences dealt to lanes, one after the other in each, the longest lanes first.

    ``width[t]`` lanes are alive at step ``t``, and they are the first ones. The loads are
    as even as whole sequences allow.
    """

    def __init__(self, lengths: np.ndarray, lanes: int):
        n = len(lengths)
        heap = [(0, k) for k in range(min(lanes, max(1, n)))]
        lane, begin = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for i in np.argsort(-lengths, kind="stable"):
            load, k = heapq.heappop(heap)
            lane[i], begin[i] = k, load
            heapq.heappush(heap, (load + int(lengths[i]), k))
        loads = np.zeros(len(heap), np.int64)
        for load, k in heap:
            loads[k] = load
        place = np.empty(len(heap), np.int64)
        place[np.argsort(-loads, kind="stable")] = np.arange(len(heap))
        self.lane, self.begin, self.lengths = place[lane], begin, lengths
        self.steps = int(loads.max()) if len(heap) else 0
        self.count = len(heap)
        ordered = -np.sort(-loads)
        self.width = self.count - np.searchsorted(
            ordered[::-1], np.arange(self.steps), side="right"
        )

    def spread(self, flat: np.ndarray, fill: int) -> np.ndarray:
        """The sequences, which lie one after the other in ``flat``, as steps by lanes."""
        out = np.full((self.steps, self.count), fill, flat.dtype)
        at = 0
        for length, lane, begin in zip(
            self.lengths.tolist(), self.lane.tolist(), self.begin.tolist(), strict=True
        ):
            out[begin : begin + length, lane] = flat[at : at + length]
            at += length
        return out

    def endings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sequences by the step of their last element: (steps, bounds, sequences)."""
        last = self.begin + self.lengths - 1
        order = np.argsort(last, kind="stable")
        steps, first = np.unique(last[order], return_index=True)
        return steps, np.append(first, len(order)), order
