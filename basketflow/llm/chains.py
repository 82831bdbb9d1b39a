"""Many label chains of different length laid out step by step, for forward and backward recursions."""

from __future__ import annotations

import numpy as np


class Steps:
    """Chains sorted by length: step t holds the t-th elements of all chains that have one, longest chain first.

    ``place`` maps elements in their own order to this layout; ``bounds[t]:bounds[t + 1]`` is step t.
    """

    def __init__(self, lengths: np.ndarray):
        lengths = np.asarray(lengths, dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        rank = np.empty(len(lengths), dtype=np.int64)
        rank[order] = np.arange(len(lengths))
        longest = int(lengths.max(initial=0))
        ended = np.bincount(lengths, minlength=longest + 1)
        self.active = len(lengths) - np.cumsum(ended)[:longest]
        self.bounds = np.concatenate([[0], np.cumsum(self.active)])
        chain = np.repeat(np.arange(len(lengths)), lengths)
        step = np.arange(len(chain)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.place = self.bounds[step] + rank[chain]
        self.chain = chain

    def __len__(self) -> int:
        return len(self.active)

    def forward(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray, every: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Scaled forward values and the scale of each element; ``emit`` is in this layout.

        With ``every`` only each so manieth step is scaled and the others have scale 1; ``emit`` should then be near 1.
        """
        values, scales = np.empty_like(emit), np.ones(len(emit), dtype=emit.dtype)
        before = None
        for t, (n, a, b) in enumerate(zip(self.active, self.bounds[:-1], self.bounds[1:], strict=True), 1):
            now = values[a:b]
            if before is None:
                np.multiply(start, emit[a:b], out=now)
            else:
                np.matmul(before[:n], move, out=now)
                now *= emit[a:b]
            if t % every == 0:
                scales[a:b] = now.sum(axis=1)
                now /= scales[a:b, None]
            before = now
        return values, scales

    def backward(self, move: np.ndarray, emit: np.ndarray, scales: np.ndarray) -> np.ndarray:
        values = np.ones_like(emit)
        turned = np.ascontiguousarray(move.T)
        weighted = emit / scales[:, None]
        for t in range(len(self) - 2, -1, -1):
            a, b, c = self.bounds[t], self.bounds[t + 1], self.bounds[t + 2]
            np.matmul(weighted[b:c] * values[b:c], turned, out=values[a : a + c - b])
        return values

    def before(self) -> np.ndarray:
        """Where the element before it is, for all elements but the first of each chain, in this layout."""
        first = self.bounds[1] if len(self) else 0
        return np.arange(first, self.bounds[-1]) - np.repeat(self.active[:-1], self.active[1:])

    def last(self, lengths: np.ndarray) -> np.ndarray:
        """Where the last element of each chain of one or more is."""
        return self.place[np.cumsum(lengths)[lengths > 0] - 1]
