"""A linear-chain conditional random field over many sequences at once.

Sequences lie one after the other in flat arrays. Forward-backward runs exactly, but in blocks of
positions: each block's product of transfer matrices is made for all blocks together, the blocks of a
sequence are chained, and the marginals inside all blocks follow together. A long sequence so needs
few Python steps.
"""

from __future__ import annotations

import numpy as np

BLOCK = 48


class Chain:
    """Transitions ``trans`` [from, to] and ``start`` scores of a field with so many states."""

    def __init__(self, trans: np.ndarray, start: np.ndarray):
        self.trans, self.start = np.asarray(trans, float), np.asarray(start, float)

    def marginals(self, scores: np.ndarray, offsets: np.ndarray, pairs: bool = False):
        """Marginals [position, state] of sequences cut at ``offsets``; with ``pairs`` also the
        expected transitions, summed over all sequences.
        """
        n, states = scores.shape
        out = np.zeros((n, states))
        lengths = np.diff(offsets)
        if n == 0:
            return (out, np.zeros((states, states))) if pairs else out
        top = scores.max(1)
        e = np.exp(scores - top[:, None])
        t, s = np.exp(self.trans - self.trans.max()), np.exp(self.start - self.start.max())

        blocks = -(-lengths // BLOCK)
        owner = np.repeat(np.arange(len(lengths)), blocks)
        first = np.cumsum(blocks) - blocks
        rank = np.arange(len(owner)) - first[owner]
        at = offsets[:-1][owner] + rank * BLOCK
        size = np.minimum(BLOCK, offsets[1:][owner] - at)
        order = np.argsort(-size, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        at, size = at[order], size[order]
        active = [int(np.searchsorted(-size, -k, "left")) for k in range(BLOCK)]  # blocks longer than k

        g = np.zeros((len(at), states, states))
        g[:, range(states), range(states)] = e[at]
        for k in range(1, int(size[0])):
            m = active[k]
            step = (g[:m].reshape(-1, states) @ t).reshape(m, states, states) * e[at[:m] + k][:, None, :]
            g[:m] = step / step.sum((1, 2), keepdims=True)

        enter, leave = np.zeros((len(at), states)), np.zeros((len(at), states))
        v = np.tile(s, (len(lengths), 1))
        most = int(blocks.max())
        by_blocks = [np.flatnonzero(blocks > k) for k in range(most)]
        for k, seqs in enumerate(by_blocks):
            b = place[first[seqs] + k]
            enter[b] = v[seqs]
            w = np.matmul(v[seqs][:, None, :], g[b])[:, 0] @ t
            v[seqs] = w / w.sum(1, keepdims=True)
        y = np.ones((len(lengths), states))
        for k in range(most - 1, -1, -1):
            seqs = by_blocks[k]
            b = place[first[seqs] + k]
            leave[b] = y[seqs]
            w = np.matmul(g[b], y[seqs][:, :, None])[:, :, 0] @ t.T
            y[seqs] = w / w.sum(1, keepdims=True)

        a = enter * e[at]
        a /= a.sum(1, keepdims=True)
        out[at] = a
        for k in range(1, int(size[0])):
            m = active[k]
            a = (a[:m] @ t) * e[at[:m] + k]
            a /= a.sum(1, keepdims=True)
            out[at[:m] + k] = a
        forward = out.copy() if pairs else None
        beta = leave
        if pairs:
            backward = np.zeros((n, states))
        for k in range(int(size[0]) - 1, -1, -1):
            m = active[k]
            here = at[:m] + k
            if pairs:
                backward[here] = beta[:m]
            p = out[here] * beta[:m]
            out[here] = p / p.sum(1, keepdims=True)
            back = (e[here] * beta[:m]) @ t.T
            beta[:m] = back / back.sum(1, keepdims=True)
        if not pairs:
            return out
        inner = np.ones(n, bool)
        inner[offsets[:-1][lengths > 0]] = False
        now = np.flatnonzero(inner)
        left, right = forward[now - 1], e[now] * backward[now]
        z = ((left @ t) * right).sum(1)
        expected = (left / z[:, None]).T @ right * t
        return out, expected

    def log_likelihood(self, scores: np.ndarray, offsets: np.ndarray, labels: np.ndarray) -> float:
        """Plain forward recursion in logs, sequence by sequence: for tests."""
        total = 0.0
        for a, b in zip(offsets[:-1], offsets[1:]):
            if a == b:
                continue
            alpha = self.start + scores[a]
            gold = self.start[labels[a]] + scores[a, labels[a]]
            for i in range(a + 1, b):
                grid = alpha[:, None] + self.trans
                top = grid.max(0)
                alpha = top + np.log(np.exp(grid - top).sum(0)) + scores[i]
                gold += self.trans[labels[i - 1], labels[i]] + scores[i, labels[i]]
            top = alpha.max()
            total += gold - (top + np.log(np.exp(alpha - top).sum()))
        return total


class Emissions:
    """Linear scores of items from lists of features: ``features`` one after the other, item i has
    those at [starts[i], starts[i + 1]), each with a value."""

    def __init__(self, features: np.ndarray, values: np.ndarray, starts: np.ndarray):
        self.features, self.values, self.starts = features, values, starts
        self.owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))

    def scores(self, weights: np.ndarray) -> np.ndarray:
        items = len(self.starts) - 1
        return np.stack([np.bincount(self.owner, weights[self.features, k] * self.values, items)
                         for k in range(weights.shape[1])], 1)

    def gradient(self, by_item: np.ndarray, size: int) -> np.ndarray:
        return np.stack([np.bincount(self.features, by_item[self.owner, k] * self.values, size)
                         for k in range(by_item.shape[1])], 1)


def fit(emissions: Emissions, items: np.ndarray, labels: np.ndarray, offsets: np.ndarray, size: int,
        states: int, rounds: int = 40, rate: float = 0.3, decay: float = 1e-3) -> tuple[np.ndarray, Chain]:
    """Weights [feature, state] and chain that maximise the penalised conditional likelihood.

    ``items`` names the item at each position, ``labels`` its state. Adagrad steps over the whole
    sample, which is bounded by whoever draws it.
    """
    weights = np.zeros((size, states))
    chain = Chain(np.zeros((states, states)), np.zeros(states))
    squares = [np.full(x.shape, 1e-6) for x in (weights, chain.trans, chain.start)]
    full = np.diff(offsets) > 0
    heads = offsets[:-1][full]
    seen = np.eye(states)[labels]
    inner = np.ones(len(items), bool)
    inner[heads] = False
    now = np.flatnonzero(inner)
    moved = np.zeros((states, states))
    np.add.at(moved, (labels[now - 1], labels[now]), 1)
    positions, count = max(1, len(items)), emissions.starts.shape[0] - 1
    for _ in range(rounds):
        m, expected = chain.marginals(emissions.scores(weights)[items], offsets, pairs=True)
        rest = seen - m
        by_item = np.stack([np.bincount(items, rest[:, k], count) for k in range(states)], 1)
        steps = (emissions.gradient(by_item, size) / positions - decay * weights / size,
                 (moved - expected) / positions - decay * chain.trans,
                 rest[heads].sum(0) / positions - decay * chain.start)
        for x, square, step in zip((weights, chain.trans, chain.start), squares, steps):
            square += step * step
            x += rate * step / np.sqrt(square)
    return weights, chain
