"""A linear-chain conditional random field of two tags, over many sequences at once.

A sequence's score is the sum of a start weight, transition weights, and an emission
weight for each token with tag 1 (tag 0 has none). Sequences are cut into blocks; the
products of the transfer matrices of all blocks are taken side by side, then carried from
block to block of a sequence, so that results are those of one pass over each sequence
while numpy works on whole columns.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

BLOCK = 32


class Chain(NamedTuple):
    """Weights of the tags' starts (2) and transitions (2 by 2, from and to)."""

    start: np.ndarray
    moves: np.ndarray


def _scaled(*values: np.ndarray) -> tuple[np.ndarray, ...]:
    total = sum(values)
    return tuple(v / total for v in values)


class Lattice:
    """Where the tokens of sequences lie in blocks; token i of a block is one column."""

    def __init__(self, bounds: np.ndarray):
        lengths = np.diff(bounds)
        per = -(-lengths // BLOCK)
        self.tokens = int(bounds[-1] - bounds[0])
        self.blocks = int(per.sum())
        sequence = np.repeat(np.arange(len(lengths)), per)
        self.ordinal = np.arange(self.blocks) - np.repeat(np.cumsum(per) - per, per)
        self.last = np.zeros(self.blocks, dtype=bool)
        self.last[np.cumsum(per)[per > 0] - 1] = True
        left = lengths[sequence] - self.ordinal * BLOCK
        self.filled = np.minimum(left, BLOCK)
        first = bounds[:-1][sequence] - bounds[0] + self.ordinal * BLOCK
        self.at = first[:, None] + np.arange(BLOCK)[None, :]
        self.real = np.arange(BLOCK)[None, :] < self.filled[:, None]
        self.first = np.zeros((self.blocks, BLOCK), dtype=bool)
        self.first[self.ordinal == 0, 0] = True

    def grid(self, values: np.ndarray) -> np.ndarray:
        return np.where(self.real, values[np.minimum(self.at, max(self.tokens - 1, 0))], 0.0)

    def marginals(self, emissions: np.ndarray, chain: Chain) -> tuple[np.ndarray, np.ndarray, float]:
        """Per token the probability of tag 1; the expected transitions (2 by 2); expected tag 1 at starts."""
        if not self.tokens:
            return np.zeros(0), np.zeros((2, 2)), 0.0
        boost = np.exp(np.clip(self.grid(emissions), -30, 30))
        moves, start = np.exp(chain.moves), np.exp(chain.start)

        def step(k: int) -> tuple[np.ndarray, ...]:
            """The transfer matrix of column k: from 00, 01, 10, 11; padding changes nothing."""
            real, head, up = self.real[:, k], self.first[:, k], boost[:, k]
            made = []
            for a in (0, 1):
                for b in (0, 1):
                    weight = np.where(head, start[b], moves[a, b]) * (up if b else 1.0)
                    made.append(np.where(real, weight, float(a == b)))
            return tuple(made)

        steps = [step(k) for k in range(BLOCK)]
        product = (np.ones(self.blocks), np.zeros(self.blocks), np.zeros(self.blocks), np.ones(self.blocks))
        for m in steps:
            p = product
            product = _scaled(
                p[0] * m[0] + p[1] * m[2], p[0] * m[1] + p[1] * m[3], p[2] * m[0] + p[3] * m[2], p[2] * m[1] + p[3] * m[3]
            )
        into, out = self._carried(product)

        forward = []
        a0, a1 = into
        for m in steps:
            a0, a1 = _scaled(a0 * m[0] + a1 * m[2], a0 * m[1] + a1 * m[3])
            forward.append((a0, a1))
        chance = np.zeros((self.blocks, BLOCK))
        pairs = np.zeros((2, 2))
        b0, b1 = out
        for k in range(BLOCK - 1, -1, -1):
            a0, a1 = forward[k]
            chance[:, k] = a1 * b1 / (a0 * b0 + a1 * b1)
            m = steps[k]
            c0, c1 = forward[k - 1] if k else into
            inner = self.real[:, k] & ~self.first[:, k]
            both = (c0 * m[0] * b0, c0 * m[1] * b1, c1 * m[2] * b0, c1 * m[3] * b1)
            total = np.where(inner, sum(both), 1.0)
            pairs += np.array([(x / total)[inner].sum() for x in both]).reshape(2, 2)
            b0, b1 = _scaled(m[0] * b0 + m[1] * b1, m[2] * b0 + m[3] * b1)
        starts = float(chance[:, 0][self.ordinal == 0].sum())
        return chance[self.real], pairs, starts

    def _carried(self, product: tuple[np.ndarray, ...]):
        """What reaches each block from the blocks before it and behind it."""
        into = (np.ones(self.blocks) * 0.5, np.ones(self.blocks) * 0.5)
        out = (np.ones(self.blocks), np.ones(self.blocks))
        order = np.argsort(self.ordinal, kind="stable")
        edges = np.searchsorted(self.ordinal[order], np.arange(int(self.ordinal.max()) + 2))
        p0, p1, p2, p3 = product
        layers = [order[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        for layer in layers[1:]:
            prev = layer - 1
            a0, a1 = into[0][prev], into[1][prev]
            into[0][layer], into[1][layer] = _scaled(a0 * p0[prev] + a1 * p2[prev], a0 * p1[prev] + a1 * p3[prev])
        for layer in layers[:0:-1]:
            prev = layer - 1
            b0, b1 = out[0][layer], out[1][layer]
            out[0][prev], out[1][prev] = _scaled(p0[layer] * b0 + p1[layer] * b1, p2[layer] * b0 + p3[layer] * b1)
        return into, out


def fit(
    features: np.ndarray, bounds: np.ndarray, tags: np.ndarray, places: int, passes: int, rate: float, shrink: float
) -> tuple[np.ndarray, Chain]:
    """Weights by adaptive gradient steps on the conditional log-likelihood of the tags.

    ``features`` has the places of each token's features, one row for each.
    """
    lattice = Lattice(bounds)
    weights, square = np.zeros(places), np.full(places, 1e-8)
    chain, seen = np.zeros(6), np.full(6, 1e-8)
    if not lattice.tokens:
        return weights, Chain(chain[:2], chain[2:].reshape(2, 2))
    heads = bounds[:-1][np.diff(bounds) > 0] - bounds[0]
    inner = np.ones(len(tags), dtype=bool)
    inner[heads] = False
    after = np.flatnonzero(inner)
    told = np.bincount(tags[after - 1] * 2 + tags[after], minlength=4).astype(float)
    told_start = float(tags[heads].sum())
    used = [np.unique(column, return_inverse=True) for column in features]
    for _ in range(passes):
        emissions = sum(weights[column] for column in features)
        model = Chain(chain[:2], chain[2:].reshape(2, 2))
        chance, pairs, starts = lattice.marginals(emissions, model)
        error = tags - chance
        slope = -shrink * weights
        for places_used, inverse in used:
            slope[places_used] += np.bincount(inverse, weights=error, minlength=len(places_used))
        square += slope**2
        weights += rate * slope / np.sqrt(square)
        rise = np.concatenate([[0.0, told_start - starts], told - pairs.reshape(-1)]) - shrink * chain
        seen += rise**2
        chain = chain + rate * rise / np.sqrt(seen)
    return weights, Chain(chain[:2], chain[2:].reshape(2, 2))
