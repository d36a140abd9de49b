"""Linear-chain conditional random fields in numpy, over padded batches of sequences.

A token has a fixed number of feature numbers; its score per tag is the sum of their weights. A
sequence of length n takes the first n places of its row; what lies beyond is ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Chain:
    """Weights per feature and tag, and scores of a tag (column) after a tag (row)."""

    weights: np.ndarray
    steps: np.ndarray

    def plain(self) -> tuple[np.ndarray, np.ndarray]:
        """What a broadcast may hold: executors need not know this class to read arrays."""
        return self.weights, self.steps

    def scores(self, features: np.ndarray) -> np.ndarray:
        return self.weights[features].sum(axis=-2)


def marginals(scores: np.ndarray, lengths: np.ndarray, steps: np.ndarray):
    """Forward-backward: tag probabilities [B, T, K] and expected steps [K, K] over all rows."""
    rows, most, tags = scores.shape
    node = np.exp(scores - scores.max(axis=2, keepdims=True))
    edge = np.exp(steps)
    forward = np.empty_like(node)
    forward[:, 0] = node[:, 0] / node[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, most):
        now = (forward[:, t - 1] @ edge) * node[:, t]
        forward[:, t] = now / now.sum(axis=1, keepdims=True)
    backward = np.ones((rows, tags), node.dtype)
    out = np.zeros_like(node)
    expected = np.zeros((tags, tags))
    for t in range(most - 1, -1, -1):
        inside = (lengths > t)[:, None]
        here = forward[:, t] * backward
        out[:, t] = np.where(inside, here / here.sum(axis=1, keepdims=True), 0)
        if t:
            right = node[:, t] * backward
            pair = forward[:, t - 1][:, :, None] * edge[None] * right[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            expected += (pair * inside[:, :, None]).sum(axis=0)
            left = right @ edge.T
            backward = np.where(inside, left / left.sum(axis=1, keepdims=True), backward)
    return out, expected


def viterbi(scores: np.ndarray, lengths: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The best tags [B, T]; ties go to the smaller tag number. Places beyond the length: 0."""
    rows, most, tags = scores.shape
    best = scores[:, 0].copy()
    came = np.zeros((rows, most, tags), np.int8)
    for t in range(1, most):
        inside = (lengths > t)[:, None]
        ways = best[:, :, None] + steps[None]
        came[:, t] = np.where(inside, ways.argmax(axis=1), np.arange(tags)[None])
        best = np.where(inside, ways.max(axis=1) + scores[:, t], best)
    tag = best.argmax(axis=1)
    out = np.zeros((rows, most), np.int8)
    for t in range(most - 1, -1, -1):
        out[:, t] = np.where(lengths > t, tag, 0)
        tag = came[np.arange(rows), t, tag]
    return out


def train(
    features: np.ndarray,
    tags: np.ndarray,
    lengths: np.ndarray,
    n_features: int,
    n_tags: int,
    rounds: int = 60,
    rate: float = 0.5,
    ridge: float = 1e-4,
    batch: int = 512,
) -> Chain:
    """Maximum likelihood by adaptive gradient steps over batches in a fixed order."""
    weights = np.zeros((n_features, n_tags))
    steps = np.zeros((n_tags, n_tags))
    seen_weights, seen_steps = np.full_like(weights, 1e-6), np.full_like(steps, 1e-6)
    order = np.argsort(lengths, kind="stable")
    parts = [order[i : i + batch] for i in range(0, len(order), batch)]
    for _ in range(rounds):
        for part in parts:
            most = int(lengths[part].max(initial=0))
            if most == 0:
                continue
            own, gold, size = features[part, :most], tags[part, :most], lengths[part]
            inside = np.arange(most)[None] < size[:, None]
            found, expected = marginals(weights[own].sum(axis=2), size, steps)
            truth = np.eye(n_tags)[gold] * inside[:, :, None]
            slope = (truth - found)[inside]
            by_weight = -ridge * len(part) * weights
            flat = own[inside]
            for column in range(flat.shape[1]):
                np.add.at(by_weight, flat[:, column], slope)
            pairs = inside[:, 1:]
            counted = np.zeros_like(steps)
            np.add.at(counted, (gold[:, :-1][pairs], gold[:, 1:][pairs]), 1)
            by_step = counted - expected - ridge * len(part) * steps
            seen_weights += by_weight**2
            seen_steps += by_step**2
            weights += rate * by_weight / np.sqrt(seen_weights)
            steps += rate * by_step / np.sqrt(seen_steps)
    return Chain(weights, steps)


def padded(rows: list[list], width: int = 0, kind=np.int32):
    """Rows of unequal length as one array, and their lengths."""
    lengths = np.array([len(r) for r in rows], np.int64)
    most = int(lengths.max(initial=1)) or 1
    shape = (len(rows), most, width) if width else (len(rows), most)
    out = np.zeros(shape, kind)
    for i, row in enumerate(rows):
        if row:
            out[i, : len(row)] = row
    return out, lengths
