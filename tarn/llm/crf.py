"""A linear-chain conditional random field over sets of features, trained and decoded in numpy batches.

A sequence is a list of tokens, a token a list of feature names. Training takes
full-batch gradient steps (Adam) on the log-likelihood with an L2 penalty;
forward and backward sums run over all sequences at once, place by place.
Decoding is Viterbi's, also over many sequences at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

Sequence = list[list[str]]


@dataclass
class Model:
    labels: list[str]
    features: dict[str, int]
    weights: np.ndarray  # feature x label; the last row is of unknown features and zero
    moves: np.ndarray  # label x label
    first: np.ndarray
    last: np.ndarray


def _indexed(sequences: list[Sequence], features: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers (sequence x place x slot) and lengths; what is unknown or missing gets the last number."""
    lengths = np.array([len(s) for s in sequences])
    slots = max((len(t) for s in sequences for t in s), default=1)
    ids = np.full((len(sequences), int(lengths.max(initial=0)), slots), len(features), np.int32)
    for i, s in enumerate(sequences):
        for j, t in enumerate(s):
            ids[i, j, : len(t)] = [features.get(f, len(features)) for f in t]
    return ids, lengths


def _expected(scores: np.ndarray, lengths: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """Label chances at each place, and expected moves, of sequences sorted by falling length; sums are scaled place by place."""
    n, places, k = scores.shape
    top = scores.max(2, keepdims=True)
    own, moves = np.exp(scores - top), np.exp(m.moves)
    active = [int((lengths > t).sum()) for t in range(places)]
    forward, backward = np.zeros_like(scores), np.zeros_like(scores)
    x = np.exp(m.first) * own[:, 0]
    forward[:, 0] = x / x.sum(1, keepdims=True)
    for t in range(1, places):
        x = (forward[: active[t], t - 1] @ moves) * own[: active[t], t]
        forward[: active[t], t] = x / x.sum(1, keepdims=True)
    backward[np.arange(n), lengths - 1] = np.exp(m.last)
    for t in range(places - 2, -1, -1):
        x = (own[: active[t + 1], t + 1] * backward[: active[t + 1], t + 1]) @ moves.T
        backward[: active[t + 1], t] = x / x.sum(1, keepdims=True)
    chances = forward * backward
    chances /= np.maximum(chances.sum(2, keepdims=True), 1e-300)
    expected = np.zeros((k, k))
    for t in range(1, places):
        left, right = forward[: active[t], t - 1], own[: active[t], t] * backward[: active[t], t]
        total = ((left @ moves) * right).sum(1, keepdims=True)
        expected += moves * (left.T @ (right / total))
    return chances, expected


def trained(sequences: list[Sequence], tags: list[list[str]], steps: int = 120, rate: float = 0.1, penalty: float = 0.02) -> Model:
    """A model of labelled sequences (none empty); the same each time."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    sequences, tags = [sequences[i] for i in order], [tags[i] for i in order]
    labels = sorted({t for s in tags for t in s}, key=lambda t: (t != "O", t))
    features = {f: i for i, f in enumerate(sorted({f for s in sequences for t in s for f in t}))}
    k = len(labels)
    m = Model(labels, features, np.zeros((len(features) + 1, k)), np.zeros((k, k)), np.zeros(k), np.zeros(k))
    ids, lengths = _indexed(sequences, features)
    inside = np.arange(ids.shape[1]) < lengths[:, None]
    gold = np.zeros((*ids.shape[:2], k))
    seen_moves, ends = np.zeros((k, k)), np.zeros((2, k))
    for i, s in enumerate(tags):
        own = [labels.index(t) for t in s]
        gold[i, np.arange(len(own)), own] = 1
        np.add.at(seen_moves, (own[:-1], own[1:]), 1)
        ends[0, own[0]] += 1
        ends[1, own[-1]] += 1
    flat, rows = ids[inside], int(lengths.sum())
    scores = np.zeros((*ids.shape[:2], k))
    parts = [m.weights, m.moves, m.first, m.last]
    means, squares = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    at_end = (np.arange(len(lengths)), lengths - 1)
    for step in range(1, steps + 1):
        scores[inside] = m.weights[flat].sum(1)
        chances, moves = _expected(scores, lengths, m)
        error = (gold - chances)[inside]
        by_feature = np.stack([np.bincount(flat.ravel(), np.repeat(error[:, j], flat.shape[1]), len(features) + 1) for j in range(k)], 1)
        by_feature[-1] = 0
        gradients = [by_feature, seen_moves - moves, ends[0] - chances[:, 0].sum(0), ends[1] - chances[at_end].sum(0)]
        for part, g, mean, square in zip(parts, gradients, means, squares):  # noqa: B905
            g = g / rows * 100 - penalty * part
            mean += 0.1 * (g - mean)
            square += 0.001 * (g * g - square)
            part += rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return m


def decoded(sequences: list[Sequence], m: Model, at_once: int = 2000) -> list[list[str]]:
    """The best labels of each sequence (Viterbi), in batches of like lengths."""
    order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
    out: list[list[str]] = [[] for _ in sequences]
    at = 0
    while at < len(order):
        some = order[at : at + at_once]
        while len(some) > 1 and len(sequences[some[-1]]) * len(some) > 20 * at_once:  # few at once if they are long
            some = some[: len(some) // 2]
        at += len(some)
        ids, lengths = _indexed([sequences[i] for i in some], m.features)
        if not ids.shape[1]:
            continue
        scores = m.weights[ids].sum(2)
        best, back = m.first + scores[:, 0], np.zeros(scores.shape, np.int16)
        for t in range(1, ids.shape[1]):
            options = best[:, :, None] + m.moves
            on = t < lengths
            back[:, t] = np.where(on[:, None], options.argmax(1), np.arange(len(m.labels)))
            best = np.where(on[:, None], options.max(1) + scores[:, t], best)
        label = (best + m.last).argmax(1)
        path = np.zeros(ids.shape[:2], np.int16)
        for t in range(ids.shape[1] - 1, -1, -1):
            path[:, t] = label
            label = back[np.arange(len(some)), t, label]
        for i, row, n in zip(some, path, lengths):  # noqa: B905
            out[i] = [m.labels[x] for x in row[:n]]
    return out
