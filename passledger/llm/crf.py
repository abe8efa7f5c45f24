"""Linear-chain conditional random fields in numpy: training, Viterbi, exact marginals.

Features are hashed to rows of one weight table.  Training takes equally long padded
windows; decoding takes emission scores, so that callers can cache them by token.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np


def slot(name: str, slots: int) -> int:
    """Row of a feature; row 0 is that of padding and stays 0."""
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % (slots - 1) + 1


@dataclass
class Crf:
    """weights: features x labels; steps: scores of neighbours (from, to); first, last: of sequence ends."""

    weights: np.ndarray
    steps: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def emission(self, rows: list[int]) -> np.ndarray:
        return self.weights[rows].sum(axis=0)

    def viterbi(self, emissions: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> list[int]:
        """The best labels; ties go to the smaller label.  `first`, `last` replace the scores of the ends."""
        n = len(emissions)
        if not n:
            return []
        score = emissions[0] + (self.first if first is None else first)
        back = np.zeros((n, len(score)), np.int64)
        for t in range(1, n):
            through = score[:, None] + self.steps
            back[t] = through.argmax(axis=0)
            score = through.max(axis=0) + emissions[t]
        path = [int((score + (self.last if last is None else last)).argmax())]
        for t in range(n - 1, 0, -1):
            path.append(int(back[t, path[-1]]))
        return path[::-1]

    def certain_margin(self, label: int) -> float:
        """A token whose emission for `label` leads every other by more has that label, whatever its neighbours."""
        ends = np.concatenate([self.steps, self.first[None, :]]), np.concatenate([self.steps.T, self.last[None, :]])
        gain = [(ends[0][:, x] - ends[0][:, label]).max() + (ends[1][:, x] - ends[1][:, label]).max() for x in range(len(self.first)) if x != label]
        return float(max(gain))


def train(features: np.ndarray, labels: np.ndarray, slots: int, n_labels: int, epochs: int = 20, rate: float = 0.3, l2: float = 1e-5, batch: int = 256, seed: int = 5) -> Crf:
    """Fits by Adagrad on the exact likelihood.

    features: windows x tokens x features, 0 for none; labels: windows x tokens, -1 after
    the end of a shorter window.
    """
    weights, steps = np.zeros((slots, n_labels)), np.zeros((n_labels, n_labels))
    first, last = np.zeros(n_labels), np.zeros(n_labels)
    seen = [np.full_like(x, 1e-6) for x in (weights, steps, first, last)]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(features))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            grads = _gradients(features[own], labels[own], weights, steps, first, last)
            for x, g, s in zip((weights, steps, first, last), grads, seen):
                g = g / len(own) + l2 * x
                s += g * g
                x -= rate * g / np.sqrt(s)
            weights[0] = 0
    return Crf(weights, steps, first, last)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _gradients(features, labels, weights, steps, first, last):
    n, width, _ = features.shape
    n_labels = len(first)
    mask = labels >= 0
    emission = weights[features].sum(axis=2)
    alpha = np.empty((width, n, n_labels))
    alpha[0] = emission[:, 0] + first
    for t in range(1, width):
        new = _logsum(alpha[t - 1][:, :, None] + steps, 1) + emission[:, t]
        alpha[t] = np.where(mask[:, t, None], new, alpha[t - 1])
    total = _logsum(alpha[-1] + last, 1)
    beta = np.empty_like(alpha)
    beta[-1] = last
    step_grad = np.zeros_like(steps)
    for t in range(width - 2, -1, -1):
        inner = emission[:, t + 1] + beta[t + 1]
        beta[t] = np.where(mask[:, t + 1, None], _logsum(steps + inner[:, None, :], 2), beta[t + 1])
        both = np.exp(alpha[t][:, :, None] + steps + inner[:, None, :] - total[:, None, None])
        step_grad += (both * mask[:, t + 1, None, None]).sum(axis=0)
        here, there = labels[mask[:, t + 1], t], labels[mask[:, t + 1], t + 1]
        np.subtract.at(step_grad, (here, there), 1)
    delta = np.exp(alpha + beta - total[None, :, None]).transpose(1, 0, 2) * mask[:, :, None]
    rows, cols = np.nonzero(mask)
    delta[rows, cols, labels[rows, cols]] -= 1
    first_grad = delta[:, 0].sum(axis=0)
    ends = mask.sum(axis=1) - 1
    last_grad = delta[np.arange(n), ends].sum(axis=0)
    flat = features.ravel()
    grad = np.stack([np.bincount(flat, np.repeat(delta[:, :, y].ravel(), features.shape[2]), len(weights)) for y in range(n_labels)], axis=1)
    return grad, step_grad, first_grad, last_grad


#: Tokens in a chunk of `marginals`.
_CHUNK = 128


def marginals(scores: np.ndarray, lengths: np.ndarray, crf: Crf) -> np.ndarray:
    """P(label 1) of every token of two-label sequences that lie one after another, by forward-backward.

    `scores` holds emission of label 1 less that of label 0.  Sequences are cut into
    chunks; a chunk's effect on the ratio of forward scores is a 2 x 2 matrix, so ratios
    at chunk starts come from a scan over matrices and all chunks then run side by side.
    The result is exact, and its time does not hang on the longest sequence.
    """
    if not len(scores):
        return np.zeros(0)
    keep = lengths > 0
    lengths = lengths[keep]
    step = np.exp(crf.steps - crf.steps[0, 0])
    x = np.exp(np.clip(scores, -40, 40))
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    x[starts] *= np.exp(np.clip(crf.first[1] - crf.first[0], -40, 40))
    per = -(-lengths // _CHUNK)
    owner = np.repeat(np.arange(len(lengths)), per)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    begin = starts[owner] + nth * _CHUNK
    size = np.minimum(_CHUNK, starts[owner] + lengths[owner] - begin)
    order = np.argsort(-size, kind="stable")
    begin_o, size_o = begin[order], size[order]
    active = [int(np.searchsorted(-size_o, -t, side="left")) for t in range(_CHUNK + 1)]
    # Effect of a chunk, without its first token's step if it starts a sequence.
    opens = (nth == 0)[order]
    c = len(order)
    m = np.zeros((2, 2, c))
    m[0, 0] = m[1, 1] = 1
    for t in range(_CHUNK):
        k = active[t]
        if not k:
            break
        e = x[begin_o[:k] + t]
        a = step.T[:, :, None] if t else np.where(opens[:k], np.eye(2)[:, :, None], step.T[:, :, None])
        new0 = a[0, 0] * m[0, :, :k] + a[0, 1] * m[1, :, :k]
        new1 = (a[1, 0] * m[0, :, :k] + a[1, 1] * m[1, :, :k]) * e
        norm = (new0 + new1).max(axis=0)
        m[0, :, :k], m[1, :, :k] = new0 / norm, new1 / norm
    effect = np.empty_like(m)
    effect[:, :, order] = m
    head = np.cumsum(per) - per
    # Forward scores at chunk starts and backward scores at chunk ends, (label 0, label 1).
    fore, aft = np.ones((2, c)), np.ones((2, c))
    final = np.exp(np.clip(crf.last[1] - crf.last[0], -40, 40))
    aft[1, head + per - 1] = final
    by_size = np.argsort(-per, kind="stable")
    per_o, head_o = per[by_size], head[by_size]
    for j in range(1, int(per.max())):
        k = int(np.searchsorted(-per_o, -j, side="left"))
        at = head_o[:k] + j
        v = np.einsum("abk,bk->ak", effect[:, :, at - 1], fore[:, at - 1])
        fore[:, at] = v / v.sum(axis=0)
        at = head_o[:k] + per_o[:k] - 1 - j
        v = np.einsum("abk,ak->bk", effect[:, :, at + 1], aft[:, at + 1])
        aft[:, at] = v / v.sum(axis=0)
    out = np.empty(len(x))
    r = (fore[1] / fore[0])[order]
    ratios = np.ones((_CHUNK, c))
    for t in range(_CHUNK):
        k = active[t]
        if not k:
            break
        moved = (step[0, 1] + r[:k] * step[1, 1]) / (step[0, 0] + r[:k] * step[1, 0])
        r[:k] = (moved if t else np.where(opens[:k], 1.0, moved)) * x[begin_o[:k] + t]
        ratios[t, :k] = r[:k]
    s = (aft[1] / aft[0])[order]
    for t in range(_CHUNK - 1, -1, -1):
        k = active[t]
        if not k:
            continue
        odds = ratios[t, :k] * s[:k]
        out[begin_o[:k] + t] = odds / (1 + odds)
        y = x[begin_o[:k] + t] * s[:k]
        s[:k] = (step[1, 0] + step[1, 1] * y) / (step[0, 0] + step[0, 1] * y)
    return out
