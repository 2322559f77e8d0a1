"""A binary linear-chain conditional random field over many sequences.

Sequences of any length are laid out in blocks of ``BLOCK`` positions.  Block
transfer matrices, a scan over the blocks of each sequence and a second pass
within the blocks give the exact forward-backward marginals with a number of
array operations that follows the block size and the longest sequence's block
count, not the number of tokens.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64


class Layout:
    """Where tokens of consecutive sequences of the given lengths lie."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        self.blocks = -(-lengths // BLOCK)
        self.first = np.cumsum(self.blocks) - self.blocks          # a sequence's first block
        n = int(lengths.sum())
        inside = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.at = np.repeat(self.first * BLOCK, lengths) + inside  # token -> cell
        self.n_blocks = int(self.blocks.sum())
        self.used = np.zeros(self.n_blocks * BLOCK, bool)
        self.used[self.at] = True
        self.used = self.used.reshape(-1, BLOCK)
        self.deep = [np.flatnonzero(self.blocks > k) for k in range(int(self.blocks.max(initial=0)))]


def _normal(v: np.ndarray, axis) -> np.ndarray:
    return v / v.sum(axis=axis, keepdims=True)


def marginals(score: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """P(label 1) of every token; ``score``: log-odds of its label 1 in favour
    of 0, ``trans``: 2 x 2 log potentials of neighbours (from, to)."""
    return chain(score, Layout(lengths), trans)[0]


def chain(score: np.ndarray, lay: Layout, trans: np.ndarray):
    """(marginals, cells' forward and backward messages)."""
    if not lay.n_blocks:
        return np.empty(0), None, None
    odds = np.zeros(lay.n_blocks * BLOCK)
    odds[lay.at] = np.clip(score, -30, 30)
    emit = np.stack([np.ones_like(odds), np.exp(odds)], axis=1).reshape(-1, BLOCK, 2)
    emit /= emit.sum(axis=2, keepdims=True)
    move, same = np.exp(trans), np.eye(2)
    # step[b, i] carries the message into cell i: trans times emission, or nothing in unused cells.
    step = move[None, None] * emit[:, :, None, :]
    step[~lay.used] = same
    begin = lay.first[lay.blocks > 0]
    step[begin, 0] = emit[begin, 0][:, None, :] * np.full((2, 2), 0.5)       # a sequence begins anew
    whole = np.broadcast_to(same, (lay.n_blocks, 2, 2))
    for i in range(BLOCK):
        whole = _normal(whole @ step[:, i], (1, 2))
    ahead, behind = np.full((lay.n_blocks, 2), 0.5), np.full((lay.n_blocks, 2), 0.5)
    for k, deep in list(enumerate(lay.deep))[1:]:
        b = lay.first[deep] + k
        ahead[b] = _normal(np.einsum("bi,bij->bj", ahead[b - 1], whole[b - 1]), 1)
    for k, deep in list(enumerate(lay.deep))[:0:-1]:
        b = lay.first[deep] + k
        behind[b - 1] = _normal(np.einsum("bij,bj->bi", whole[b], behind[b]), 1)
    fore, back = np.empty((BLOCK, lay.n_blocks, 2)), np.empty((BLOCK, lay.n_blocks, 2))
    v = ahead
    for i in range(BLOCK):
        v = fore[i] = _normal(np.einsum("bi,bij->bj", v, step[:, i]), 1)
    v = behind
    for i in range(BLOCK - 1, -1, -1):
        back[i] = v
        v = _normal(np.einsum("bij,bj->bi", step[:, i], v), 1)
    both = fore * back
    p = (both[:, :, 1] / both.sum(axis=2)).T.ravel()[lay.at]
    return p, fore, back


def edge_means(score: np.ndarray, lay: Layout, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(marginals, expected counts of label pairs over neighbours)."""
    p, fore, back = chain(score, lay, trans)
    f = fore.transpose(1, 0, 2).reshape(-1, 2)[lay.at]
    b = back.transpose(1, 0, 2).reshape(-1, 2)[lay.at]
    odds = np.stack([np.ones(len(score)), np.exp(np.clip(score, -30, 30))], axis=1)
    odds /= odds.sum(axis=1, keepdims=True)
    inner = np.ones(len(score), bool)
    inner[(np.cumsum(lay.lengths) - lay.lengths)[lay.lengths > 0]] = False
    to = np.flatnonzero(inner)
    joint = f[to - 1][:, :, None] * np.exp(trans)[None] * (odds[to] * b[to])[:, None, :]
    return p, (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


def fit(x: np.ndarray, y: np.ndarray, lengths: np.ndarray, rounds: int = 60, l2: float = 1e-3,
        rate: float = 0.3, marks: np.ndarray | None = None, width: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights of the features, weights of the marks, transition potentials)
    by gradient ascent on the conditional log-likelihood, with Adam steps.
    ``marks``: for each token the numbers, below ``width``, of its 0/1 features."""
    lay, n, dense = Layout(lengths), len(y), x.shape[1]
    marks = np.empty((n, 0), np.int64) if marks is None else marks
    inner = np.ones(n, bool)
    inner[(np.cumsum(lengths) - lengths)[lengths > 0]] = False
    to = np.flatnonzero(inner)
    seen = np.bincount(2 * y[to - 1] + y[to], minlength=4).reshape(2, 2)
    theta = np.zeros(dense + width + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    positives = max(1, int(y.sum()))
    for k in range(1, rounds + 1):
        w, h, trans = theta[:dense], theta[dense:-4], theta[-4:].reshape(2, 2)
        p, pairs = edge_means(x @ w + h[marks].sum(axis=1), lay, trans)
        off = y - p
        told = sum((np.bincount(column, weights=off, minlength=width) for column in marks.T), np.zeros(width))
        grad = np.concatenate([x.T @ off, told, (seen - pairs).ravel()]) / positives - l2 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta += rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return theta[:dense], theta[dense:-4], theta[-4:].reshape(2, 2)
