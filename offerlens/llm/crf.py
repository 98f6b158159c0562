"""A linear-chain conditional random field over binary features, trained and decoded with numpy.

Training maximises the regularised likelihood by full-batch gradient steps on padded
sequences (forward-backward in log space, all sequences at a time). It runs on the driver,
on a sample whose bound the callers document; the model is a small table that travels with
the tasks that decode.
"""

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Crf:
    """Weights: ``emit[feature, label]``, ``move[label, next label]`` and ``start[label]``."""

    labels: tuple[str, ...]
    features: dict[str, int] = field(default_factory=dict)
    emit: np.ndarray | None = None
    move: np.ndarray | None = None
    start: np.ndarray | None = None

    def scores(self, names: list[list[str]]) -> np.ndarray:
        """Label scores of each element; features never seen in training add nothing."""
        known, emit = self.features, self.emit
        out = np.zeros((len(names), len(self.labels)))
        for i, own in enumerate(names):
            ids = [known[name] for name in own if name in known]
            if ids:
                out[i] = emit[ids].sum(axis=0)
        return out

    def decode(self, scores: np.ndarray) -> list[int]:
        """Viterbi: the labels of the best path; the lower label wins a tie."""
        if not len(scores):
            return []
        best, back = self.start + scores[0], []
        for row in scores[1:]:
            paths = best[:, None] + self.move
            came = paths.argmax(axis=0)
            back.append(came)
            best = paths[came, np.arange(len(came))] + row
        path = [int(best.argmax())]
        for came in reversed(back):
            path.append(int(came[path[-1]]))
        return path[::-1]

    def fit(self, sequences: list[tuple[list[list[str]], list[int]]], steps: int = 120, rate: float = 0.3,
            penalty: float = 0.05) -> "Crf":
        """Train on (features of each element, label of each element) pairs."""
        sequences = [(names, labels) for names, labels in sequences if labels]
        n = len(self.labels)
        known = self.features = {"": 0}
        rows = [[[known.setdefault(name, len(known)) for name in own] for own in names] for names, _ in sequences]
        count, longest = len(rows), max((len(r) for r in rows), default=1)
        width = max((len(ids) for r in rows for ids in r), default=1)
        ids = np.zeros((count, longest, max(width, 1)), dtype=np.int64)
        gold = np.zeros((count, longest), dtype=np.int64)
        mask = np.zeros((count, longest), dtype=bool)
        for s, (row, (_, labels)) in enumerate(zip(rows, sequences, strict=True)):
            mask[s, : len(row)] = True
            gold[s, : len(row)] = labels
            for t, own in enumerate(row):
                ids[s, t, : len(own)] = own
        self.emit, self.move, self.start = np.zeros((len(known), n)), np.zeros((n, n)), np.zeros(n)
        if not count:
            return self
        truth = np.eye(n)[gold] * mask[..., None]
        pairs = (truth[:, :-1, :, None] * truth[:, 1:, None, :]).sum(axis=(0, 1))
        squares = [np.full_like(w, 1e-8) for w in (self.emit, self.move, self.start)]
        for _ in range(steps):
            scores = self.emit[ids].sum(axis=2)
            single, double, first = self._marginals(scores, mask)
            error = truth - single
            grad = np.stack(
                [np.bincount(ids.ravel(), np.repeat(error[..., k].ravel(), ids.shape[2]), len(known)) for k in range(n)], axis=1
            )
            grad[0] = 0.0
            grads = [grad, pairs - double, truth[:, 0].sum(axis=0) - first]
            for weight, slope, square in zip((self.emit, self.move, self.start), grads, squares, strict=True):
                slope = slope - penalty * weight
                square += slope**2
                weight += rate * slope / np.sqrt(square)
        return self

    def _marginals(self, scores: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected labels of each element, expected label pairs and first labels, over all sequences."""
        count, longest, n = scores.shape
        ahead = np.empty_like(scores)
        ahead[:, 0] = self.start + scores[:, 0]
        for t in range(1, longest):
            step = _log_sum(ahead[:, t - 1, :, None] + self.move, 1) + scores[:, t]
            ahead[:, t] = np.where(mask[:, t, None], step, ahead[:, t - 1])
        behind = np.zeros_like(scores)
        for t in range(longest - 2, -1, -1):
            step = _log_sum(self.move + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(mask[:, t + 1, None], step, 0.0)
        total = _log_sum(ahead[:, -1], 1)
        single = np.exp(ahead + behind - total[:, None, None]) * mask[..., None]
        after = (scores + behind)[:, 1:]
        double = np.exp(ahead[:, :-1, :, None] + self.move + after[:, :, None, :] - total[:, None, None, None])
        double *= mask[:, 1:, None, None]
        return single, double.sum(axis=(0, 1)), single[:, 0].sum(axis=0)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))
