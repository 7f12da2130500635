"""Independent references for ranking metrics, from their definitions (small arrays)."""

import numpy as np


def _rules(y, s):
    """(threshold, predictions) of every rule ``score >= threshold``, highest threshold first."""
    return [(t, (s >= t).astype(int)) for t in sorted(set(s.tolist()), reverse=True)]


def average_precision(y, s):
    """Sum over distinct thresholds of precision times the recall gained."""
    y, s = np.asarray(y), np.asarray(s, dtype=float)
    if y.sum() == 0:
        return 0.0
    total, before = 0.0, 0.0
    for _, guess in _rules(y, s):
        recall = y[guess == 1].sum() / y.sum()
        total += y[guess == 1].mean() * (recall - before)
        before = recall
    return float(total)


def pair_auc(y, s):
    """Share of (positive, negative) pairs ranked rightly, ties counting half."""
    y, s = np.asarray(y), np.asarray(s, dtype=float)
    pos, neg = s[y == 1], s[y == 0]
    if not len(pos) or not len(neg):
        return 0.0
    gap = pos[:, None] - neg[None, :]
    return float(((gap > 0) + 0.5 * (gap == 0)).mean())


def mcc_by_threshold(y, s):
    """{threshold: correlation of labels and predictions}, 0 where either is constant."""
    y, s = np.asarray(y), np.asarray(s, dtype=float)
    return {t: 0.0 if guess.min() == guess.max() or y.min() == y.max() else float(np.corrcoef(y, guess)[0, 1])
            for t, guess in _rules(y, s)}
