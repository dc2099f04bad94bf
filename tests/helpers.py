"""Brute-force counterparts in plain Python, for small fixtures."""

from __future__ import annotations


def brute_auc(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y != 1]
    if not pos or not neg:
        return None
    won = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return won / (len(pos) * len(neg))


def brute_pr_auc(labels, scores):
    positives = sum(1 for y in labels if y == 1)
    if positives == 0:
        return 0.5
    area, rec0, prec0 = 0.0, 0.0, 1.0
    for cut in sorted(set(scores), reverse=True):
        called = [y for y, s in zip(labels, scores) if s >= cut]
        hit = sum(1 for y in called if y == 1)
        rec, prec = hit / positives, hit / len(called)
        area += (rec - rec0) * (prec + prec0) / 2
        rec0, prec0 = rec, prec
    return area


def close(a, b, tolerance=1e-9):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) <= tolerance
