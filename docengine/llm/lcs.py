"""Similarity by the longest common subsequence."""

from __future__ import annotations

import numpy as np


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bits of a word at a time."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | (1 << i)
    row = full = (1 << len(a)) - 1
    for c in b:
        m = row & where.get(c, 0)
        row = ((row + m) | (row - m)) & full
    return len(a) - row.bit_count()


def lcs_ratio(a: str, b: str) -> float:
    """Twice the common length over both lengths; 1 for equal texts, 0 if one is empty."""
    if a == b:
        return 1.0 if a else 0.0
    n = len(a) + len(b)
    return 2 * lcs_length(a, b) / n if a and b else 0.0


def lcs_ratios(a: np.ndarray, b: np.ndarray, chunk: int = 1 << 14) -> np.ndarray:
    """``lcs_ratio`` of each pair of two arrays of texts, all pairs of a chunk a letter at a time; texts over 63 letters one by one."""
    out = np.zeros(len(a))
    if len(a) == 0:
        return out
    size_a, size_b = np.char.str_len(a), np.char.str_len(b)
    short = np.flatnonzero((size_a <= 63) & (size_b <= 63) & (size_a > 0) & (size_b > 0))
    for i in np.flatnonzero((size_a > 63) | (size_b > 63)):
        out[i] = lcs_ratio(str(a[i]), str(b[i]))
    for lo in range(0, len(short), chunk):
        at = short[lo : lo + chunk]
        known, left = np.unique(a[at], return_inverse=True)
        wide = int(max(size_a[at].max(), size_b[at].max()))
        ours, theirs = (np.ascontiguousarray(x.astype(f"U{wide}")).view(np.uint32).reshape(len(x), wide) for x in (known, b[at]))
        seen = np.zeros(int(max(ours.max(), theirs.max())) + 1, bool)
        seen[ours] = seen[theirs] = True
        place = np.cumsum(seen) - 1
        letters, ours, theirs = int(seen.sum()), place[ours], place[theirs]
        masks = np.zeros((len(known), letters), np.uint64)
        for j in range(int(size_a[at].max())):
            masks[np.arange(len(known)), ours[:, j]] |= np.uint64(1 << j)
        full = (np.uint64(1) << size_a[at].astype(np.uint64)) - np.uint64(1)
        row, sizes = full.copy(), size_b[at]
        for j in range(int(sizes.max())):
            m = row & masks[left, theirs[:, j]]
            m[sizes <= j] = 0
            row = ((row + m) | (row - m)) & full
        common = size_a[at] - np.bitwise_count(row)
        out[at] = 2 * common / (size_a[at] + sizes)
    return out
