"""Suffix order of fixed-length windows, and longest-previous-factor arrays."""

from __future__ import annotations

import numpy as np

ROWS = 16_384


def suffix_order(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order the suffixes that begin at ``starts`` by their first ``length`` bytes.

    Returns numbers into ``starts``, equal ones by position, and the common prefix of each
    with the one before it, at most ``length``.
    """
    rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, length)[starts])
    order = np.argsort(rows.view(f"S{length}").ravel(), kind="stable")
    common = np.zeros(len(order), np.int64)
    for a in range(1, len(order), ROWS):
        b = min(a + ROWS, len(order))
        same = rows[order[a:b]] == rows[order[a - 1:b - 1]]
        common[a:b] = np.where(same.all(axis=1), length, same.argmin(axis=1))
    return order, common


def longest_previous(order: list[int], common: list[int]) -> list[int]:
    """For each position the longest match with one that begins earlier.

    ``order`` lists positions 0 to n - 1 in suffix order, ``common`` the prefix each shares
    with the one before it in that order. The match is with the nearest smaller position
    before or after it in suffix order; a stack of open positions finds both in one pass.
    """
    found = [0] * len(order)
    open_: list[tuple[int, int]] = []
    for position, shared in [*zip(order, common), (-1, 0)]:
        while open_ and position < open_[-1][0]:
            top, before = open_.pop()
            found[top] = max(before, shared)
            shared = min(before, shared)
        open_.append((position, shared))
    return found


def repeated(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which windows of ``length`` bytes occur earlier, and which occur later, in ``starts``."""
    earlier, later = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    order, common = suffix_order(data, starts, length)
    # A match of full length can only be among neighbours that share it.
    full = common >= length
    take = np.flatnonzero(full | np.append(full[1:], False))
    if not len(take):
        return earlier, later
    rank = np.empty(len(starts), np.int64)
    kept = np.sort(order[take])
    rank[kept] = np.arange(len(kept))
    positions, shared = rank[order[take]], common[take]
    earlier[kept] = np.array(longest_previous(positions.tolist(), shared.tolist())) >= length
    mirrored = (len(kept) - 1 - positions).tolist()
    later[kept[::-1]] = np.array(longest_previous(mirrored, shared.tolist())) >= length
    return earlier, later
