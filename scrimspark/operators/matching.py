"""Pairs rows of two frames within a tolerance, as many as can be paired."""

from __future__ import annotations

import itertools
from collections import defaultdict, deque

import numpy as np

#: Cells are cut along so many columns at most; the others are compared, not hashed.
CELL_COLUMNS = 3


def near(a: np.ndarray, b: np.ndarray, tol: float) -> bool:
    """Whether no component differs by more than tol; a missing one only equals another missing one."""
    gone_a, gone_b = np.isnan(a), np.isnan(b)
    with np.errstate(invalid="ignore"):
        return bool(((gone_a & gone_b) | (a == b) | (np.abs(a - b) <= tol)).all())


def cell(v: np.ndarray, tol: float) -> tuple:
    return tuple("-" if np.isnan(x) else x if np.isinf(x) or not tol else int(np.floor(x / tol)) for x in v[:CELL_COLUMNS])


def around(c: tuple, tol: float) -> itertools.product:
    """The cells that hold what is within the tolerance of a row in c."""
    return itertools.product(*[(x - 1, x, x + 1) if isinstance(x, int) and tol else (x,) for x in c])


def paired_in_line(left: np.ndarray, right: np.ndarray, tol: float) -> list[tuple[int, int]]:
    """most_pairs() for one column: both sides in order, the smaller of two that are too far apart finds no partner."""
    order_left, order_right = left[:, 0].argsort(kind="stable"), right[:, 0].argsort(kind="stable")
    pairs, i, j = [], 0, 0
    while i < len(left) and j < len(right):
        a, b = left[order_left[i]], right[order_right[j]]
        if near(a, b, tol):
            pairs.append((int(order_left[i]), int(order_right[j])))
            i, j = i + 1, j + 1
        elif np.isnan(b[0]) or a[0] < b[0]:  # missing ones are last
            i += 1
        else:
            j += 1
    return pairs


def most_pairs(left: np.ndarray, right: np.ndarray, tol: float) -> list[tuple[int, int]]:
    """A largest set of pairs (i, j) of near rows, one row in one pair. Equal rows are one node with a capacity.

    Neighbours are looked up by cells. Paths that let one more left row be paired are searched breadth first, from the left
    rows in their order, so what is paired in one connected part doesn't depend on the others.
    """
    if left.shape[1] == 1:
        return paired_in_line(left, right, tol)
    lefts, of_left, free = np.unique(left, axis=0, return_inverse=True, return_counts=True)
    rights, of_right, room = np.unique(right, axis=0, return_inverse=True, return_counts=True)
    cells = defaultdict(list)
    for j, v in enumerate(rights):
        cells[cell(v, tol)].append(j)
    beside = [[j for c in around(cell(v, tol), tol) for j in cells.get(c, ()) if near(v, rights[j], tol)] for v in lefts]
    flow: list[dict[int, int]] = [{} for _ in rights]  # by right node: left node -> pairs
    for start in range(len(lefts)):
        while free[start]:
            came, waiting, end = {}, deque([start]), None
            reached = {start: None}
            while waiting and end is None:
                i = waiting.popleft()
                for j in beside[i]:
                    if j not in came:
                        came[j] = i
                        if room[j]:
                            end = j
                            break
                        for k in flow[j]:
                            if k not in reached:
                                reached[k] = j
                                waiting.append(k)
            if end is None:
                break
            path, j = [], end
            while j is not None:
                path.append((came[j], j))
                j = reached[came[j]]
            amount = min([int(free[start]), int(room[end]), *[flow[j][path[n][0]] for n, (_, j) in enumerate(path[1:])]])
            room[end] -= amount
            free[start] -= amount
            for n, (i, j) in enumerate(path):
                flow[j][i] = flow[j].get(i, 0) + amount
                if n:  # the pair of this right node with the left node before it on the path is given up
                    before = path[n - 1][0]
                    flow[j][before] -= amount
                    if not flow[j][before]:
                        del flow[j][before]
    rows_left, rows_right = ([deque(np.flatnonzero(of.ravel() == n)) for n in range(len(nodes))] for of, nodes in ((of_left, lefts), (of_right, rights)))
    return [(int(rows_left[i].popleft()), int(rows_right[j].popleft())) for j, of in enumerate(flow) for i, n in sorted(of.items()) for _ in range(n)]
