"""Average linkage of one gene's hits, or of a connected part of them, on its different names and symbols.

The pair of clusters with the greatest average likeness merges, the first one of equal pairs, while it reaches the threshold.

Equal hits have likeness 1 and merge before all else. These first merges are read off the classes of equal hits: a
cluster takes each later hit that has likeness 1 with all it holds. What is left are as many clusters as there are
different hits, about; sums of likeness between them come from counts of hits, so the work doesn't grow with the square
of the hits. Each row of sums keeps its best mean, so that a merge costs as much as there are clusters.
"""

from __future__ import annotations

import numpy as np

from hitforge.functions.similarity import NEAR, Labels, classes


#: Rows of sums whose best means are looked for at once.
ROWS = 1024


def _root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def joined_pairs(labels: Labels, a: np.ndarray, b: np.ndarray, first: np.ndarray, last: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Pairs of ``a`` and ``b`` that reach the threshold in an order in which their hits stand, one less than each part has.

    ``first`` and ``last`` are the places of each one's first and last hit.
    """
    parent = list(range(len(labels.names)))
    found = []
    for i, row in zip(a.tolist(), labels.bounds(a, b) >= threshold - NEAR, strict=True):
        for j in b[row].tolist():
            x, y = _root(parent, i), _root(parent, j)
            if x != y and max(labels.alike(u, v) if first[u] < last[v] else -1.0 for u, v in ((i, j), (j, i))) >= threshold - NEAR:
                parent[y] = x
                found.append((i, j))
    return found


def _first_merges(of: np.ndarray, one: np.ndarray) -> list[np.ndarray]:
    """Clusters of rows that merge at likeness 1, in order of their first rows; ``one[u, v]`` tells whether a row of class v has that with earlier ones of class u."""
    left, made = np.arange(len(of)), []
    while len(left):
        own = of[left]
        inside = np.zeros(len(one), bool)
        inside[own[0]] = True
        allowed, taken, at = one[own[0]].copy(), np.zeros(len(left), bool), 1
        taken[0] = True
        while at < len(left):
            rest = own[at:]
            good = allowed[rest]
            new = np.flatnonzero(good & ~inside[rest])
            end = at + (int(new[0]) if len(new) else len(rest))
            taken[at:end] = good[: end - at]
            if len(new):  # the first row of a class joins, which can exclude others
                taken[end] = inside[own[end]] = True
                allowed &= one[own[end]]
            at = end + 1
        made.append(left[taken])
        left = left[~taken]
    return made


def _likeness(labels: Labels, of: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Likeness of the classes ``some``, the row's one first, for orders in which their rows in ``of`` stand."""
    first, last = np.full(len(some), len(of)), np.full(len(some), -1)
    np.minimum.at(first, of, np.arange(len(of)))
    np.maximum.at(last, of, np.arange(len(of)))
    like = labels.likeness(some, first[:, None] < last)
    np.fill_diagonal(like, 1.0)
    return like


def _sums(items: list[np.ndarray], of: np.ndarray, like: np.ndarray) -> np.ndarray:
    """Summed likeness of the rows of every two clusters; of two rows the earlier one comes first."""
    parts, starts = [], []
    for item in items:
        starts.append(len(parts))
        kinds = of[item]
        parts += [(int(c), item[kinds == c]) for c in dict.fromkeys(kinds.tolist())]
    kind = np.array([c for c, _ in parts])
    n = np.array([len(r) for _, r in parts])
    first, last = np.array([r[0] for _, r in parts]), np.array([r[-1] for _, r in parts])
    forth, back = like[np.ix_(kind, kind)], like.T[np.ix_(kind, kind)]
    sums = np.outer(n, n) * np.where(last[:, None] < first, forth, back)
    mixed = (last[:, None] > first) & (first[:, None] < last) & (forth != back)
    for p, q in np.argwhere(np.triu(mixed, 1)).tolist():
        ahead = int((n[q] - np.searchsorted(parts[q][1], parts[p][1])).sum())
        sums[p, q] = sums[q, p] = ahead * forth[p, q] + (n[p] * n[q] - ahead) * back[p, q]
    if len(parts) > len(items):
        sums = np.add.reduceat(np.add.reduceat(sums, starts, axis=0), starts, axis=1)
    return sums


def _merged(items: list[np.ndarray], sums: np.ndarray, threshold: float) -> list[list[int]]:
    """Merges clusters, which are in order of their first rows, while the best mean reaches the threshold."""
    k = len(items)
    members, sizes = [item.tolist() for item in items], np.array([float(len(item)) for item in items])
    alive = np.ones(k, bool)
    np.fill_diagonal(sums, -np.inf)

    def bests(rows: np.ndarray) -> np.ndarray:
        """The best mean of each cluster with the clusters behind it."""
        behind = alive & (place > rows[:, None])
        return np.where(behind, sums[rows] / (sizes[rows][:, None] * sizes), -np.inf).max(axis=1, initial=-np.inf)

    place = np.arange(k)
    best = np.concatenate([bests(place[i : i + ROWS]) for i in range(0, k, ROWS)])
    while (top := best.max(initial=-np.inf)) >= threshold - NEAR:
        a = int((best >= top - NEAR).argmax())
        b = a + 1 + int((np.where(alive[a + 1 :], sums[a, a + 1 :] / (sizes[a] * sizes[a + 1 :]), -np.inf) >= top - NEAR).argmax())
        before = np.flatnonzero(alive[:b])
        held = sums[before, b] / (sizes[before] * sizes[b])
        n = int(np.searchsorted(before, a))
        held[:n] = np.maximum(held[:n], sums[before[:n], a] / (sizes[before[:n]] * sizes[a]))
        stale = np.union1d(before[held >= best[before] - NEAR], a)  # their best may have been with a or b
        sums[a] += sums[b]
        sums[:, a] = sums[a]
        sums[a, a] = -np.inf
        sizes[a] += sizes[b]
        members[a] += members[b]
        members[b] = []
        alive[b], best[b] = False, -np.inf
        best[stale] = bests(stale)
        upto = before[:n]
        best[upto] = np.maximum(best[upto], sums[upto, a] / (sizes[upto] * sizes[a]))
    return [m for m in members if m]


def linkage(names: list[str], symbols: list[str], threshold: float) -> list[list[int]]:
    """Clusters as lists of positions in order of merging, in order of their first positions."""
    if threshold - NEAR > 1.0:
        return [[i] for i in range(len(names))]
    of, labels = classes(names, symbols)
    k = len(labels.names)
    first, last = np.full(k, len(of)), np.full(k, -1)
    np.minimum.at(first, of, np.arange(len(of)))
    np.maximum.at(last, of, np.arange(len(of)))
    parent, every = list(range(k)), np.arange(k)
    for i, j in joined_pairs(labels, every, every, first, last, threshold):
        parent[_root(parent, j)] = _root(parent, i)
    part = np.array([_root(parent, i) for i in range(k)])
    out = []
    for p in dict.fromkeys(part.tolist()):
        some = np.flatnonzero(part == p)
        rows = np.flatnonzero(part[of] == p)
        if len(some) == 1:
            out.append(rows.tolist())
            continue
        own = np.searchsorted(some, of[rows])
        like = _likeness(labels, own, some)
        items = _first_merges(own, like >= 1.0 - NEAR)
        out += [rows[m].tolist() for m in _merged(items, _sums(items, own, like), threshold)]
    return sorted(out, key=lambda m: m[0])
