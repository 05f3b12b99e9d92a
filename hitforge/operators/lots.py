"""Average linkage of many small genes side by side, with the result of ``linkage`` for each.

Genes of about the same size are a lot: a stack of square matrices, of which each step merges one pair in every gene. The
likeness of two hits is looked up by the numbers of their names and symbols, so that each two names of a lot are compared
once, and only where bounds from characters and words let a pair reach the threshold or where its hits are connected.
"""

from __future__ import annotations

import numpy as np

from hitforge.functions.matching import _codes
from hitforge.functions.similarity import BONUS, CAP, NEAR, SYMBOLS_DIFFER, _tokens, ratio
from hitforge.operators.linkage import linkage

#: Hits up to which a gene goes into a lot, the step of sizes that share one, and cells of a lot's matrices.
SMALL, STEP, CELLS = 64, 8, 1 << 18
#: Characters are counted by the rest of their code points, which leaves the bounds valid, and pairs whose counts are compared at once.
BINS, PAIRS = 128, 1 << 13


def _counts(texts: list[str]) -> np.ndarray:
    """How many characters of each text are in each bin."""
    codes, at = _codes(texts)
    rows = np.repeat(np.arange(len(texts)), np.diff(at))
    return np.bincount(rows * BINS + codes % BINS, minlength=len(texts) * BINS).reshape(-1, BINS).astype(np.int32)


def _ratio_tops(counts: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What the ratios of pairs can reach at most."""
    shared = [np.minimum(counts[a[k : k + PAIRS]], counts[b[k : k + PAIRS]]).sum(axis=1) for k in range(0, len(a), PAIRS)]
    long = counts.sum(axis=1)
    size = long[a] + long[b]
    return np.where(size > 0, 2 * np.concatenate([*shared, np.zeros(0, np.int64)]) / np.maximum(size, 1), 1.0)


class Kinds:
    """Different names and symbols of many hits; ``x`` and ``y`` are each hit's numbers of them."""

    def __init__(self, names: list[str], symbols: list[str]):
        self.names, self.symbols = names, symbols
        self.words = [_tokens(n) for n in names]
        self.name_counts, self.symbol_counts = _counts(names), _counts(symbols)
        self.blank = np.array([not s for s in symbols], bool)

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Shared words over all words of pairs of names."""
        sets = ((self.words[u], self.words[v]) for u, v in zip(a.tolist(), b.tolist(), strict=True))
        return np.array([len(x & y) / len(x | y) if x and y else 0.0 for x, y in sets], np.float64)

    def symbol_ratios(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ratios of pairs of symbols, 0 where they are sure to differ."""
        out = (a == b).astype(np.float64)
        some = np.flatnonzero((a != b) & (_ratio_tops(self.symbol_counts, a, b) >= SYMBOLS_DIFFER - NEAR))
        out[some] = [ratio(self.symbols[u], self.symbols[v]) for u, v in zip(a[some].tolist(), b[some].tolist(), strict=True)]
        return out


class Alike:
    """Likeness of pairs of kinds, the first one's hit being the earlier: bounds at first, exact where it is asked for."""

    def __init__(self, kinds: Kinds, x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]):
        self.kinds = kinds
        pairs, self.of = np.unique(x[0] * len(kinds.names) + x[1], return_inverse=True)
        self.a, self.b = np.divmod(pairs, len(kinds.names))
        self.shared = kinds.shared(self.a, self.b)
        both = ~kinds.blank[y[0]] & ~kinds.blank[y[1]]
        pairs, of = np.unique(y[0][both] * len(kinds.symbols) + y[1][both], return_inverse=True)
        symbols = np.ones(len(both))
        symbols[both] = kinds.symbol_ratios(*np.divmod(pairs, len(kinds.symbols)))[of]
        self.capped, self.bonus = both & (symbols < SYMBOLS_DIFFER), both & (symbols == 1)
        self.ratios = np.full(len(self.a), np.nan)
        self.tops = self._moved(np.maximum(self.shared, _ratio_tops(kinds.name_counts, self.a, self.b))[self.of])

    def _moved(self, names: np.ndarray) -> np.ndarray:
        """Likeness of hits from that of their names."""
        return np.where(self.capped, np.minimum(names, CAP), np.where(self.bonus, np.minimum(1.0, names + BONUS), names))

    def exact(self, wanted: np.ndarray) -> np.ndarray:
        """Likeness where it is wanted; elsewhere less than the bound, or NaN."""
        shared = self.shared[self.of]
        compared = np.unique(self.of[wanted & (shared < 1) & ~(self.capped & (shared >= CAP))])
        compared = compared[np.isnan(self.ratios[compared])]
        names = self.kinds.names
        self.ratios[compared] = [ratio(names[u], names[v]) for u, v in zip(self.a[compared].tolist(), self.b[compared].tolist(), strict=True)]
        return self._moved(np.fmax(self.shared, self.ratios)[self.of])


def _connected(near: np.ndarray) -> np.ndarray:
    """The first hit that each hit of each gene is connected with."""
    near = near | near.transpose(0, 2, 1) | np.eye(near.shape[1], dtype=bool)
    part = np.broadcast_to(np.arange(near.shape[1], dtype=np.int16), near.shape[:2])
    while True:
        least = np.where(near, part[:, None, :], np.int16(near.shape[1])).min(axis=2)
        least = np.take_along_axis(least, least.astype(np.int64), axis=1)
        if (least == part).all():
            return part
        part = least


def _merged(sums: np.ndarray, sizes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For each hit of each gene the first hit of its cluster and its place in order of merging. ``sums`` are above the diagonal, -inf elsewhere."""
    genes, n = sums.shape[:2]
    out = np.empty((genes, n), np.int64), np.empty((genes, n), np.int64)
    number, column = np.arange(genes), np.arange(n)
    means, sums = sums, np.where(np.isfinite(sums), sums, 0.0)
    sums += sums.transpose(0, 2, 1)
    alive = column < sizes[:, None]
    size, of, place = np.ones((genes, n)), np.tile(column, (genes, 1)), np.zeros((genes, n), np.int64)
    while True:
        best = means.max(axis=2)
        top = best.max(axis=1)
        going = top >= threshold - NEAR
        if not going.all():
            out[0][number[~going]], out[1][number[~going]] = of[~going], place[~going]
            if not going.any():
                return out
            number, means, sums, alive, size, of, place, best, top = (v[going] for v in (number, means, sums, alive, size, of, place, best, top))
        g, top = np.arange(len(number)), top[:, None] - NEAR
        a = (best >= top).argmax(axis=1)
        b = (means[g, a] >= top).argmax(axis=1)
        joins = of == b[:, None]
        place += joins * size[g, a].astype(np.int64)[:, None]
        of = np.where(joins, a[:, None], of)
        row = sums[g, a] + sums[g, b]
        sums[g, a], sums[g, :, a] = row, row
        size[g, a] += size[g, b]
        alive[g, b] = False
        mean = np.where(alive, row / (size[g, a][:, None] * size), -np.inf)
        means[g, a] = np.where(column > a[:, None], mean, -np.inf)
        means[g, :, a] = np.where(column < a[:, None], mean, -np.inf)
        means[g, b], means[g, :, b] = -np.inf, -np.inf


def _lot(kinds: Kinds, x: np.ndarray, y: np.ndarray, sizes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """As ``_merged``, of genes whose hits have the names ``x`` and symbols ``y``, a gene a row."""
    n = x.shape[1]
    i, j = np.triu_indices(n, 1)
    gene, at = np.nonzero(j < sizes[:, None])
    i, j = i[at], j[at]
    different, kind = np.unique(x * len(kinds.symbols) + y, return_inverse=True)
    kind = kind.reshape(x.shape)
    pairs, of = np.unique(kind[gene, i] * len(different) + kind[gene, j], return_inverse=True)
    u, v = (np.divmod(different[k], len(kinds.symbols)) for k in np.divmod(pairs, len(different)))
    alike = Alike(kinds, (u[0], v[0]), (u[1], v[1]))
    wanted = alike.tops >= threshold - NEAR
    near = np.zeros((len(x), n, n), bool)
    near[gene, i, j] = (wanted & (alike.exact(wanted) >= threshold - NEAR))[of]
    part = _connected(near)
    inside = part[gene, i] == part[gene, j]
    wanted[of[inside]] = True
    sums = np.full((len(x), n, n), -np.inf)
    sums[gene, i, j] = np.where(inside, alike.exact(wanted)[of], 0.0)
    return _merged(sums, sizes, threshold)


def clusters_of_genes(starts: np.ndarray, names: tuple[list[str], np.ndarray], symbols: tuple[list[str], np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For each hit the row of its cluster's first hit and its place in order of merging.

    A gene's hits stand behind each other from its place in ``starts``, whose last one is their number; ``names`` (normalised)
    and ``symbols`` (lower-case) are the different ones and each hit's number of them.
    """
    x, y = names[1], symbols[1]
    first, place = np.arange(len(x)), np.zeros(len(x), np.int64)
    begin, sizes = starts[:-1], np.diff(starts)
    if threshold - NEAR > 1.0:
        return first, place
    for k in np.flatnonzero(sizes > SMALL).tolist():
        rows = np.arange(starts[k], starts[k + 1])
        for c in linkage([names[0][i] for i in x[rows]], [symbols[0][i] for i in y[rows]], threshold):
            first[rows[c]], place[rows[c]] = rows[c[0]], np.arange(len(c))
    steps = -(-sizes // STEP)
    if not ((sizes > 1) & (sizes <= SMALL)).any():
        return first, place
    kinds = Kinds(names[0], symbols[0])
    for step in range(1, SMALL // STEP + 1):
        own = np.flatnonzero((steps == step) & (sizes > 1))
        n = step * STEP
        lot = max(1, CELLS // n**2)
        for k in range(0, len(own), lot):
            some = own[k : k + lot]
            inside = np.arange(n) < sizes[some][:, None]
            rows = begin[some][:, None] + np.where(inside, np.arange(n), 0)
            of, at = _lot(kinds, x[rows], y[rows], sizes[some], threshold)
            first[rows[inside]], place[rows[inside]] = np.take_along_axis(rows, of, axis=1)[inside], at[inside]
    return first, place
