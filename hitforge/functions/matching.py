"""Matching blocks of many pairs of texts at once.

The longest block that two texts have in common, of equal ones the earliest in the first text and then in the second, parts
both; what lies before and behind it is treated alike. All stretches of all pairs that are open go through one table of
runs side by side, a character of the first texts at a time. In a second text of 200 characters or more, characters that
make up more than a hundredth of it begin no block; a block only extends over them.
"""

from __future__ import annotations

from collections import Counter

import numpy as np

#: Cells of the table of runs that are held at once.
CELLS = 1 << 16
#: Length from which frequent characters begin no block, and the share of a text that makes them frequent.
LONG, FREQUENT = 200, 100
#: No characters: behind the end of a first text, behind the end of a second one, and a frequent character.
AFTER_A, AFTER_B = 0xFFFFFFFF, 0xFFFFFFFE


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts behind each other, and where each begins."""
    sizes = np.array([len(t) for t in texts], np.int64)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def _longest(a: np.ndarray, b: np.ndarray, a0: np.ndarray, la: np.ndarray, b0: np.ndarray, lb: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start in a, start in b and length of the longest common block of each stretch; length 0 at both begins if there is none."""
    columns = np.arange(int(lb.max()))
    other = np.where(columns < lb[:, None], b[np.minimum(b0[:, None] + columns, len(b) - 1)], np.uint32(AFTER_B))
    runs = np.zeros((len(a0), len(columns) + 1), np.int32)
    size, at_a, at_b, rows = np.zeros(len(a0), np.int64), a0.copy(), b0.copy(), np.arange(len(a0))
    for i in range(int(la.max())):
        own = np.where(i < la, a[np.minimum(a0 + i, len(a) - 1)], np.uint32(AFTER_A))
        runs[:, 1:] = (runs[:, :-1] + 1) * (other == own[:, None])
        end = runs.argmax(axis=1)
        run = runs[rows, end]
        more = run > size
        size[more], at_a[more], at_b[more] = run[more], (a0 + i + 1 - run)[more], (b0 + end - run)[more]
    return at_a, at_b, size


def matches(one: list[str], other: list[str]) -> np.ndarray:
    """How many characters of each pair of texts are in matching blocks."""
    total = np.zeros(len(one), np.int64)
    a, a_at = _codes(one)
    b, b_at = _codes(other)
    begins, frequent = b.copy(), np.zeros(len(other), bool)
    for i, text in enumerate(other):
        if len(text) >= LONG:
            often = [ord(c) for c, n in Counter(text).items() if n > len(text) // FREQUENT + 1]
            stretch = begins[b_at[i] : b_at[i + 1]]
            stretch[np.isin(stretch, often)] = AFTER_B
            frequent[i] = bool(often)
    pair, a0, a1, b0, b1 = np.arange(len(one)), a_at[:-1], a_at[1:], b_at[:-1], b_at[1:]
    while True:
        some = (a0 < a1) & (b0 < b1)
        pair, a0, a1, b0, b1 = (x[some] for x in (pair, a0, a1, b0, b1))
        if not len(pair):
            return total
        order = np.lexsort((b1 - b0, a1 - a0))
        pair, a0, a1, b0, b1 = (x[order] for x in (pair, a0, a1, b0, b1))
        found, at = [], 0
        widest = np.maximum.accumulate((b1 - b0)[::-1])[::-1]
        while at < len(pair):
            end = min(len(pair), at + max(1, CELLS // int(widest[at])))
            part = slice(at, end)
            found.append(_longest(a, begins, a0[part], (a1 - a0)[part], b0[part], (b1 - b0)[part]))
            at = end
        at_a, at_b, size = (np.concatenate(x) for x in zip(*found, strict=True))
        for k in np.flatnonzero(frequent[pair]).tolist():  # blocks extend over frequent characters
            i, j, n = int(at_a[k]), int(at_b[k]), int(size[k])
            while i > a0[k] and j > b0[k] and a[i - 1] == b[j - 1]:
                i, j, n = i - 1, j - 1, n + 1
            while i + n < a1[k] and j + n < b1[k] and a[i + n] == b[j + n]:
                n += 1
            at_a[k], at_b[k], size[k] = i, j, n
        some = size > 0
        pair, a0, a1, b0, b1, at_a, at_b, size = (x[some] for x in (pair, a0, a1, b0, b1, at_a, at_b, size))
        np.add.at(total, pair, size)
        pair = np.concatenate([pair, pair])
        a0, a1, b0, b1 = np.concatenate([a0, at_a + size]), np.concatenate([at_a, a1]), np.concatenate([b0, at_b + size]), np.concatenate([at_b, b1])


def ratios(one: list[str], other: list[str]) -> np.ndarray:
    """Twice the characters in matching blocks over all characters, for each pair; two empty texts are alike. The order of a pair matters."""
    size = np.array([len(x) + len(y) for x, y in zip(one, other, strict=True)], np.int64)
    return np.where(size > 0, 2.0 * matches(one, other) / np.maximum(size, 1), 1.0)
