"""Word shingles of whole texts as 64-bit numbers, by numpy passes over bounded pieces of UTF-8 bytes."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np

from hitforge.llm.text_batches import PIECE_BYTES, Texts, word_bounds

#: Odd multipliers modulo 2**64 of words in a shingle, and of the last mixing.
WORD_BASE = 0xC2B2AE3D27D4EB4F
MIX_A, MIX_B = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
#: The prime of the words' polynomials, the two places at which each is evaluated, and the bytes worked on at once.
PRIME, PLACES, RUN = (1 << 31) - 1, (1_234_567_891, 987_654_323), 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_A)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_B)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _values(fold: bool) -> np.ndarray:
    """Each byte's value below PRIME, lower-cased for A-Z only if ``fold``; none is 0, so that lengths count."""
    table = np.arange(256, dtype=np.uint64)
    table[65:91] += np.uint64(32 * fold)
    return mix(table + np.uint64(1)) % np.uint64(PRIME - 1) + np.uint64(1)


@functools.cache
def _powers(place: int) -> tuple[np.ndarray, np.ndarray]:
    """place**i and place**-i modulo PRIME for i < RUN."""
    out = []
    for base in (place, pow(place, -1, PRIME)):
        powers = np.ones(RUN, np.uint64)
        done = 1
        while done < RUN:  # doubled: the second half is the first times base**done
            powers[done : 2 * done] = powers[:done] * np.uint64(pow(base, done, PRIME)) % np.uint64(PRIME)
            done *= 2
        out.append(powers)
    return out[0], out[1]


def _sums(data: np.ndarray, place: int, values: np.ndarray) -> np.ndarray:
    """Running sums of values times powers, each folded below 2**32 (2**31 is 1 modulo PRIME); RUN bytes at most."""
    terms = values[data] * _powers(place)[0][: len(data)]
    terms = (terms & np.uint64(PRIME)) + (terms >> np.uint64(31))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    return sums


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """A number for each word: the polynomial of its bytes at two places of a prime field, from running sums.

    Words are taken RUN bytes at a time; a longer word is summed up in parts.
    """
    found = np.zeros((2, len(starts)), np.uint64)
    values, prime, i = _values(fold), np.uint64(PRIME), 0
    while i < len(starts):
        begin = int(starts[i])
        j = int(np.searchsorted(ends, begin + RUN, side="right"))
        for k, place in enumerate(PLACES):
            if j > i:
                sums, down = _sums(data[begin : int(ends[j - 1])], place, values), _powers(place)[1]
                a, b = starts[i:j] - begin, ends[i:j] - begin
                found[k, i:j] = (sums[b] - sums[a]) % prime * down[a] % prime
            else:
                total = 0
                for at in range(begin, int(ends[i]), RUN):
                    total += int(_sums(data[at : min(at + RUN, int(ends[i]))], place, values)[-1]) * pow(place, at - begin, PRIME)
                found[k, i] = total % PRIME
        i = max(j, i + 1)
    return mix(found[0] | found[1] << np.uint64(31))


def cut(data: np.ndarray, size: int | None = None) -> Iterator[np.ndarray]:
    """Pieces of one long text, cut behind separators where there is one near."""
    at, size = 0, size or PIECE_BYTES
    while at < len(data):
        end = min(len(data), at + size)
        if end < len(data):
            near = np.flatnonzero((data[at:end] == 32) | ((data[at:end] >= 9) & (data[at:end] <= 13)))
            if len(near):
                end = at + int(near[-1]) + 1
            else:  # one word beyond all bounds
                rest = data[end:]
                stop = np.flatnonzero((rest == 32) | ((rest >= 9) & (rest <= 13)))
                end = end + int(stop[0]) + 1 if len(stop) else len(data)
        yield data[at:end]
        at = end


def bounded(texts: Texts) -> list[Texts]:
    """The texts as they are, or one long text in parts of whole words."""
    if len(texts) == 1 and len(texts.data) > PIECE_BYTES:
        return [Texts.of(piece, np.array([0, len(piece)], np.int64)) for piece in cut(texts.data)]
    return [texts]


def words_of(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, and how many words lie before each text (one more entry than texts)."""
    made = []
    for part in bounded(texts):
        starts, ends, before = word_bounds(part.data, part.offsets)
        made.append(word_hashes(part.data, starts, ends))
    return (made[0], before) if len(made) == 1 else ((hashes := np.concatenate(made)), np.array([0, len(hashes)], np.int64))


def shingle_sets(texts: Texts, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct k-word shingles of each text; fewer words make one shingle, none make none."""
    words, before = words_of(texts)
    n = len(words)
    rolled = np.zeros(n, np.uint64)
    for i in range(k):
        power = np.uint64(pow(WORD_BASE, i + 1, 1 << 64))
        rolled[: n - i] += words[i:] * power if i < n else np.uint64(0)
    rolled = mix(rolled)
    for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        if b - a >= k:
            own = np.sort(rolled[a : b - k + 1])
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            yield own[keep]
        elif b > a:
            short = np.uint64(b - a)
            for i, word in enumerate(words[a:b].tolist()):
                short = np.uint64((int(short) + word * pow(WORD_BASE, i + 1, 1 << 64)) % (1 << 64))
            yield mix(np.array([short], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
