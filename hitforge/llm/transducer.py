"""Deterministic transducers over classes of code points, run by an associative scan.

A table gives for each (class, state) the next state and an output. A stretch of input is a function from states to
states, and such functions compose associatively; so the input is cut into equal chunks, the function of every chunk is
made for all chunks at once, the functions are composed by a parallel prefix scan, and with the state known at the
start of each chunk all chunks are walked at once for the outputs.
"""

from __future__ import annotations

import functools
import unicodedata
from dataclasses import dataclass

import numpy as np

#: Classes of code points. END stands after each text.
LETTER, NUMBER, OTHER, APOSTROPHE, SPACE, WHITE, STMD, R_OR_V, L, E, END = range(11)
N_CLASSES = 11
#: What a transition says: a piece starts at this code point, or at the one before it.
STARTS_HERE, STARTS_BEFORE = 1, 2

# The code points with Unicode's White_Space property.
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def with_classes(changes: dict[int, int]) -> np.ndarray:
    """The table of classes with other classes for some code points, which a library of another Unicode version has."""
    table = class_table().copy()
    table[list(changes)] = list(changes.values())
    return table


@functools.cache
def class_table() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)], np.uint8)
    table[WHITE_SPACE] = WHITE
    table[32] = SPACE
    for chars, kind in (("'", APOSTROPHE), ("stmd", STMD), ("rv", R_OR_V), ("l", L), ("e", E)):
        for c in chars:
            table[ord(c)] = kind
    return table


@dataclass(frozen=True)
class Transducer:
    """next_state[class, state] and output[class, state]; state 0 holds at the start of a text."""

    next_state: np.ndarray
    output: np.ndarray

    def run(self, classes: np.ndarray, chunk: int = 512) -> np.ndarray:
        """The output of each transition for the whole input, from state 0."""
        n, width = len(classes), 16
        rows = max(1, -(-n // chunk))
        padded = np.full(rows * chunk, END, np.uint8)
        padded[:n] = classes
        by_step = np.ascontiguousarray(padded.reshape(rows, chunk).T).astype(np.uint16) * width
        states = self.next_state.shape[1]
        flat = np.zeros((N_CLASSES, width), np.uint8)
        flat[:, :states] = self.next_state
        flat = flat.ravel()
        maps = np.repeat(np.arange(states, dtype=np.uint16)[:, None], rows, axis=1)
        for step in by_step:
            maps = flat.take(maps + step).astype(np.uint16)
        state = self._starts(maps)
        said = np.zeros((N_CLASSES, width), np.uint8)
        said[:, :states] = self.output
        said, out = said.ravel(), np.empty((chunk, rows), np.uint8)
        for i, step in enumerate(by_step):
            at = step + state
            said.take(at, out=out[i])
            state = flat.take(at)
        return np.ascontiguousarray(out.T).ravel()[:n]

    @staticmethod
    def _starts(maps: np.ndarray) -> np.ndarray:
        """The state at the start of each chunk: an inclusive prefix scan of function composition by doubling."""
        done, reach, n = maps.copy(), 1, maps.shape[1]
        while reach < n:
            later = done[:, reach:]
            done = np.concatenate([done[:, :reach], np.take_along_axis(later, done[:, :-reach].astype(np.int64), axis=0)], axis=1)
            reach *= 2
        return np.concatenate([[0], done[0, :-1]]).astype(np.uint8)


#: States of the splitters.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE_SPACE, ONE_WHITE, MORE_SPACE, MORE_WHITE, QUOTE, QUOTE_RV, QUOTE_L, BLANK = range(12)
_LETTERS = (LETTER, STMD, R_OR_V, L, E)


def _compile(keeps_white: bool, joins_numbers: bool) -> Transducer:
    """Walks every (state, class) once; the two splitters differ in white space and in numbers only."""
    step, said = np.zeros((N_CLASSES, 12), np.uint8), np.zeros((N_CLASSES, 12), np.uint8)

    def begin(c: int) -> tuple[int, int]:
        """A piece begins with class c, where nothing is open."""
        if c in _LETTERS:
            return IN_LETTERS, STARTS_HERE
        if c == NUMBER:
            return IN_NUMBERS, STARTS_HERE
        if c == OTHER:
            return IN_OTHERS, STARTS_HERE
        if c == APOSTROPHE:
            return QUOTE, STARTS_HERE
        if not keeps_white:
            return BLANK, STARTS_HERE
        return (ONE_SPACE if c == SPACE else ONE_WHITE), STARTS_HERE

    def go_on(c: int) -> int:
        """Class c joins the space before it."""
        return IN_LETTERS if c in _LETTERS else IN_NUMBERS if c == NUMBER else IN_OTHERS

    def move(state: int, c: int) -> tuple[int, int]:
        if c == END:
            return FRESH, STARTS_BEFORE if state in (QUOTE_RV, QUOTE_L) else 0
        white = c in (SPACE, WHITE)
        if state == IN_LETTERS and c in _LETTERS:
            return IN_LETTERS, 0
        if state == IN_NUMBERS and c == NUMBER and joins_numbers:
            return IN_NUMBERS, 0
        if state in (IN_OTHERS, QUOTE) and c in (OTHER, APOSTROPHE):
            return IN_OTHERS, 0
        if state == QUOTE and c == STMD:
            return FRESH, 0
        if state == QUOTE and c == R_OR_V:
            return QUOTE_RV, 0
        if state == QUOTE and c == L:
            return QUOTE_L, 0
        if state == QUOTE_RV and c == E or state == QUOTE_L and c == L:
            return FRESH, 0
        if state in (QUOTE_RV, QUOTE_L):  # no contraction: the quote stands alone and the letter begins a run
            after, told = move(IN_LETTERS, c)
            return after, told | STARTS_BEFORE
        if state == BLANK and white:
            return BLANK, 0
        if state in (ONE_SPACE, ONE_WHITE, MORE_SPACE, MORE_WHITE):
            if white:
                return (MORE_SPACE if c == SPACE else MORE_WHITE), 0
            split = STARTS_BEFORE if state in (MORE_SPACE, MORE_WHITE) else 0  # the last white space leaves its run
            if state in (ONE_SPACE, MORE_SPACE):
                return go_on(c), split
            after, told = begin(c)
            return after, told | split
        return begin(c)

    for state in range(12):
        for c in range(N_CLASSES):
            step[c, state], said[c, state] = move(state, c)
    return Transducer(step, said)


@functools.cache
def byte_level_splitter() -> Transducer:
    """Splits as the pattern public_tokenizers.PATTERN does: contractions, runs with a space before them, white space."""
    return _compile(keeps_white=True, joins_numbers=True)


@functools.cache
def word_splitter() -> Transducer:
    """Splits into contractions, letters, single numbers and runs of others; pieces of white space carry no tokens."""
    return _compile(keeps_white=False, joins_numbers=False)


def split(transducer: Transducer, data: np.ndarray, offsets: np.ndarray, table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds in bytes of the pieces of UTF-8 texts that lie behind each other, and each text's first piece.

    Returns positions (one more than pieces, in bytes), the number of pieces before each text (one more than texts),
    and the class of each piece's first code point.
    """
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    classes = (class_table() if table is None else table)[codes]
    ends = np.searchsorted(lead, offsets[1:])
    told = transducer.run(np.insert(classes, ends, END))
    at_end = ends + np.arange(len(ends))
    begins = (told & STARTS_HERE).astype(bool)
    begins[:-1] |= (told[1:] & STARTS_BEFORE).astype(bool)
    begins = np.delete(begins, at_end)
    which = np.flatnonzero(begins)
    starts = lead[which]
    return np.append(starts, len(data)), np.searchsorted(starts, offsets), classes[which]
