"""Token counts by a compiled finite-state tokenizer (operator 8).

Two deterministic transducers are composed. The first runs over classes of code points and marks where words begin; its
chunks are functions from states to states, composed by a parallel prefix scan. The second runs over bytes: it is
compiled from the vocabulary and has a state for each beginning of a word. Each transition emits a count: by how many the
tokens of the longer beginning differ from those of the shorter one, less than none where a byte lets tokens merge. The
transition at the end of a word emits what its last merges add or take. Every word's end leads back to its first state
whatever went before. So the map of a word is constant, with the sum of what its transitions emit, and such maps with
their counts compose by a prefix scan of sums; all words of a piece run side by side, a byte at a time.

A word that leads out of the automaton is merged pair by pair; when it comes again, its path is compiled in, as lazy automata do. The
automaton has MOST_STATES at most: beyond that it starts again from the vocabulary. Counts don't depend on it.

Edge cases: null and empty texts count 0 tokens and 0 bytes. Special strings inside a text count as one token each and
part the text, which is how the tokenizer handles them unless told otherwise. Code points that the tokenizer
classes or lower-cases by a later Unicode version than this Python's are in a table of fixed values. A text of any length is read in bounded pieces; a very long word is merged in n log n. Repeated rows give
repeated rows; an empty table gives an empty table. Other columns, whatever their names, are not carried along.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitforge.llm.pair_merge import NEVER, merge
from hitforge.llm.text_batches import SMALL_PIECE, bound_batches, parts, pieces
from hitforge.llm.transducer import LETTER, NUMBER, OTHER, SPACE, WHITE, class_table, split, with_classes, word_splitter

#: States of the automaton, slots of its table of transitions, and the longest word that is compiled in, in bytes.
MOST_STATES, SLOTS, LONGEST = 1 << 20, 1 << 22, 64
START, NOWHERE = 1, 0
#: No word of the automaton ends in a state.
NO_END = -(1 << 15)
#: Words whose counts are kept in mind until they come again.
MOST_ONCE = 300_000


def byte_names() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names, extra = {b: chr(b) for b in shown}, 0
    for b in range(256):
        if b not in names:
            names[b] = chr(256 + extra)
            extra += 1
    return [names[b] for b in range(256)]


def _slot(keys: np.ndarray) -> np.ndarray:
    return (keys * np.int64(0x5851F42D4C957F2D) >> np.int64(20)) & np.int64(SLOTS - 1)


class WordAutomaton:
    """States and transitions (state, byte) in an open table of numbers, and what transitions emit.

    One transition leads into each state, so that what it emits is held with the state: ``emits`` for it, ``ends`` for the end
    of a word there (NO_END where none was compiled). ``tokens`` counts those of a beginning of a word.
    """

    def __init__(self, tokens: Callable[[bytes], int]):
        self.keys, self.next = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, np.int32)
        self.emits, self.upto, self.ends = np.zeros(MOST_STATES + 1, np.int16), np.zeros(MOST_STATES + 1, np.int16), np.full(MOST_STATES + 1, NO_END, np.int16)
        self.states, self.tokens = 2, tokens

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The next state of each, NOWHERE where there is no transition."""
        wanted = states.astype(np.int64) << 8 | symbols
        at = _slot(wanted)
        there = self.keys[at]
        out = np.where(there == wanted, self.next[at], NOWHERE)
        open_ = np.flatnonzero((there != wanted) & (there >= 0))
        while len(open_):  # slots that another transition has
            at[open_] = (at[open_] + 1) & (SLOTS - 1)
            there = self.keys[at[open_]]
            hit = there == wanted[open_]
            out[open_[hit]] = self.next[at[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return out

    def add(self, words: list[bytes], counts: list[int]) -> int:
        """Compiles words with their counts, all first bytes together, then all second ones; returns how many fit in."""
        room, fit = MOST_STATES - self.states, 0
        for word in words:
            room -= len(word)
            if room < 0:
                break
            fit += 1
        words = words[:fit]
        sizes = np.array([len(w) for w in words], np.int64)
        data, starts = np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes
        states, order = np.full(fit, START, np.int64), np.argsort(-sizes, kind="stable")
        for i in range(int(sizes.max(initial=0))):
            active = order[: int(np.searchsorted(-sizes[order], -i, side="left"))]
            symbols = data[starts[active] + i].astype(np.int64)
            found = self.step(states[active], symbols).astype(np.int64)
            without = np.flatnonzero(found == NOWHERE)
            new, one, which = np.unique(states[active][without] << 8 | symbols[without], return_index=True, return_inverse=True)
            numbers = self.states + np.arange(len(new))
            self._insert(new, numbers)
            self.upto[numbers] = [self.tokens(words[w][: i + 1]) for w in active[without[one]].tolist()]
            self.emits[numbers] = self.upto[numbers] - self.upto[new >> 8]
            self.states += len(new)
            found[found == NOWHERE] = numbers[which]
            states[active] = found
        self.ends[states] = np.array(counts[:fit], np.int16) - self.upto[states]
        return fit

    def _insert(self, keys: np.ndarray, values: np.ndarray) -> None:
        at, left = _slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] < 0]
            slots, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[slots], self.next[slots] = keys[put], values[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            taken = left[self.keys[at[left]] >= 0]
            at[taken] = (at[taken] + 1) & (SLOTS - 1)

    def emitted(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The sum of what each word's transitions emit, its end's included; -1 where a word leads out of the automaton or ends in no end of it."""
        order = np.argsort(-sizes, kind="stable")
        by_size, states = -sizes[order], np.full(len(sizes), START, np.int32)
        begins, sums = starts[order], np.zeros(len(sizes), np.int32)
        for i in range(int(sizes.max(initial=0))):
            n = int(np.searchsorted(by_size, -i, side="left"))
            states[:n] = self.step(states[:n], data[begins[:n] + i])
            sums[:n] += self.emits[states[:n]]
        out, ends = np.empty(len(sizes), np.int32), self.ends[states]
        out[order] = np.where((states == NOWHERE) | (ends == NO_END), -1, sums + ends)
        return out


class Tokenizer:
    """A vocabulary, compiled."""

    def __init__(self, path: str, classes: dict[int, int] | None = None, lower: dict[int, str] | None = None):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.order = {tuple(pair): i for i, pair in enumerate(spec["model"]["merges"])}
        self.suffix = spec["model"]["end_of_word_suffix"] or ""
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.special_at = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))))
        self.names, self.lower = byte_names(), lower or {}
        self.table = with_classes(classes) if classes else class_table()
        byte_of = {name: b for b, name in enumerate(self.names)}
        whole = [t[: -len(self.suffix)] for t in spec["model"]["vocab"] if self.suffix and t.endswith(self.suffix) and len(t) > len(self.suffix)]
        self.whole = [bytes(byte_of[c] for c in t) for t in whole if all(c in byte_of for c in t)]
        self.begin()

    def begin(self) -> None:
        """The automaton of the vocabulary's own words."""
        self.automaton, self.once = WordAutomaton(self.begun), {}
        # a token may not be what merging its bytes leaves, so that its count is worked out like any other word's
        self.automaton.add(self.whole, [self.merged(w) for w in self.whole])

    def merged(self, word: bytes) -> int:
        """Tokens that one word emits, by merging pairs."""
        made = [self.names[b] for b in word]
        made[-1] += self.suffix
        get = self.order.get
        return len(merge(made, lambda a, b: get((a, b), NEVER)))

    def begun(self, part: bytes) -> int:
        """Tokens of the beginning of a word."""
        get = self.order.get
        return len(merge([self.names[b] for b in part], lambda a, b: get((a, b), NEVER)))

    def normalize(self, text: str) -> str:
        """NFC, then lower case of each character by itself (so a capital sigma never becomes a final one)."""
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        if self.lower and any(chr(c) in text for c in self.lower):
            return "".join(self.lower.get(ord(c)) or c.replace("Σ", "σ").lower() for c in text)
        return text.replace("Σ", "σ").lower()

    def word_counts(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tokens of each word."""
        out = np.full(len(starts), -1, np.int64)
        short = np.flatnonzero(sizes <= LONGEST)
        out[short] = self.automaton.emitted(data, starts[short], sizes[short])
        left = np.flatnonzero(out < 0)
        if len(left):
            raw = [data[a : a + n].tobytes() for a, n in zip(starts[left].tolist(), sizes[left].tolist(), strict=True)]
            times = Counter(raw)
            again = {w for w in times if w in self.once}
            counts = {w: self.once.pop(w, None) or self.merged(w) for w in times}
            # a word is compiled when it comes again, as many never do
            new = sorted(w for w, n in times.items() if len(w) <= LONGEST and (n > 1 or w in again))
            if len(self.once) > MOST_ONCE:
                self.once.clear()
            self.once.update((w, counts[w]) for w, n in times.items() if n == 1 and len(w) <= LONGEST and w not in again)
            if self.automaton.add(new, [counts[w] for w in new]) < len(new):
                self.begin()
            out[left] = [counts[w] for w in raw]
        return out

    def counts(self, texts: list[str]) -> np.ndarray:
        """Token counts of whole texts."""
        total, made, owner = np.zeros(len(texts), np.int64), [], []
        for i, text in enumerate(texts):
            cut = self.special_at.split(text) if self.special and any(s in text for s in self.special) else [text]
            total[i] += len(cut) - 1
            made += [self.normalize(p).encode() for p in cut]
            owner += [i] * len(cut)
        data = np.frombuffer(b"".join(made), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in made])]).astype(np.int64)
        bounds, first, kinds = split(word_splitter(), data, offsets, self.table)
        words = np.flatnonzero((kinds != SPACE) & (kinds != WHITE))
        emitted = np.zeros(len(kinds) + 1, np.int64)
        emitted[words + 1] = self.word_counts(data, bounds[words], np.diff(bounds)[words])
        # the prefix scan of the words' maps: all are constant, so that their counts add up
        upto = np.cumsum(emitted)
        np.add.at(total, np.array(owner, np.int64), upto[first[1:]] - upto[first[:-1]])
        return total


# Code points that are letters, numbers or capitals since later versions of Unicode than some Pythons know.
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B),
    (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
#: First and last capital, and how far behind it its small letter is.
NEW_CAPITALS = [
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC),
    (0x10D50, 0x10D65, 32), (0x16EA0, 0x16EB8, 27),
]


@functools.cache
def differences(path: str = "") -> tuple[dict[int, int], dict[int, str]]:
    """Classes and small letters of code points that the tokenizer knows by its version of Unicode, whatever this Python's is."""
    classes = {c: kind for kind, spans in ((LETTER, NEW_LETTERS), (NUMBER, NEW_NUMBERS)) for a, b in spans for c in range(a, b + 1)}
    return classes, {c: chr(c + by) for a, b, by in NEW_CAPITALS for c in range(a, b + 1)}


@functools.cache
def tokenizer(path: str) -> Tokenizer:
    """One compiled tokenizer for each worker and vocabulary."""
    return Tokenizer(path, *differences())


def token_counts(df: DataFrame, path: str, text: str = "text", id_col: str = "doc_id", limit: int = 2048) -> DataFrame:
    """id_col, n_bytes, n_tokens, over_limit of each whole text."""
    bound_batches(df.sparkSession)

    def batches(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = tokenizer(path)
        for part, texts in pieces(of, "_text", SMALL_PIECE):
            sizes = np.diff(texts.offsets)
            if len(texts) == 1:
                n = np.array([sum(int(compiled.counts([texts.data[a:b].tobytes().decode()])[0]) for a, b in parts(texts.data, SMALL_PIECE))], np.int64)
            else:
                n = compiled.counts([t or "" for t in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes), pa.array(n), pa.array(n > limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    source = df.select(F.col(id_col), F.col(text).cast("string").alias("_text"))
    return source.mapInArrow(batches, f"`{id_col}` {source.schema[id_col].dataType.simpleString()}, n_bytes bigint, n_tokens bigint, over_limit boolean")
