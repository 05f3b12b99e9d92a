"""Quality rules by line labelling (operator 1).

Every line with a word is labelled content or boilerplate by Viterbi decoding of a linear-chain conditional random
field; a document is kept if the share of its characters in content lines is large enough, and if base counts pass.

The field is trained on a bounded sample of labelled documents (TRAIN_DOCS documents of TRAIN_LINES lines at most, in
order of a hash; longer ones give runs of lines at even distances). Only documents have labels, so runs of lines of a good
and of a bad document are spliced into one sequence: its labels change inside, where the field learns transitions. Without
rows of both labels PRIOR is used.

Edge cases: null, empty and blank texts have no lines and no words; they fail the base rule. Labellings of equal score: a
content line rather before than after. A share of exactly LEAST_CONTENT is enough. Repeated rows give repeated rows; an
empty table gives an empty table. A text of any length is read in bounded parts, of which numbers for each line and each
word are kept. Columns asked for by ``keep`` are returned; their names must differ from those of the results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitforge.llm.sampling import hashed_sample
from hitforge.llm.shingles import cut, mix, word_hashes
from hitforge.llm.text_batches import PIECE_BYTES, SMALL_PIECE, Texts, bound_batches, is_separator, pieces, word_bounds

TRAIN_DOCS, TRAIN_LINES = 2000, 512
#: Lines of one run; a training sequence is two runs.
CHUNK = 32
#: Lines of more bytes are told apart by a digest of 128 bits.
LINE_KEPT = 64
SYMBOLS = b"#*$%&|<>"
FEATURES = ("bias", "length", "symbols", "capitals", "exclamations", "repeats", "duplicate", "digits", "short", "closed", "word_length", "punctuation")
#: Least share of content characters.
LEAST_CONTENT = 0.5


@dataclass(frozen=True)
class LineField:
    """Weights of features for label content against boilerplate, and of the four transitions [from, to]."""

    weights: np.ndarray
    moves: np.ndarray

    def content(self, features: np.ndarray) -> list[bool]:
        """Viterbi labels of one document's lines."""
        if not len(features):
            return []
        (bb, bc), (cb, cc) = self.moves.tolist()
        b, c, back = 0.0, 0.0, []
        for i, score in enumerate((features @ self.weights).tolist()):
            if i:
                from_b, from_c = b + bb >= c + cb, b + bc > c + cc
                b, c = (b + bb if from_b else c + cb), (b + bc if from_c else c + cc)
                back.append((from_b, from_c))
            c += score
        label, labels = c >= b, []
        for from_b, from_c in reversed(back):
            labels.append(label)
            label = not (from_c if label else from_b)
        return [*labels, label][::-1]


#: Used where there is nothing to learn from: symbols, capitals, exclamations and repeats speak against a line.
PRIOR = LineField(np.array([2.0, 0.5, -6.0, -3.0, -3.0, -3.0, -1.0, -1.0, -0.3, 0.5, 0.0, -0.5]), np.array([[0.5, -0.5], [-0.5, 0.5]]))


@dataclass
class Measured:
    """Counts of one document, and of its lines with a word."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    line_chars: np.ndarray
    features: np.ndarray


@dataclass
class Lines:
    """Numbers of all lines of a piece: counts [line, COUNTS], words, the last word's last byte, a key for equal lines; and words."""

    counts: np.ndarray
    words: np.ndarray
    last: np.ndarray
    keys: list[bytes]
    hashes: np.ndarray
    line_of: np.ndarray


#: What is counted in a line: characters, blanks, symbols, capitals, small letters, digits, exclamation marks, printable ASCII.
COUNTS = 8


def _key(line: bytes) -> bytes:
    return line if len(line) <= LINE_KEPT else hashlib.blake2b(line, digest_size=16).digest() + b"\n"


def read_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[Lines, np.ndarray, np.ndarray]:
    """The lines of texts that lie behind each other, and each text's first line and first word."""
    starts, ends, first = word_bounds(data, offsets)
    cuts = np.union1d(np.flatnonzero(data == 10) + 1, offsets)  # lines end at \n and at the end of each text
    begin, end = cuts[:-1], cuts[1:]
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    masks = ((data & 0xC0) != 0x80, is_separator(data), symbol[data], (data >= 65) & (data <= 90), (data >= 97) & (data <= 122), (data >= 48) & (data <= 57), data == 33, (data >= 33) & (data <= 126))
    counts = np.zeros((len(begin), COUNTS), np.int64)
    if len(begin):
        for i, mask in enumerate(masks):
            counts[:, i] = np.add.reduceat(mask, begin, dtype=np.int64)
        newline = data[end - 1] == 10
        counts[:, :2] -= newline[:, None]
    else:
        newline = np.zeros(0, bool)
    line_of = np.searchsorted(begin, starts, side="right") - 1
    words, last = np.bincount(line_of, minlength=len(begin)), np.zeros(len(begin), np.uint8)
    last[line_of] = data[ends - 1]
    raw = data.tobytes()
    keys = [_key(raw[a:b]) for a, b in zip(begin.tolist(), (end - newline).tolist(), strict=True)]
    return Lines(counts, words, last, keys, word_hashes(data, starts, ends, fold=False), line_of), np.searchsorted(begin, offsets), first


def _long_parts(data: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, bool]]:
    """Parts of one long text and whether the last line goes on in the next: behind a \n, or inside a line between words."""
    at = 0
    while at < len(data):
        end = min(len(data), at + size)
        ends = np.flatnonzero(data[at:end] == 10)
        if end < len(data) and len(ends):
            end = at + int(ends[-1]) + 1
        elif end < len(data):
            end = at + len(next(cut(data[at:], size)))
        yield data[at:end], bool(end < len(data) and data[end - 1] != 10)
        at = end


def read_long(data: np.ndarray, size: int = SMALL_PIECE) -> Lines:
    """The lines of one long text, read in parts."""
    made, lines, goes_on, digest, length = [], 0, False, None, 0
    for part, open_ in _long_parts(data, size):
        own, _, _ = read_lines(part, np.array([0, len(part)], np.int64))
        if goes_on or (open_ and len(own.keys)):
            raw = part.tobytes().split(b"\n")
            pieces_of_line = [raw[0]] * goes_on + [raw[-1]] * (open_ and (len(raw) > 1 or not goes_on))
            for i, piece in enumerate(pieces_of_line):
                if i or not goes_on:
                    digest, length = hashlib.blake2b(digest_size=16), 0
                    kept = b""
                digest.update(piece)
                kept, length = (kept + piece)[: LINE_KEPT + 1], length + len(piece)
                own.keys[0 if goes_on and not i else -1] = kept if length <= LINE_KEPT else digest.digest() + b"\n"
        if goes_on:  # the first line is the rest of the last one
            before = made[-1]
            before.counts[-1] += own.counts[0]
            before.words[-1] += own.words[0]
            before.last[-1] = own.last[0] if own.words[0] else before.last[-1]
            before.keys[-1] = own.keys[0]
            own.line_of += lines - 1
            own.counts, own.words, own.last, own.keys = own.counts[1:], own.words[1:], own.last[1:], own.keys[1:]
            if not len(own.keys):  # nothing but the rest of that line
                before.hashes, before.line_of = np.append(before.hashes, own.hashes), np.append(before.line_of, own.line_of)
                goes_on = open_
                continue
        else:
            own.line_of += lines
        lines += len(own.keys)
        made.append(own)
        goes_on = open_
    join = lambda name: np.concatenate([getattr(m, name) for m in made])
    return Lines(join("counts"), join("words"), join("last"), [k for m in made for k in m.keys], join("hashes"), join("line_of"))


def measure(texts: Texts, size: int = PIECE_BYTES) -> Iterator[Measured]:
    """Base counts and line features of each text of a piece; a text of more than ``size`` bytes is read in parts."""
    if len(texts) == 1 and len(texts.data) > size:
        lines = read_long(texts.data, min(size, SMALL_PIECE))
        line_first, first = np.array([0, len(lines.keys)]), np.array([0, len(lines.hashes)])
    else:
        lines, line_first, first = read_lines(texts.data, texts.offsets)
    hashes, m = lines.hashes, len(lines.hashes)
    three = np.zeros(m, np.uint64)
    if m > 2:
        three[: m - 2] = mix(hashes[:-2] * np.uint64(3) + mix(hashes[1:-1] * np.uint64(5) + mix(hashes[2:])))
    line_of = mix(lines.line_of.astype(np.uint64))
    repeated, within = np.zeros(m, bool), np.zeros(m, bool)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a > 3:
            own = three[a : b - 2]
            order = np.sort(own)
            twice = order[1:][order[1:] == order[:-1]]
            if len(twice):
                at = np.flatnonzero(np.isin(own, twice)) + a
                again = three[at] ^ line_of[at]  # the same window in the same line
                order = np.sort(again)
                inner = at[np.isin(again, order[1:][order[1:] == order[:-1]])]
                for k in range(3):
                    repeated[at + k] = True
                    within[inner + k] = True
    repeats = np.zeros(m + 1, np.int64)
    np.cumsum(repeated, out=repeats[1:])
    inner_repeats = np.zeros(m + 1, np.int64)
    np.cumsum(within, out=inner_repeats[1:])

    duplicate = np.zeros(len(lines.keys), bool)
    for a, b in zip(line_first[:-1].tolist(), line_first[1:].tolist(), strict=True):
        if b - a > 1:
            seen: set[bytes] = set()
            for i in range(a, b):
                line = lines.keys[i]
                duplicate[i] = line in seen
                seen.add(line)
    full = np.flatnonzero(lines.words)
    line_first = np.searchsorted(full, line_first)
    duplicate, words, last = duplicate[full], lines.words[full], lines.last[full]
    word_b = np.cumsum(lines.words)[full]
    word_a = word_b - words
    counts = lines.counts[full]
    chars, blank, symbols, big, small, digits, shouts, marks = counts.T
    letters, ink = np.maximum(1, big + small), np.maximum(1, chars - blank)
    features = np.stack(
        [
            np.ones(len(words)),
            np.log1p(words) / 5,
            np.minimum(1, 5 * symbols / ink),
            big / letters,
            np.minimum(1, shouts / words),
            (inner_repeats[word_b] - inner_repeats[word_a]) / words,
            duplicate,
            digits / ink,
            words < 3,
            np.isin(last, list(b".!?:\"")),
            np.minimum(2, ink / words / 8),
            (marks - big - small - digits) / ink,
        ],
        axis=1,
    )
    for u, v, p, q in zip(line_first[:-1], line_first[1:], first[:-1], first[1:], strict=True):
        yield Measured(int(q - p), int((chars - blank)[u:v].sum()), int(symbols[u:v].sum()), int(duplicate[u:v].sum()), int(repeats[q] - repeats[p]), chars[u:v], features[u:v])


def _log_add(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return (most + np.log(np.exp(x - most).sum(axis=axis, keepdims=True))).squeeze(axis)


def spliced(documents: list[tuple[int, np.ndarray]], seed: int = 1) -> list[tuple[np.ndarray, np.ndarray]]:
    """(labels, features) of sequences of a run of lines from a good and one from a bad document, in either order.

    Each run of the label that has more of them is used once, runs of the other label go round.
    """
    runs = {y: [x[i : i + CHUNK] for label, x in documents if label == y for i in range(0, len(x), CHUNK)] for y in (0, 1)}
    if not (runs[0] and runs[1]):
        return []
    dice, n = np.random.default_rng(seed), max(len(runs[0]), len(runs[1]))
    for own in runs.values():
        dice.shuffle(own)
    out = []
    for i, first in enumerate(dice.integers(0, 2, n).tolist()):
        one, two = runs[first][i % len(runs[first])], runs[1 - first][i % len(runs[1 - first])]
        out.append((np.repeat([first, 1 - first], [len(one), len(two)]), np.concatenate([one, two])))
    return out


def fit_field(documents: list[tuple[int, np.ndarray]], rounds: int = 120, rate: float = 0.1, decay: float = 1e-3) -> LineField:
    """Maximum likelihood of label sequences by forward-backward, all sequences of a round at once, with Adam steps."""
    runs = spliced(documents)
    if not runs:
        return PRIOR
    n, longest = len(runs), max(len(x) for _, x in runs)
    x, there, y = np.zeros((n, longest, len(FEATURES)), np.float32), np.zeros((n, longest), bool), np.zeros((n, longest))
    for i, (label, own) in enumerate(runs):
        x[i, : len(own)], there[i, : len(own)], y[i, : len(own)] = own, True, label
    # a line of either label counts alike, however many there are
    per = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (there - y).sum())) * there
    each = per.sum(axis=1) / np.maximum(1, there.sum(axis=1))
    pairs = there[:, 1:]
    gold = np.array([[(each[:, None] * pairs * (y[:, :-1] == a) * (y[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)])
    w, moves = np.zeros(len(FEATURES)), np.zeros((2, 2))
    first, second = np.zeros(w.size + 4), np.zeros(w.size + 4)
    for step in range(1, rounds + 1):
        score = np.zeros((n, longest, 2))
        score[:, :, 1] = x @ w.astype(np.float32)
        ahead, behind = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        ahead[:, 0] = score[:, 0]
        for t in range(1, longest):
            ahead[:, t] = _log_add(ahead[:, t - 1, :, None] + moves, 1) + score[:, t]
        for t in range(longest - 2, -1, -1):
            after = _log_add(moves + (score[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(there[:, t + 1, None], after, 0)
        total = _log_add(ahead + behind, 2)[:, :1]
        ahead, behind = ahead - total[:, :, None], behind
        marginal = np.exp(ahead + behind)[:, :, 1] * there
        node = np.einsum("ij,ijk->k", (y - marginal) * each[:, None], x)
        pair = np.exp(ahead[:, :-1, :, None] + moves + (score + behind)[:, 1:, None, :]) * there[:, 1:, None, None]
        edge = gold - (pair * each[:, None, None, None]).sum((0, 1))
        slope = np.concatenate([node, edge.ravel()]) - decay * np.concatenate([w, moves.ravel()])
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, moves = w + move[: w.size], np.clip(moves + move[w.size :].reshape(2, 2), -1.5, 1.5)
    return LineField(w, moves)


def _some_runs(features: np.ndarray, most: int) -> np.ndarray:
    """All lines, or of very many ``most`` in runs at even distances."""
    if len(features) <= most:
        return features
    starts = np.linspace(0, len(features) - CHUNK, max(1, most // CHUNK)).astype(np.int64)
    return np.concatenate([features[a : a + CHUNK] for a in starts])


def train(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "quality", most_docs: int = TRAIN_DOCS, most_lines: int = TRAIN_LINES) -> LineField:
    """Fits the field on at most ``most_docs`` labelled documents, ``most_lines`` lines of each."""
    bound_batches(docs.sparkSession)
    sample = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(label).cast("int").alias("y"))
    sample = hashed_sample(sample, "i", most_docs)
    source = docs.select(F.col(id_col).alias("i"), F.col(text).cast("string").alias("text")).join(F.broadcast(sample), "i").select("i", "y", "text")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(parts, "text", SMALL_PIECE):
            made = [_some_runs(m.features, most_lines).astype(np.float32).tobytes() for m in measure(texts)]
            out = pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(made, pa.binary())], names=["i", "y", "x"])
            yield out.filter(pa.array([bool(x) for x in made], pa.bool_()))

    kind = source.schema["i"].dataType.simpleString()
    rows = source.mapInArrow(batches, f"i {kind}, y int, x binary").orderBy("i", "y").limit(most_docs).collect()
    return fit_field([(1 if y else 0, np.frombuffer(x, np.float32).reshape(-1, len(FEATURES))) for _, y, x in rows])


def judge(docs: DataFrame, field: LineField, text: str = "text", id_col: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (id_col unless given), the base counts, base_failed, kept, and content_share."""
    bound_batches(docs.sparkSession)
    keep = keep or [id_col]
    kept_columns = len(keep)
    inner = max(keep, key=len) + "_text"  # clashes with no column
    source = docs.select(*keep, F.col(text).cast("string").alias(inner))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(parts, inner, SMALL_PIECE):
            numbers, failed, verdict, shares = [], [], [], []
            for m in measure(texts):
                numbers.append((m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words))
                failed.append(m.n_words < 50 or 100 * m.n_repeat_words > 50 * m.n_words)
                total = int(m.line_chars.sum())
                content = int(m.line_chars[np.array(field.content(m.features), bool)].sum()) if total else 0
                shares.append(content / total if total else 0.0)
                verdict.append(not failed[-1] and shares[-1] >= LEAST_CONTENT)
            columns = [part.column(i) for i in range(kept_columns)]
            columns += [pa.array(c, pa.int64()) for c in np.array(numbers, np.int64).reshape(-1, 5).T]
            columns += [pa.array(failed, pa.bool_()), pa.array(verdict, pa.bool_()), pa.array(shares, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [*keep, *counts, "base_failed", "kept", "content_share"]
    shape = [f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep] + [f"{c} bigint" for c in counts]
    return source.mapInArrow(batches, ", ".join([*shape, "base_failed boolean", "kept boolean", "content_share double"]))
