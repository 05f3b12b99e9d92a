"""Language identification of mixed texts (operator 2).

The script of a word's first letter narrows the candidate languages; hashed character n-grams give every word a score
for each of them; Viterbi over the words, with a penalty for switching, labels spans. A text's language is the one with
most characters in its spans.

The model is trained on at most TRAIN_DOCS documents of each language, in order of a hash, whole texts each: Spark sums
n-gram counts, and the driver gets BUCKETS counts for each language. A script is a candidate's if LEAST_SHARE of the
language's words begin in it.

Viterbi runs in chunks of words: what a chunk does to the scores of all languages is worked out for all chunks at once,
these maps are composed, and with the scores at the start of each chunk known all chunks are decoded side by side.

Edge cases: a text that is null or has no letter is ``und`` with score 0; so is every text if nothing could be learned.
Words without letters belong to the span around them. Words in a script that no language admits count for none: a text of
such words only gets the first language by name, with score 0. Of languages with equally many characters the first by name
is predicted. A text of any length is read in bounded parts, of which only numbers for each word are kept. Repeated rows
give repeated rows; an empty table an empty table. Other columns, whatever their names, are not carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitforge.llm.sampling import hashed_sample_by
from hitforge.llm.shingles import bounded, mix, word_hashes
from hitforge.llm.text_batches import Texts, bound_batches, pieces, word_bounds
from hitforge.llm.transducer import E, L, LETTER, R_OR_V, STMD, class_table
from hitforge.storage import written

TRAIN_DOCS = 1000
#: Ids of training documents that may be broadcast, after a count; more, of very many languages, go through a shuffle join.
BROADCAST_IDS = 1_000_000
BUCKETS, LENGTHS = 1 << 15, (1, 2, 3, 4)
LEAST_SHARE = 0.001
#: Words of a chunk, and the most languages for which maps of chunks are worked out; with more, a text is one chunk.
CHUNK, FEW = 512, 16
#: Log odds that a switch of language costs, and the most that one word can say against a language.
SWITCH, MOST = 6.0, 8.0

# First code points of ranges and the script from there on; 0 is none or any other.
SCRIPTS = ((0, 0), (0x41, 1), (0x250, 0), (0x370, 2), (0x400, 3), (0x530, 4), (0x590, 5), (0x600, 6), (0x700, 0), (0x900, 7), (0x980, 8), (0xE00, 9), (0xE80, 0), (0x1100, 10), (0x1200, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 11), (0x30A0, 11), (0x3100, 0), (0x3400, 12), (0xA000, 0), (0xAC00, 10), (0xD7B0, 0), (0xF900, 12), (0xFB00, 1), (0xFB07, 0), (0x20000, 12), (0x30000, 0))
N_SCRIPTS = 13


@dataclass
class Words:
    """The words of a piece of text and its distinct words: for each of those the script, and n-gram buckets in rows."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    which: np.ndarray
    lettered: np.ndarray
    scripts: np.ndarray
    grams: np.ndarray
    gram_of: np.ndarray


def read_words(texts: Texts) -> Words:
    """Finds words, folds A-Z, and hashes n-grams of bytes of each distinct word with a mark at both ends."""
    data = texts.data
    starts, ends, first = word_bounds(data, texts.offsets)
    hashes = word_hashes(data, starts, ends)
    distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    letters = lead[np.isin(class_table()[codes], (LETTER, STMD, R_OR_V, L, E))]
    a, b = starts[at], ends[at]
    place = np.searchsorted(letters, a)
    lettered = np.zeros(len(distinct), bool)
    has = place < len(letters)
    lettered[has] = letters[place[has]] < b[has]
    scripts = np.zeros(len(distinct), np.int64)
    code = codes[np.searchsorted(lead, letters[place[lettered]])]
    scripts[lettered] = np.array([s for _, s in SCRIPTS])[np.searchsorted([c for c, _ in SCRIPTS], code, side="right") - 1]

    sizes = b - a + 2
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(distinct)), sizes)
    inner = np.arange(len(owner)) - offsets[owner]
    edge = (inner == 0) | (inner == sizes[owner] - 1)
    values = np.ones(len(owner), np.uint64)
    raw = data[(a[owner] + inner - 1)[~edge]].astype(np.uint64)
    values[~edge] = raw + np.uint64(32) * ((raw >= 65) & (raw <= 90))
    grams, gram_of, rolled = [], [], np.zeros(len(owner), np.uint64)
    for n in LENGTHS:
        # of all n values from each place on, where they stay inside the word
        size = max(0, len(owner) - n + 1)
        rolled = rolled[:size] * np.uint64(257) + values[n - 1 :][:size]
        inside = owner[:size] == owner[n - 1 :][:size]
        grams.append((mix(rolled[inside] + np.uint64(n << 40)) % np.uint64(BUCKETS)).astype(np.int64))
        gram_of.append(owner[:size][inside])
    grams, gram_of = np.concatenate(grams), np.concatenate(gram_of)
    order = np.argsort(gram_of, kind="stable")
    return Words(starts, ends, first, which, lettered, scripts, grams[order], gram_of[order])


@dataclass(frozen=True)
class LanguageModel:
    """Log probabilities [bucket, language] and the languages that each script admits."""

    languages: tuple[str, ...]
    table: np.ndarray
    admits: np.ndarray

    def scores(self, words: Words) -> np.ndarray:
        """Log share of each language for each distinct word, MOST at the lowest; 0 for words that say nothing."""
        n = len(words.lettered)
        sums = np.zeros((n, len(self.languages)))
        if n:
            begins = np.searchsorted(words.gram_of, np.arange(n))
            sums = np.add.reduceat(self.table[words.grams], begins, axis=0).astype(np.float64)
        may = self.admits[words.scripts]
        sums = np.where(may, sums, -np.inf)
        said = words.lettered & may.any(axis=1)
        sums[~said] = 0
        top = sums.max(axis=1, keepdims=True)
        logs = sums - top - np.log(np.exp(sums - top).sum(axis=1, keepdims=True))
        logs = np.maximum(logs, -MOST)
        logs[~said] = 0
        return logs

    def said(self, words: Words) -> np.ndarray:
        """Which distinct words have a letter, of a script that some language admits."""
        return words.lettered & self.admits[words.scripts].any(axis=1)


def viterbi(emit: np.ndarray, first: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """The best label of every word, from scores [word, label], where ``first`` tells the first word of each text."""
    n, labels = emit.shape
    counts = np.diff(first)
    chunk = chunk if labels <= FEW else max(1, int(counts.max(initial=1)))
    per_text = -(-counts // chunk)
    text = np.repeat(np.arange(len(counts)), per_text)
    begins = first[text] + chunk * (np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text))
    sizes = np.minimum(begins + chunk, first[text + 1]) - begins
    goes_on = np.append(text[1:] == text[:-1], False) if len(text) else np.zeros(0, bool)

    def active(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chunks in order of length, and how many are longer than t, for each t."""
        order = which[np.argsort(-sizes[which], kind="stable")]
        return order, np.searchsorted(-sizes[order], -np.arange(int(sizes[order].max(initial=0))), side="left")

    start = np.zeros((len(text), labels))
    order, longer = active(np.flatnonzero(goes_on))
    maps = np.full((len(order), labels, labels), -1e18)
    maps[:, np.arange(labels), np.arange(labels)] = 0
    for t, m in enumerate(longer):
        part = maps[:m]
        np.maximum(part, part.max(axis=2, keepdims=True) - SWITCH, out=part)
        part += emit[begins[order[:m]] + t][:, None, :]
    for i in np.argsort(order, kind="stable"):
        ahead = (start[order[i]][:, None] + maps[i]).max(axis=0)
        start[order[i] + 1] = ahead - ahead.max()

    switched, source, out = np.zeros((n, labels), bool), np.zeros(n, np.int16), np.zeros(n, np.int16)
    order, longer = active(np.arange(len(text)))
    best = start[order]
    for t, m in enumerate(longer):
        at, own = begins[order[:m]] + t, best[:m]
        top = own.argmax(axis=1)
        moved = own[np.arange(m), top] - SWITCH
        switched[at], source[at] = moved[:, None] > own, top
        np.maximum(own, moved[:, None], out=own)
        own += emit[at]
    last = np.empty(len(text), np.int64)
    last[order] = best.argmax(axis=1)

    # the label before each chunk, for each label at its end
    behind, longer = active(np.flatnonzero(np.append(False, goes_on[:-1])) if len(text) else np.zeros(0, np.int64))
    before = np.repeat(np.arange(labels)[None, :], len(behind), axis=0)
    for t in range(len(longer) - 1, -1, -1):
        at, own = begins[behind[: longer[t]]] + t, before[: longer[t]]
        before[: longer[t]] = np.where(np.take_along_axis(switched[at], own, axis=1), source[at][:, None], own)
    for i in np.argsort(-behind, kind="stable"):
        last[behind[i] - 1] = before[i, last[behind[i]]]

    order, longer = active(np.arange(len(text)))
    out[begins + sizes - 1] = last
    for t in range(len(longer) - 1, 0, -1):
        at = begins[order[: longer[t]]] + t
        now = out[at]
        out[at - 1] = np.where(switched[at, now], source[at], now)
    return out


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 1 modulo 3; false without an id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, text: str = "text", language: str = "lang", id_col: str = "doc_id", most: int = TRAIN_DOCS) -> LanguageModel:
    """Learns from documents that aren't held out, at most ``most`` of each language."""
    bound_batches(docs.sparkSession)
    usable = docs.filter(F.col(id_col).isNotNull() & F.col(language).isNotNull() & F.col(text).isNotNull() & ~held_out(id_col))
    chosen = hashed_sample_by(usable.select(F.col(id_col).alias("i"), F.col(language).cast("string").alias("lang")), "lang", "i", most).distinct()
    chosen = written(chosen)
    chosen = F.broadcast(chosen) if chosen.count() <= BROADCAST_IDS else chosen
    source = usable.select(F.col(id_col).alias("i"), F.col(text).cast("string").alias("text")).join(chosen, "i").select("lang", "text")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part, texts in pieces(parts, "text"):
            langs = part.column(0).to_pylist()
            for words in map(read_words, bounded(texts)):
                for lang in set(langs):
                    mine = [np.arange(words.first[i], words.first[i + 1]) for i, x in enumerate(langs) if x == lang]
                    times = np.bincount(words.which[np.concatenate(mine)], minlength=len(words.lettered)) * words.lettered
                    grams = np.bincount(words.grams, weights=times[words.gram_of], minlength=BUCKETS)
                    scripts = np.bincount(words.scripts, weights=times, minlength=N_SCRIPTS)
                    sums[lang] = sums.get(lang, 0) + np.concatenate([grams, scripts])
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(total[at])], names=["lang", "at", "n"])

    rows = source.mapInArrow(batches, "lang string, at bigint, n double").groupBy("lang", "at").agg(F.sum("n").alias("n")).collect()
    languages = tuple(sorted({r.lang for r in rows}))
    counts = np.zeros((BUCKETS + N_SCRIPTS, max(1, len(languages))))
    for lang, at, n in rows:
        counts[at, languages.index(lang)] = n
    grams, scripts = counts[:BUCKETS] + 0.5, counts[BUCKETS:]
    admits = scripts >= LEAST_SHARE * np.maximum(1, scripts.sum(axis=0))
    return LanguageModel(languages, np.log(grams / grams.sum(axis=0)).astype(np.float32), admits)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", id_col: str = "doc_id", spans: bool = False) -> DataFrame:
    """id_col, lang_pred, score (share of the letters' words' characters that its spans have), and on request the spans.

    ``spans``: array of (first byte, end byte, language) over the whole text.
    """
    bound_batches(docs.sparkSession)
    source = docs.select(F.col(id_col), F.col(text).cast("string").alias("_text"))
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(model.languages)
        for part, texts in pieces(parts, "_text"):
            made, counts, at = [], np.zeros(len(texts), np.int64), 0
            for piece in bounded(texts):
                words = read_words(piece)
                counts += np.diff(words.first)
                known, said = words.lettered[words.which], (model.said(words) if n else np.zeros(len(words.lettered), bool))[words.which]
                made.append((words.starts + at, words.ends + at, known, said, model.scores(words)[words.which].astype(np.float32) if n else None))
                at += len(piece.data)
            starts, ends, known, said = (np.concatenate([m[i] for m in made]) for i in range(4))
            first = np.append(0, np.cumsum(counts))
            labels = viterbi(np.concatenate([m[4] for m in made]), first) if n else np.zeros(len(starts), np.int16)
            owner, sizes = np.repeat(np.arange(len(texts)), counts), ends - starts
            share = np.bincount(owner * max(1, n) + labels, weights=sizes * said, minlength=len(texts) * max(1, n)).reshape(len(texts), -1)
            total = np.bincount(owner, weights=sizes * known, minlength=len(texts))
            predicted = [model.languages[b] if t and n else "und" for b, t in zip(share.argmax(axis=1).tolist(), total.tolist(), strict=True)]
            score = share.max(axis=1) / np.maximum(1, total)
            columns = [part.column(0), pa.array(predicted, pa.string()), pa.array(score)]
            if spans:
                columns.append(pa.array([_spans(starts[a:b] - o, ends[a:b] - o, labels[a:b], known[a:b], model.languages) for a, b, o in zip(first[:-1], first[1:], texts.offsets[:-1], strict=True)], span_type))
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "lang_pred", "score", "spans"][: len(columns)])

    shape = f"`{id_col}` {source.schema[id_col].dataType.simpleString()}, lang_pred string, score double"
    return source.mapInArrow(batches, shape + ", spans array<struct<start:bigint,end:bigint,lang:string>>" * spans)


def _spans(starts: np.ndarray, ends: np.ndarray, labels: np.ndarray, known: np.ndarray, languages: tuple[str, ...]) -> list[dict]:
    """Stretches of words of one label, of one text."""
    if not known.any() or not languages:
        return []
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(labels)) + 1, [len(labels)]])
    return [{"start": int(starts[u]), "end": int(ends[v - 1]), "lang": languages[labels[u]]} for u, v in zip(cuts, cuts[1:], strict=False)]
