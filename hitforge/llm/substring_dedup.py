"""Removal of passages that earlier documents have (operator 11), by level-wise doubling.

Windows of LENGTHS[0] words that occur in one document only are dropped first; only what is left is looked at in windows of
twice that length, and so on up to the length of a passage, which cuts the last doubling short. At each level a word
stays a candidate if it is in a window of passage length all of whose windows of the level are repeated; no survivors end it.

Documents are dealt into chunks by hash. A chunk sends the sorted different windows of its candidates, a few bytes each, to
ranges of the hash; each range answers with one bit a window. So no window is looked up in a table of all repeated ones,
nothing is broadcast, and a window that is in very many documents is sent once by each chunk. At the last level windows are
told apart by 128 bits, the smallest id of the chunk is sent along, and the bit says that another chunk has a smaller one.

Documents with the same words are one class: the one with the smallest id stands for it, and others lose all their
words. Very many copies therefore cost one digest each.

Edge cases: a null text has no words; texts without a whole window lose nothing. A row without id keeps its words and
takes nobody's. Rows of one id, also with different texts, take nothing from each other; repeated rows give equal
rows. The smallest id keeps a passage, so there are no ties. Texts of any length are read in pieces. An empty table gives an empty
table. Other columns, whatever their names, aren't read.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitforge.llm.shingles import WORD_BASE, bounded, cut, mix, word_hashes
from hitforge.llm.text_batches import SMALL_PIECE, Texts, bound_batches, pieces, word_bounds
from hitforge.storage import written

#: Words of a passage, and of the windows of the first level.
PASSAGE, FIRST = 13, 4
#: Words of a chunk, and windows of a range, about.
CHUNK_WORDS, RANGE_WINDOWS = 1 << 20, 1 << 20
#: Ids that may be broadcast, after a count (about 50 bytes each), and spans of removed words; more go through a shuffle join.
BROADCAST_IDS, BROADCAST_SPANS = 1_000_000, 2_000_000

RUNS = "chunk bigint, doc_id bigint, h bigint, at bigint, n_words bigint, text string"


def lengths(passage: int = PASSAGE, first: int = FIRST) -> list[int]:
    """Lengths of the levels: twice the last one each, up to ``passage``."""
    levels = [min(first, passage)]
    while levels[-1] < passage:
        levels.append(min(2 * levels[-1], passage))
    return levels


def word_rows(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), n_words, words_sha256 (of the words joined by one space) of ``docs(doc_id, text)``."""
    bound_batches(docs.sparkSession)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(parts, "text", SMALL_PIECE):
            counts, digests = [], []
            for a, b in itertools.pairwise(texts.offsets.tolist()):
                made, n = hashlib.sha256(), 0
                for piece in cut(texts.data[a:b]):
                    words = piece.tobytes().split()
                    made.update((b" " if n and words else b"") + b" ".join(words))
                    n += len(words)
                counts.append(n)
                digests.append(made.digest())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(counts, pa.int64()), pa.array(digests, pa.binary())], names=["doc_id", "h", "n_words", "words"])

    return docs.select("doc_id", "h", "text").mapInArrow(batches, "doc_id bigint, h bigint, n_words bigint, words binary")


class Windows:
    """The different windows of ``length`` words of a chunk's runs, sorted by hash."""

    def __init__(self, table: pa.Table, length: int, exact: bool):
        self.texts = Texts(table.column("text").combine_chunks())
        made, starts, ends, at = [], [], [], 0
        for part in bounded(self.texts):
            a, b, before = word_bounds(part.data, part.offsets)
            made.append(word_hashes(part.data, a, b, fold=False))
            starts.append((a + at).astype(np.int32))
            ends.append((b + at).astype(np.int32))
            at += len(part.data)
        self.starts, self.ends, words = np.concatenate(starts), np.concatenate(ends), np.concatenate(made)
        self.before = before if len(made) == 1 else np.array([0, len(words)], np.int64)
        del made, starts, ends
        self.run = np.repeat(np.arange(table.num_rows, dtype=np.int32), np.diff(self.before))
        self.places = np.flatnonzero(self.left() >= length).astype(np.int32)  # windows that lie in one run
        keys = [self._rolled(words, length, base) for base in (WORD_BASE, WORD_BASE ^ 0x5DEECE66D0)[: 1 + exact]]
        del words
        self.order = (np.lexsort(keys[::-1]) if exact else np.argsort(keys[0])).astype(np.int32)
        self.keys = []
        while keys:
            self.keys.append(keys.pop(0)[self.order])
        new = np.zeros(len(self.order), bool)
        for k in self.keys:
            new[1:] |= k[1:] != k[:-1]
        new[:1] = True
        self.first = np.flatnonzero(new)
        self.group = np.cumsum(new, dtype=np.int32) - 1
        self.docs = table.column("doc_id").to_numpy()
        docs = self.owners()
        self.least = np.minimum.reduceat(docs, self.first) if len(docs) else docs
        self.most = np.maximum.reduceat(docs, self.first) if len(docs) else docs

    def left(self) -> np.ndarray:
        """How many words of its run there are from each word on."""
        return self.before[1:].astype(np.int32)[self.run] - np.arange(len(self.run), dtype=np.int32)

    def owners(self) -> np.ndarray:
        """The document of each window in order."""
        return self.docs[self.run[self.places[self.order]]]

    def _rolled(self, words: np.ndarray, length: int, base: int) -> np.ndarray:
        n = len(words)
        total = np.full(n, length, np.uint64)
        for i in range(min(length, n)):
            total[: n - i] += words[i:] * np.uint64(pow(base, i + 1, 1 << 64))
        return mix(total[self.places])


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all their first bytes first: of sorted ones the high bytes are alike and compress."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _numbers(planes: bytes, kind: type) -> np.ndarray:
    """The reverse of ``_planes``."""
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _slots(windows: Windows, bits: int, exact: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(range, slot in it, group of the window) of what a chunk asks for, in order; windows of a slot are asked for once."""
    keys = windows.keys[0][windows.first]
    of = keys >> np.uint64(64 - bits)
    if exact:
        return of, keys, np.arange(len(keys))
    slot = keys >> np.uint64(32 - bits)
    new = np.ones(len(slot), bool)
    new[1:] = slot[1:] != slot[:-1]
    return of[new], slot[new].astype(np.uint32), np.cumsum(new) - 1


def _asked(runs: DataFrame, length: int, bits: int, exact: bool) -> DataFrame:
    """(range, chunk, slots, others, ids): the windows of each chunk, dealt into ranges of their hash."""

    def ask(table: pa.Table) -> pa.Table:
        windows = Windows(table, length, exact)
        of, slots, _ = _slots(windows, bits, exact)
        cuts = np.flatnonzero(np.diff(of)) + 1
        bounds = list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(of)], strict=True)) if len(of) else []
        second, ids = (windows.keys[1][windows.first], windows.least) if exact else (None, None)
        return pa.table(
            {
                "range": pa.array([int(of[a]) for a, _ in bounds], pa.int64()),
                "chunk": pa.array([table.column("chunk")[0].as_py()] * len(bounds), pa.int64()),
                "slots": pa.array([_planes(slots[a:b]) for a, b in bounds], pa.binary()),
                "others": pa.array([second[a:b].tobytes() if exact else None for a, b in bounds], pa.binary()),
                "ids": pa.array([_planes(ids[a:b]) if exact else None for a, b in bounds], pa.binary()),
            }
        )

    return runs.groupBy("chunk").applyInArrow(ask, "range bigint, chunk bigint, slots binary, others binary, ids binary")


def _answered(asked: DataFrame, exact: bool) -> DataFrame:
    """(chunk, range, bits): for each window of a chunk whether another chunk has it, at the last level with a smaller id."""

    def answer(table: pa.Table) -> pa.Table:
        slots = [_numbers(x, np.uint64 if exact else np.uint32) for x in table.column("slots").to_pylist()]
        sizes = [len(x) for x in slots]
        flat = np.concatenate(slots)
        keys = [flat]
        if exact:
            keys.append(np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("others").to_pylist()]))
            ids = np.concatenate([_numbers(x, np.int64) for x in table.column("ids").to_pylist()])
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(flat), bool)
        for k in keys:
            new[1:] |= k[order][1:] != k[order][:-1]
        new[:1] = True
        first, group = np.flatnonzero(new), np.cumsum(new) - 1
        yes = np.zeros(len(flat), bool)
        yes[order] = ids[order] > np.minimum.reduceat(ids[order], first)[group] if exact else (np.diff(np.append(first, len(flat))) > 1)[group]
        bits = [np.packbits(part).tobytes() for part in np.split(yes, np.cumsum(sizes)[:-1])]
        return pa.table({"chunk": table.column("chunk"), "range": table.column("range"), "bits": pa.array(bits, pa.binary()), "n": pa.array(sizes, pa.int64())})

    return asked.groupBy("range").applyInArrow(answer, "chunk bigint, range bigint, bits binary, n bigint")


def _told(windows: Windows, answers: pa.Table, bits: int, exact: bool) -> np.ndarray:
    """For each word of the chunk whether the window that begins there is repeated (at the last level: with a smaller id elsewhere)."""
    rows = sorted(zip(*(answers.column(c).to_pylist() for c in ("range", "bits", "n")), strict=True))
    known = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for _, x, n in rows]).astype(bool) if rows else np.zeros(0, bool)
    yes = known[_slots(windows, bits, exact)[2]]
    if exact:
        here = yes[windows.group] | (windows.owners() > windows.least[windows.group])
    else:
        here = (yes | (windows.least < windows.most))[windows.group]
    told = np.zeros(len(windows.starts), bool)
    told[windows.places[windows.order]] = here
    return told


def _stretches(marked: np.ndarray) -> np.ndarray:
    """(first, end) of every stretch of marked places."""
    edge = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1)


def _level(runs: DataFrame, length: int, bits: int, passage: int, last: bool) -> DataFrame:
    """The runs of words that are candidates after a level; after the last one, the spans of words that go.

    Runs are dealt into chunks once, for what they ask and for what comes of the answers.
    """
    answers = _answered(_asked(runs, length, bits, last), last)

    def follow(table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({name: pa.array([], kind) for name, kind in kinds.items()})
        windows = Windows(table, length, last)
        good, n = _told(windows, told, bits, last), len(windows.starts)
        if last:
            begins = good
        else:  # windows of the passage's length in which all of this level are repeated
            bad = np.concatenate([np.zeros(1, np.int32), np.cumsum(~good, dtype=np.int32)])
            begins = np.zeros(n, bool)
            inside = np.flatnonzero(windows.left() >= passage)
            begins[inside] = bad[inside + passage - length + 1] == bad[inside]
        out: dict[str, list] = {name: [] for name in kinds}
        own = {c: table.column(c).to_pylist() for c in ("chunk", "doc_id", "h", "at")}
        # stretches of one run: a place between runs is never a beginning, as a window begins passage words before its run's end
        for a, b in _stretches(begins).tolist():
            r, end = int(windows.run[a]), b + passage - 1
            for c in ("chunk", "doc_id", "h"):
                out[c].append(own[c][r])
            out["at"].append(own["at"][r] + a - int(windows.before[r]))
            out["n_words"].append(end - a)
            out["text"].append(None if last else windows.texts.data[windows.starts[a] : windows.ends[end - 1]].tobytes())
        return pa.table({name: pa.array(out[name], pa.binary()).cast(pa.string()) if name == "text" else pa.array(out[name], kind) for name, kind in kinds.items()})

    kinds = {"chunk": pa.int64(), "doc_id": pa.int64(), "h": pa.int64(), "at": pa.int64(), "n_words": pa.int64(), "text": pa.string()}
    return runs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(follow, RUNS)


def repeated_spans(docs: DataFrame, words: int, passage: int = PASSAGE, first: int = FIRST) -> DataFrame:
    """doc_id, h, at, n_words: the spans of words of ``docs(doc_id, h, text)`` that are covered by a passage of which a
    smaller id has the words. Spans of a document can overlap. ``words`` is about how many there are.

    Rows of one id and hash should be there once.
    """
    runs = docs.select(F.col("doc_id"), F.col("h"), F.lit(0).cast("bigint").alias("at"), F.col("text"))
    for length in lengths(passage, first):
        last = length == passage
        chunks, bits = max(1, math.ceil(words / CHUNK_WORDS)), max(1, math.ceil(math.log2(max(1, words) / RANGE_WINDOWS)))
        dealt = runs.select(F.pmod(F.xxhash64("doc_id", "h"), F.lit(chunks)).alias("chunk"), "doc_id", "h", "at", "text")
        runs = written(_level(dealt, length, min(bits, 31), passage, last))
        words = runs.agg(F.sum("n_words")).first()[0] or 0
        if not words:
            break
    return runs.select("doc_id", "h", "at", "n_words")


def _kept(texts: DataFrame) -> DataFrame:
    """(words, n_removed, kept_sha256) from texts with the spans (at, n_words) that go."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, piece in pieces(parts, "text", SMALL_PIECE):
            removed, digests = [], []
            ats, lengths_ = part.column(2), part.column(3)
            for i, (a, b) in enumerate(itertools.pairwise(piece.offsets.tolist())):
                at, n = (x[i].values.to_numpy(zero_copy_only=False) for x in (ats, lengths_))
                made, done, went, some = hashlib.sha256(), 0, 0, False
                order = np.argsort(at, kind="stable")
                at, end = at[order], np.maximum.accumulate((at + n)[order])
                for words in (x.tobytes().split() for x in cut(piece.data[a:b])):
                    within = done + np.arange(len(words))
                    place = np.searchsorted(at, within, side="right") - 1
                    gone = (place >= 0) & (within < end[np.maximum(place, 0)])
                    left = list(itertools.compress(words, ~gone))
                    if left:
                        made.update((b" " if some else b"") + b" ".join(left))
                        some = True
                    done, went = done + len(words), went + int(gone.sum())
                removed.append(went)
                digests.append(made.hexdigest())
            yield pa.RecordBatch.from_arrays([part.column(1), pa.array(removed, pa.int64()), pa.array(digests, pa.string())], names=["words", "n_removed", "kept_sha256"])

    return texts.select("text", "words", "ats", "lengths").mapInArrow(batches, "words binary, n_removed bigint, kept_sha256 string")


def _looked_up(table: DataFrame, most: int = BROADCAST_IDS) -> DataFrame:
    """A written table for a join, broadcast if it has ``most`` rows at most."""
    return F.broadcast(table) if table.count() <= most else table


def substring_dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id", passage: int = PASSAGE, first: int = FIRST) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the words that stay, joined by one space) of every row."""
    content = F.col(text).cast("string")
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(content).alias("h"), content.alias("text"))
    rows = written(word_rows(docs))
    able = rows.filter((F.col("n_words") >= passage) & F.col("doc_id").isNotNull())
    classes = able.groupBy("words").agg(F.min(F.struct("doc_id", "h")).alias("r"), F.count(F.lit(1)).alias("rows"))
    classes = written(classes.select("words", F.col("r.doc_id").alias("rep"), F.col("r.h").alias("rep_h"), "rows"))

    # one row of each class: all others of more than one row are left out, and rows that are there several times come once
    several = classes.filter("rows > 1")
    others = able.join(_looked_up(written(several.select("words", "rep", "rep_h"))), "words").groupBy("doc_id", "h", "rep", "rep_h").agg(F.count(F.lit(1)).alias("n"))
    stands = (F.col("doc_id") == F.col("rep")) & (F.col("h") == F.col("rep_h"))
    others = written(others.select("doc_id", "h", stands.alias("stands"), "n").filter("not stands or n > 1"))
    texts = docs.filter("doc_id is not null")
    once = texts.join(_looked_up(others.select("doc_id", "h")), ["doc_id", "h"], "left_anti")
    again = others.filter("stands").select("doc_id", "h")
    if not again.isEmpty():
        once = once.unionByName(texts.join(_looked_up(again), ["doc_id", "h"], "left_semi").dropDuplicates(["doc_id", "h"]).select(once.columns))
    words = able.agg(F.sum("n_words")).first()[0] or 0
    spans = repeated_spans(once, words, passage, first) if words else docs.limit(0).select("doc_id", "h", F.col("h").alias("at"), F.col("h").alias("n_words"))

    gone = written(spans.groupBy("doc_id", "h").agg(F.collect_list(F.struct("at", "n_words")).alias("s")).join(_looked_up(classes.select(F.col("rep").alias("doc_id"), F.col("rep_h").alias("h"), "words")), ["doc_id", "h"]).select("doc_id", "h", "words", F.col("s.at").alias("ats"), F.col("s.n_words").alias("lengths")))
    size = gone.agg(F.sum(F.size("ats"))).first()[0] or 0
    changed = texts.join(F.broadcast(gone) if size <= BROADCAST_SPANS else gone, ["doc_id", "h"])
    changed = written(_kept(changed).dropDuplicates(["words"]))

    nothing = hashlib.sha256(b"").hexdigest()
    known = classes.join(_looked_up(changed), "words", "left").select("words", "rep", "n_removed", "kept_sha256")
    told = known.filter("n_removed is not null").unionByName(known.join(several.select("words"), "words", "left_semi").filter("n_removed is null"))
    out = rows.join(_looked_up(written(told)), "words", "left")
    copy = F.col("doc_id") > F.col("rep")
    return out.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).when(F.col("doc_id") == F.col("rep"), F.coalesce("n_removed", F.lit(0).cast("bigint"))).otherwise(F.lit(0).cast("bigint")).alias("n_removed"),
        F.when(copy, F.lit(nothing)).when(F.col("doc_id") == F.col("rep"), F.coalesce("kept_sha256", F.lower(F.hex("words")))).otherwise(F.lower(F.hex("words"))).alias("kept_sha256"),
    )


def oracle_sql() -> str:
    """The result as DuckDB SQL, from all windows of all documents."""
    return r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    i AS (SELECT doc_id, w, unnest(CASE WHEN len(w) >= 13 THEN range(1, len(w) - 11) ELSE [] END) AS i FROM d),
    s AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM i),
    m AS (SELECT s, min(doc_id) AS m FROM s GROUP BY s),
    r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM s JOIN m ON m.s = s.s WHERE doc_id > m),
    g AS (SELECT doc_id, list(j) AS g, count(*) AS n FROM r GROUP BY doc_id)
    SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
        sha256(coalesce(array_to_string(CASE WHEN n IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda x: NOT list_contains(g, x)), lambda x: w[x]) END, ' '), '')) AS kept_sha256
    FROM d LEFT JOIN g ON g.doc_id = d.doc_id"""
