"""Chroma fingerprints of audio columns and their alignment (operator 7).

Samples become frames, frames become energies of the twelve pitch classes, and an integral image over (frame, class)
gives the sums of rectangles at four look-ups each. Sixteen filters compare two parts of a rectangle; each difference
becomes two bits in Gray code by the quartiles that this filter has over the whole table, so that every position of the
filters' window gives one packed 32-bit integer, whose codes are about equally frequent.

Recordings with equal fingerprints are one class. Every integer is a landmark, runs of one value counting once. Each
two classes that share landmarks have a histogram of offsets; every offset with a vote is tested by the bit errors over
the whole overlap. The best confirmed alignment with an earlier class is given, and how many classes are confirmed.

Landmarks of up to RARE places are joined by value. Classes that hold a more frequent one are dealt into blocks by the least
of these, so that copies of a recording fall together. Two blocks meet only where they share a landmark, and a class comes
to a block only where one of that block has a landmark of its own; there landmarks are joined and offsets tested without
writing the pairs down. A pair of classes is looked at in one of the two ways only, and none is left out.

Edge cases: null, empty and short audio has no integers and isn't aligned. A row without id is fingerprinted and not
aligned. Repeated rows fall into one class; of rows with one id and different audio the class rows are kept apart by
their fingerprint, and the id is aligned by the least of these. Equal best alignments: more votes, then the earliest
anchor, then the nearest and greater position. An empty table gives an empty table. Long audio is read in bounded
blocks. Other columns, whatever their names, are not carried along.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitforge.llm.text_batches import bound_batches
from hitforge.storage import written

FRAME, HOP, RATE, WIDTH = 512, 128, 8000, 8
#: The share of wrong bits and the overlap that confirm an alignment.
MOST_ERRORS, LEAST_OVERLAP = 0.2, 6
#: Windows that are worked on at once.
BLOCK = 8192
#: Places up to which a landmark is joined by value; classes that hold a more frequent one meet in blocks.
RARE = 16
#: Integers of a block of classes, about; the least number of blocks; shared landmarks and compared integers at once.
BLOCK_INTS, LEAST_BLOCKS, RUN, CELLS = 1 << 19, 12, 1 << 20, 1 << 21
#: Blocks whose number of parts may be broadcast (16 bytes each).
BROADCAST_BLOCKS = 1_000_000
#: Filter values from -2 to 2 are told apart by so many bins.
BINS = 4096
GRAY = np.array([0, 1, 3, 2], np.uint32)


def filters() -> list[tuple[str, int, int]]:
    """Sixteen (split, first class, classes) over rectangles of WIDTH frames.

    Lower against upper half of the classes, for neighbours and for groups of four; earlier against later frames, for
    neighbours; and opposite quarters of the whole.
    """
    return [("classes", c, 2) for c in range(0, 12, 2)] + [("classes", c, 4) for c in range(0, 12, 4)] + [("frames", c, 2) for c in range(0, 12, 2)] + [("quarters", 0, 12)]


@functools.cache
def _pitch_classes() -> tuple[np.ndarray, np.ndarray]:
    """Spectrum bins between 80 and 3800 Hz in order of their pitch class, and where each class starts there."""
    hertz = np.arange(1, FRAME // 2 + 1) * RATE / FRAME
    bins = 1 + np.flatnonzero((hertz >= 80) & (hertz <= 3800))
    classes = np.round(12 * np.log2(hertz[bins - 1] / 440)).astype(np.int64) % 12
    order = np.argsort(classes, kind="stable")
    return bins[order], np.searchsorted(classes[order], np.arange(12))


def chroma(samples: np.ndarray) -> np.ndarray:
    """Normed energies [frame, class] of 8-bit samples."""
    n = (len(samples) - FRAME) // HOP + 1
    if n <= 0:
        return np.zeros((0, 12), np.float32)
    frames = np.lib.stride_tricks.sliding_window_view(samples.astype(np.float32) - 128, FRAME)[::HOP]
    bins, starts = _pitch_classes()
    window, out = np.hanning(FRAME).astype(np.float32), np.empty((n, 12), np.float32)
    for i in range(0, n, 512):
        power = np.abs(np.fft.rfft(frames[i : i + 512] * window, axis=1)).astype(np.float32)
        # summed frame by frame: a matrix product would round by the number of frames in the block
        out[i : i + 512] = np.add.reduceat(power[:, bins], starts, axis=1)
    return out / np.maximum(1e-6, out.mean(axis=1, keepdims=True))


def _responses(image: np.ndarray) -> np.ndarray:
    """Filter values [position, filter] of a stretch of chroma, from its integral image."""
    n = len(image) - WIDTH + 1
    sums = np.zeros((len(image) + 1, 13))
    sums[1:, 1:] = image.cumsum(axis=0, dtype=np.float64).cumsum(axis=1)

    def area(t: int, height: int, low: int, high: int) -> np.ndarray:
        a, b = t, t + height
        return sums[b : b + n, high] - sums[a : a + n, high] - sums[b : b + n, low] + sums[a : a + n, low]

    out, half = np.empty((n, 16), np.float32), WIDTH // 2
    for i, (split, low, classes) in enumerate(filters()):
        high, middle = low + classes, low + classes // 2
        whole = area(0, WIDTH, low, high)
        if split == "classes":
            one = area(0, WIDTH, low, middle)
        elif split == "frames":
            one = area(0, half, low, high)
        else:
            one = area(0, half, low, middle) + area(half, half, middle, high)
        out[:, i] = np.log((1 + one) / (1 + whole - one))
    return out


def filter_bins(samples: np.ndarray) -> np.ndarray:
    """The bin of every filter value [position, filter], worked out in blocks of BLOCK positions."""
    n = (len(samples) - FRAME) // HOP + 1 - (WIDTH - 1)
    out = np.empty((max(n, 0), 16), np.int16)
    for i in range(0, n, BLOCK):
        j = min(n, i + BLOCK)
        image = chroma(samples[i * HOP : (j + WIDTH - 2) * HOP + FRAME])
        out[i:j] = np.clip((_responses(image) + 2) * (BINS / 4), 0, BINS - 1)
    return out


def packed(bins: np.ndarray, quartiles: np.ndarray) -> np.ndarray:
    """One integer (int32) for each row of bins: two bits of Gray code a filter, by its three quartiles."""
    ints = np.zeros(len(bins), np.uint32)
    for i in range(16):
        ints = (ints << np.uint32(2)) | GRAY[np.searchsorted(quartiles[i], bins[:, i], side="right")]
    return ints.view(np.int32)


def landmarks(ints: np.ndarray) -> np.ndarray:
    """Positions of the integers that differ from the one before."""
    return np.flatnonzero(np.append(True, ints[1:] != ints[:-1])) if len(ints) else np.zeros(0, np.int64)


def quartiles_of(bins: DataFrame) -> np.ndarray:
    """The bins at a quarter, a half and three quarters of each filter's values over all rows of ``bins(bins)``.

    Workers send counts of bins, BINS for each filter at most, whatever the size of the table.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(16 * BINS, np.int64)
        for part in parts:
            values = part.column(0).flatten().to_numpy().astype(np.int64).reshape(-1, 16)
            counts += np.bincount((values + BINS * np.arange(16)).ravel(), minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["at", "n"])

    counts = np.zeros(16 * BINS, np.int64)
    for at, n in bins.select("bins").mapInArrow(batches, "at bigint, n bigint").groupBy("at").agg(F.sum("n")).collect():
        counts[at] = n
    upto = counts.reshape(16, BINS).cumsum(axis=1)
    return np.array([np.searchsorted(row, row[-1] * np.array([0.25, 0.5, 0.75]), side="right") for row in upto])


def as_recordings(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """A media column that Spark derives from texts: their UTF-8 bytes, read as 8-bit samples."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.encode(F.col(text), "UTF-8").alias("audio"))


def fingerprints(recordings: DataFrame, audio: str = "audio", id_col: str = "doc_id") -> DataFrame:
    """doc_id, ints (the fingerprint), marks (landmarks' positions) of 8-bit mono audio at RATE.

    Filter values are worked out once and written; their quartiles over the whole table then make the codes.
    """
    bound_batches(recordings.sparkSession)

    def measured(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            made = [filter_bins(np.frombuffer(a.as_buffer(), np.uint8)).ravel() if a.is_valid else np.zeros(0, np.int16) for a in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.list_(pa.int16()))], names=["doc_id", "bins"])

    source = recordings.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(audio).alias("audio"))
    bins = written(source.mapInArrow(measured, "doc_id bigint, bins array<smallint>"))
    quartiles = quartiles_of(bins)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            values = part.column(1)
            sizes, flat = values.value_lengths().to_numpy() // 16, packed(values.flatten().to_numpy().reshape(-1, 16), quartiles)
            ints = np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []
            marks = [landmarks(x).astype(np.int32) for x in ints]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ints, pa.list_(pa.int32())), pa.array(marks, pa.list_(pa.int32()))], names=["doc_id", "ints", "marks"])

    return bins.mapInArrow(batches, "doc_id bigint, ints array<int>, marks array<int>")


def _wrong(ints: np.ndarray, one: np.ndarray, other: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Bits that differ between ``length`` integers from ``one`` and as many from ``other``, for each candidate."""
    wrong, upto = np.empty(len(length), np.int64), np.cumsum(length)
    i = 0
    while i < len(length):
        done = int(upto[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(upto, done + CELLS, "right")))
        starts = upto[i:j] - length[i:j] - done
        cells = np.arange(int(upto[j - 1]) - done)
        differ = ints[cells + np.repeat(one[i:j] - starts, length[i:j])] ^ ints[cells + np.repeat(other[i:j] - starts, length[i:j])]
        wrong[i:j] = np.add.reduceat(np.bitwise_count(differ), starts, dtype=np.int64)
        i = j
    return wrong


def _best(found: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The best candidate of each ``own``: confirmed, most votes, earliest anchor, nearest and then greater position."""
    order = np.lexsort((found["position"], -np.abs(found["position"]), -found["anchor"], found["votes"], found["good"], found["own"]))
    own = found["own"][order]
    order = order[np.flatnonzero(np.append(own[1:] != own[:-1], True))] if len(own) else order
    return {name: column[order] for name, column in found.items()}


def _alignments(ids: np.ndarray, ints: np.ndarray, starts: np.ndarray, sizes: np.ndarray, left: tuple, right: tuple) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """How many others each recording is aligned with, and the best candidate of each with an earlier one.

    ``left`` and ``right`` are landmarks (recording, position) in order of the recordings, which are numbers into ``ids``.
    A candidate is a pair of recordings with one from each side, at an offset where they share a landmark.
    """
    links, bests = np.zeros(len(ids), np.int64), []
    (doc, at), (doc_r, at_r) = left, right
    values = ints[starts[doc_r] + at_r]
    order = np.argsort(values, kind="stable")
    values, doc_r, at_r = values[order], doc_r[order], at_r[order]
    mine = ints[starts[doc] + at]
    low = np.searchsorted(values, mine, "left")
    have = np.searchsorted(values, mine, "right") - low
    # whole recordings at once, as votes are counted for each
    ends = np.append(np.flatnonzero(doc[1:] != doc[:-1]) + 1, len(doc)) if len(doc) else np.zeros(0, np.int64)
    upto = np.append(0, np.cumsum(have))
    reach = int(sizes.max(initial=0))
    span, a = 2 * reach + 1, 0
    while a < len(doc):
        b = int(ends[np.searchsorted(ends, a, "right")])
        further = int(np.searchsorted(upto[ends], upto[a] + RUN, "right")) - 1
        b = max(b, int(ends[further])) if further >= 0 else b
        n = have[a:b]
        with_r = np.arange(int(n.sum())) + np.repeat(low[a:b] - (np.cumsum(n) - n), n)
        one, other = np.repeat(doc[a:b], n), doc_r[with_r]
        offset = at_r[with_r] - np.repeat(at[a:b], n)
        if left is right:
            once = ids[one] > ids[other]
            one, other, offset = one[once], other[once], offset[once]
        first = int(doc[a])
        key, votes = np.unique(((one - first) * len(ids) + other) * span + (offset + reach), return_counts=True)
        a = b
        if not len(key):
            continue
        key, offset = key // span, key % span - reach
        one, other = key // len(ids) + first, key % len(ids)
        skip, there = np.maximum(-offset, 0), np.maximum(offset, 0)
        length = np.minimum(sizes[one] - skip, sizes[other] - there)
        errors = _wrong(ints, starts[one] + skip, starts[other] + there, length) / (32 * length)
        good = (errors <= MOST_ERRORS) & (length >= LEAST_OVERLAP)
        linked = np.unique(one[good] * len(ids) + other[good])
        links += np.bincount(linked // len(ids), minlength=len(ids)) + np.bincount(linked % len(ids), minlength=len(ids))
        later = ids[one] > ids[other]
        bests.append(_best({
            "own": np.where(later, one, other), "anchor": ids[np.where(later, other, one)], "position": np.where(later, offset, -offset),
            "votes": votes, "good": good, "errors": errors,
        }))
    names = ("own", "anchor", "position", "votes", "good", "errors")
    return links, _best({name: np.concatenate([b[name] for b in bests]) if bests else np.zeros(0, np.int64) for name in names})


#: What both ways give: links of a class, and its best candidates among earlier ones.
FOUND = "doc_id bigint, links bigint, anchor_id bigint, position bigint, votes bigint, good boolean, bit_errors double"


def _meetings(first: DataFrame, marks: DataFrame) -> DataFrame:
    """(doc_id, own, other): the block of each class, and the blocks of which some class shares a landmark with it, its own too.

    ``marks(value, doc_id, n)`` are the shared landmarks of the classes ``first(doc_id, ints)``. Blocks go by the least frequent
    landmark in an order by hash, are about BLOCK_INTS integers, and a larger group of one such landmark has several.
    """
    least = marks.filter(F.col("n") > RARE).groupBy("doc_id").agg(F.min(F.xxhash64("value")).alias("by"))
    sized = written(first.select("doc_id", F.size("ints").alias("n_ints")).join(least, "doc_id"))
    blocks = max(LEAST_BLOCKS, -(-(sized.agg(F.sum("n_ints")).first()[0] or 0) // BLOCK_INTS))
    binned = sized.withColumn("bin", F.pmod("by", F.lit(blocks)))
    parts = written(binned.groupBy("bin").agg(F.ceil(F.sum("n_ints") / BLOCK_INTS).alias("parts")))  # a row for each block at most
    parts = F.broadcast(parts) if blocks <= BROADCAST_BLOCKS else parts
    own = written(binned.join(parts, "bin").select("doc_id", (F.col("bin") * (1 << 20) + F.pmod(F.xxhash64("doc_id"), "parts")).alias("own")))
    held = written(marks.select("value", "doc_id").join(own, "doc_id").distinct())
    among = held.groupBy("value").agg(F.collect_set("own").alias("others"))
    return held.join(among, "value").select("doc_id", "own", F.explode("others").alias("other")).distinct()


def _in_blocks(first: DataFrame, marks: DataFrame) -> DataFrame:
    """FOUND of the alignments of ``first(doc_id, ints, marks)`` with each other, by their shared landmarks ``marks(value, doc_id, n)``."""
    meetings = written(_meetings(first, marks))
    rows = meetings.join(first.select("doc_id", "ints", "marks"), "doc_id").select(F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "doc_id", "ints", "marks")

    def met(group: pa.Table) -> pa.Table:
        i, j = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        ids, block = group.column("doc_id").to_numpy(), group.column("own").to_numpy()
        ints, marks = (group.column(c).combine_chunks() for c in ("ints", "marks"))
        sizes, counts = (x.value_lengths().to_numpy().astype(np.int64) for x in (ints, marks))
        starts, doc, at = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(ids)), counts), marks.flatten().to_numpy().astype(np.int64)
        left = doc[block[doc] == i], at[block[doc] == i]
        right = left if i == j else (doc[block[doc] == j], at[block[doc] == j])
        links, best = _alignments(ids, ints.flatten().to_numpy().view(np.uint32), starts, sizes, left, right)
        rows = np.union1d(np.flatnonzero(links), best["own"])
        place = np.searchsorted(best["own"], rows)
        place[place == len(best["own"])] = 0
        none = best["own"][place] != rows if len(best["own"]) else np.ones(len(rows), bool)
        columns = [pa.array(best[name][place], kind, mask=none) for name, kind in (("anchor", pa.int64()), ("position", pa.int64()), ("votes", pa.int64()), ("good", pa.bool_()), ("errors", pa.float64()))]
        return pa.table([pa.array(ids[rows]), pa.array(links[rows]), *columns], names=["doc_id", "links", "anchor_id", "position", "votes", "good", "bit_errors"])

    # a number of partitions of its own: the rows are few for the work on them
    places = meetings.select(F.least("own", "other"), F.greatest("own", "other")).distinct().count()
    return rows.repartition(max(1, min(4000, places)), "low", "high").groupBy("low", "high").applyInArrow(met, FOUND)


def _by_value(first: DataFrame, marks: DataFrame) -> DataFrame:
    """FOUND of the alignments that ``marks(value, doc_id, at, often)`` propose, but those of two classes that are both ``often``.

    A value has RARE places at most, so the candidates grow with the landmarks.
    """
    one = marks.select("value", F.col("doc_id").alias("u"), F.col("at").alias("i"), F.col("often").alias("often_u"))
    two = marks.select("value", F.col("doc_id").alias("v"), F.col("at").alias("j"), F.col("often").alias("often_v"))
    met = one.join(two, "value").filter("u > v and not (often_u and often_v)")
    votes = met.groupBy("u", "v", (F.col("j") - F.col("i")).cast("bigint").alias("position")).agg(F.count(F.lit(1)).alias("votes"))
    pairs = votes.groupBy("u", "v").agg(F.collect_list("position").alias("position"), F.collect_list("votes").alias("votes"))
    with_v = pairs.join(first.select(F.col("doc_id").alias("v"), F.col("ints").alias("b")), "v")
    rows = with_v.join(first.select(F.col("doc_id").alias("u"), F.col("ints").alias("a")), "u").select("u", "v", "position", "votes", "a", "b")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            u, v = part.column(0).to_numpy(), part.column(1).to_numpy()
            position, votes = part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy()
            a, b = part.column(4), part.column(5)
            ints = np.concatenate([a.flatten().to_numpy(), b.flatten().to_numpy()]).view(np.uint32)
            pair = np.repeat(np.arange(len(u)), part.column(2).value_lengths().to_numpy())
            sizes = [x.value_lengths().to_numpy().astype(np.int64) for x in (a, b)]
            begins = [np.cumsum(sizes[0]) - sizes[0], np.cumsum(sizes[1]) - sizes[1] + int(sizes[0].sum())]
            skip, there = np.maximum(-position, 0), np.maximum(position, 0)
            length = np.minimum(sizes[0][pair] - skip, sizes[1][pair] - there)
            errors = _wrong(ints, begins[0][pair] + skip, begins[1][pair] + there, length) / (32 * length)
            good = (errors <= MOST_ERRORS) & (length >= LEAST_OVERLAP)
            best = _best({"own": pair, "anchor": v[pair], "position": position, "votes": votes, "good": good, "errors": errors})
            linked = v[best["good"]]
            ids, links = np.concatenate([u, linked]), np.append(best["good"], np.ones(len(linked), bool)).astype(np.int64)
            columns = [pa.concat_arrays([pa.array(best[name]), pa.nulls(len(linked), kind)]) for name, kind in (("anchor", pa.int64()), ("position", pa.int64()), ("votes", pa.int64()), ("good", pa.bool_()), ("errors", pa.float64()))]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), *columns], names=["doc_id", "links", "anchor_id", "position", "votes", "good", "bit_errors"])

    return rows.mapInArrow(batches, FOUND)


def _linked(first: DataFrame) -> DataFrame:
    """doc_id, links and best of each of ``first(doc_id, ints, marks)`` that shares a landmark with another one."""
    marks = first.select("doc_id", F.explode(F.transform("marks", lambda p: F.struct(p.alias("at"), F.get("ints", p).alias("value")))).alias("m")).select("doc_id", "m.at", "m.value")
    counts = written(marks.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    shared = written(marks.join(counts, "value"))
    often = written(shared.filter(F.col("n") > RARE).select("doc_id").distinct())
    flagged = shared.filter(F.col("n") <= RARE).join(often.withColumn("yes", F.lit(True)), "doc_id", "left").select("value", "doc_id", "at", F.coalesce("yes", F.lit(False)).alias("often"))
    found = _by_value(first, flagged).unionByName(_in_blocks(written(first.join(often, "doc_id", "left_semi")), written(shared.join(often, "doc_id", "left_semi").select("value", "doc_id", "n"))))
    best = F.when(F.col("anchor_id").isNotNull(), F.struct("good", "votes", (-F.col("anchor_id")).alias("a"), (-F.abs("position")).alias("p"), "position", "bit_errors"))
    return found.groupBy("doc_id").agg(F.sum("links").alias("links"), F.max(best).alias("b"))


def align(prints: DataFrame) -> DataFrame:
    """One row for each recording of ``prints`` (a written table of ``fingerprints``).

    doc_id, n_ints, class_id (the smallest id with this fingerprint), and for the class's best alignment with an earlier
    one anchor_id, position (of the anchor minus its own, in hops), votes, bit_errors (share over the overlap) and
    aligned (whether they confirm it); links: the number of other classes, earlier or later, with a confirmed alignment.
    """
    digest = F.when(F.size("ints") > 0, F.sha2(F.array_join("ints", ","), 256))
    rows = prints.select("doc_id", F.size("ints").cast("bigint").alias("n_ints"), digest.alias("print"))
    classes = written(rows.filter("print is not null and doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("class_id")))
    # tables of their own where a key may be frequent: a join over two plain shuffles is one that Spark can split
    named = classes.groupBy(F.col("class_id").alias("doc_id")).agg(F.min("print").alias("print"))
    first = written(prints.withColumn("print", digest).join(named, ["doc_id", "print"], "left_semi").dropDuplicates(["doc_id"]).drop("print"))
    found = _linked(first).select(F.col("doc_id").alias("class_id"), (-F.col("b.a")).alias("anchor_id"), "b.position", "b.votes", "b.bit_errors", F.col("b.good").alias("aligned"), "links")
    # one row for each class, so that rows look up their class, its alignment included, in one join; rows without a fingerprint have nothing to look up
    looked_up = written(classes.join(found, "class_id", "left").fillna({"aligned": False, "links": 0}))
    out = rows.filter("print is not null").join(looked_up, "print", "left").unionByName(rows.filter("print is null"), allowMissingColumns=True)
    return out.select("doc_id", "n_ints", "class_id", "anchor_id", "position", "votes", "bit_errors", F.coalesce("aligned", F.lit(False)).alias("aligned"), F.coalesce("links", F.lit(0)).alias("links"))
