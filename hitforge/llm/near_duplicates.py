"""MinHash near-duplicate groups (operator 9).

Many universal hash functions give each document's signature; bands of it make buckets; pairs of a bucket are verified
on signatures, then confirmed on the full shingle sets; confirmed links make components by large-star and small-star.

Documents with equal shingle sets are one class from the start; where texts of one class differ in their words, the sets
themselves are digested, not only their numbers. A bucket isn't expanded into all its pairs: first every
class is paired with a few leaders, those that it meets in most buckets, and the confirmed links make components; then
once more, with leaders of other components. Only pairs of one bucket that are still in different components are left:
their rows meet with their full sets in places of bounded size, and confirmed links alone are written down.

With ROWS = 6 and BANDS = 56 a pair of similarity 0.75 meets in no bucket with probability 2e-5, one of 0.85 with
1e-12; no bucket is capped. The signature check leaves a margin of five standard deviations.

Edge cases: null, empty and blank texts have no shingles and are linked with nothing. A text of fewer words than a
shingle is one shingle. Repeated rows fall together. An id with several texts is one document with the links of all of
them. A row without id is linked with nothing and kept. Ties can't occur: the smallest id stands for a group, and every
row with it is kept. An empty table gives an empty table. A text of any length is read in bounded pieces. Other columns,
whatever their names, are not carried along.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitforge.llm.components import components
from hitforge.llm.shingles import cut, mix, shingle_sets
from hitforge.llm.text_batches import SMALL_PIECE, Texts, bound_batches, pieces, releasing
from hitforge.storage import written

BANDS, ROWS = 56, 6
#: Functions beyond those of the bands, which only sharpen the signature.
EXTRA = 336
#: Ids that may be broadcast, after a count (8 bytes each, 32 MB as a hash table); more go through a shuffle join.
BROADCAST_IDS = 1_000_000
#: Similarity by signature below which a pair can't be 0.75 (five standard deviations of 672 minima).
SIGNATURE_LEAST = 0.667
#: Classes with their digests that may be broadcast, after a count (about 100 bytes each).
BROADCAST_CLASSES = 300_000
#: Buckets of more than BLOCK rows that may be broadcast, after a count (about 100 bytes each); more go through a shuffle join.
BROADCAST_BUCKETS = 100_000
#: Rows of a bucket that are compared with each other at once.
BLOCK = 2048
#: Shingles of the rows of a bucket that are held at once, in two of these blocks.
SHINGLES = 1 << 21
#: Shingle sets that a worker keeps while it confirms pairs.
KEPT_SETS = 1000


@functools.cache
def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and summands of n multiply-add hash functions on 32 bits."""
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64))
    return (seeds[:n] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (seeds[n:] >> np.uint64(32)).astype(np.uint32)


def minima(shingles: np.ndarray, n: int, block: int = 2048, functions_at_once: int = 84) -> np.ndarray:
    """The least value of each of n hash functions over a document's shingles."""
    times, plus = _functions(n)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(n, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), block):
        part = x[i : i + block]
        for f in range(0, n, functions_at_once):
            values = times[f : f + functions_at_once, None] * part
            values += plus[f : f + functions_at_once, None]
            np.minimum(least[f : f + functions_at_once], values.min(axis=1), out=least[f : f + functions_at_once])
    return least


def words_digest(text: np.ndarray) -> bytes:
    """A digest of a text's words in order, A-Z in lower case."""
    made = hashlib.blake2b(digest_size=16)
    for piece in cut(text):
        for word in (b" ".join(piece.tobytes().lower().split()),):
            if word:
                made.update(word + b" ")
    return made.digest()


def set_digest(text: str, k: int) -> bytes:
    """A digest of the k-word shingles themselves: of their own digests in order, 16 bytes each, as a long text has very many."""
    made, words = bytearray(), []
    for piece in cut(np.frombuffer(text.encode(), np.uint8)):
        words += piece.tobytes().lower().split()
        for i in range(len(words) - k + 1):
            made += hashlib.blake2b(b" ".join(words[i : i + k]), digest_size=16).digest()
        words = words[max(0, len(words) - k + 1) :]
    if not made:
        made += hashlib.blake2b(b" ".join(words), digest_size=16).digest()
    found = np.unique(np.frombuffer(made, np.dtype([("a", np.uint64), ("b", np.uint64)])))
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, text: str = "text", id_col: str = "doc_id", k: int = 5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, h (hash of the text), n_shingles, set_id and words_id (digests of the set's numbers and of the words), bands (a key for each band), signature (one byte a function)."""
    bound_batches(docs.sparkSession)
    salts = mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(parts, "text", SMALL_PIECE):
            sizes, ids, words, keys, signs = [], [], [], [], []
            for i, own in enumerate(shingle_sets(texts, k)):
                sizes.append(len(own))
                if not len(own):
                    for column in (ids, words, keys, signs):
                        column.append(None)
                    continue
                least = minima(own, bands * rows + EXTRA)
                key = salts.copy()
                for value in least[: bands * rows].reshape(bands, rows).T.astype(np.uint64):
                    key = mix(key ^ value) + np.uint64(0x9E3779B97F4A7C15)
                ids.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                words.append(words_digest(texts.data[texts.offsets[i] : texts.offsets[i + 1]]))
                keys.append(key.view(np.int64))
                signs.append((least ^ (least >> np.uint32(16))).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(words, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(signs, pa.binary())],
                names=["doc_id", "h", "n_shingles", "set_id", "words_id", "bands", "signature"],
            )

    content = F.col(text).cast("string")
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(content).alias("h"), content.alias("text"))
    return source.mapInArrow(releasing(batches), "doc_id bigint, h bigint, n_shingles bigint, set_id binary, words_id binary, bands array<bigint>, signature binary")


def _told_apart(rows: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """``rows`` with set_id replaced by a digest of the shingles themselves where one set_id has several words_id."""
    several = rows.groupBy("set_id").agg(F.min("words_id").alias("a"), F.max("words_id").alias("b")).filter("a <> b").select("set_id")
    doubtful = written(rows.join(several, "set_id", "left_semi").groupBy("words_id").agg(F.min(F.struct("doc_id", "h")).alias("r")).select("words_id", "r.*"))
    n = doubtful.count()
    if not n:
        return rows
    few = F.broadcast if n <= BROADCAST_IDS else (lambda df: df)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([set_digest(t, k) for t in part.column(1).to_pylist()], pa.binary())], names=["words_id", "exact"])

    texts = docs.withColumn("h", F.xxhash64("text")).join(few(doubtful), ["doc_id", "h"]).dropDuplicates(["words_id"])
    exact = written(texts.select("words_id", "text").mapInArrow(releasing(batches), "words_id binary, exact binary"))
    return rows.join(few(exact), "words_id", "left").withColumn("set_id", F.coalesce("exact", "set_id")).drop("exact")


def _looked_up(table: DataFrame, most: int = BROADCAST_IDS) -> DataFrame:
    """A written table for a join, broadcast if it has ``most`` rows at most."""
    return F.broadcast(table) if table.count() <= most else table


def _of(signed: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of ``signed`` of the nodes in ``nodes(doc_id)``; other rows aren't shuffled where the nodes are few."""
    return signed.join(_looked_up(written(nodes.distinct())), "doc_id", "left_semi")


def _alike(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) of sets near enough in size, whose signatures agree well enough."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                a, b = (np.frombuffer(b"".join(part.column(i).to_pylist()), np.uint8).reshape(part.num_rows, -1) for i in (2, 3))
                same = ((a == b).mean(axis=1) - 1 / 256) / (1 - 1 / 256)
                yield part.filter(pa.array(same >= SIGNATURE_LEAST)).select(["u", "v"])

    signed = _of(signed, pairs.select(F.col("u").alias("doc_id")).union(pairs.select("v")))
    one = signed.select(F.col("doc_id").alias("v"), F.col("size").alias("nv"), F.col("signature").alias("sv"))
    two = signed.select(F.col("doc_id").alias("u"), F.col("size").alias("nu"), F.col("signature").alias("su"))
    sized = pairs.join(one, "v").join(two, "u").filter(100 * F.least("nu", "nv") >= percent * F.greatest("nu", "nv"))
    return sized.select("u", "v", "su", "sv").mapInArrow(releasing(batches), "u bigint, v bigint")


def _texts(nodes: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(doc_id, text) of the nodes in ``nodes(node)``: the text that stands for each."""
    wanted = written(classes.join(nodes.distinct(), "node").select("node", F.col("rep").alias("doc_id"), "h"))
    return docs.withColumn("h", F.xxhash64("text")).join(_looked_up(wanted), ["doc_id", "h"]).select(F.col("node").alias("doc_id"), "text").dropDuplicates(["doc_id"])


def _overlap(one: np.ndarray, other: np.ndarray) -> int:
    """How many numbers two sorted sets share."""
    at = np.searchsorted(one, other)
    at[at == len(one)] = 0
    return int((one[at] == other).sum())


def _sets(nodes: DataFrame, docs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """(doc_id, shingles) of nodes: their full shingle sets, sorted, as bytes."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(parts, "text", SMALL_PIECE):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([own.tobytes() for own in shingle_sets(texts, k)], pa.binary())], names=["doc_id", "shingles"])

    return _texts(nodes, docs, classes).mapInArrow(releasing(batches), "doc_id bigint, shingles binary")


def _confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (u, v) of nodes whose full shingle sets reach the similarity. ``pairs`` is a written table."""
    texts = _texts(pairs.select(F.col("u").alias("node")).union(pairs.select("v")), docs, classes)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}

        def shingles(i: int, text: pa.Scalar) -> np.ndarray:
            if i not in kept:
                if len(kept) >= KEPT_SETS:
                    kept.clear()
                kept[i] = next(shingle_sets(Texts(pa.array([text.as_py()], pa.string())), k))
            return kept[i]

        for part in parts:
            yes = []
            for u, v, tu, tv in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), part.column(3), strict=True):
                own, other = shingles(u, tu), shingles(v, tv)
                both = _overlap(own, other)
                yes.append(100 * both >= percent * (len(own) + len(other) - both))
            yield part.filter(pa.array(yes, pa.bool_())).select(["u", "v"])

    one = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("tv"))
    two = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("tu"))
    return pairs.join(one, "v").join(two, "u").select("u", "v", "tu", "tv").mapInArrow(releasing(batches), "u bigint, v bigint")


def _dealt(left: DataFrame) -> DataFrame:
    """``left(key, band, doc_id, part, size)`` with the places (i, j) in which each row is compared, and ``role``.

    A bucket of up to BLOCK rows, and of SHINGLES shingles, is one place. In a larger one, the rows of its most frequent part are only to be compared
    with the rest: they are cut into blocks, one place each, and the rest comes to each of these. The rest is compared
    with itself in pairs of its own blocks. So the most frequent part is never repeated.
    """
    sizes = left.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("m"))
    large = sizes.groupBy("key").agg(F.sum("n").alias("rows"), F.sum("m").alias("shingles"), F.max(F.struct("n", "m", "part")).alias("most"))
    large = large.filter((F.col("rows") > BLOCK) | (F.col("shingles") > SHINGLES))
    cuts = lambda n, m: F.greatest(F.ceil(n / BLOCK), F.ceil(m / SHINGLES), F.lit(1)).cast("bigint")
    rest = cuts(F.col("rows") - F.col("most.n"), F.col("shingles") - F.col("most.m"))
    large = written(large.select("key", F.col("most.part").alias("main"), cuts(F.col("most.n"), F.col("most.m")).alias("main_blocks"), rest.alias("rest_blocks")))
    large = F.broadcast(large) if large.count() <= BROADCAST_BUCKETS else large
    rows = left.join(large, "key", "left")
    spread = lambda blocks: F.pmod(F.xxhash64("doc_id"), F.col(blocks))
    place = lambda i, j, own, role: F.struct(i.cast("bigint").alias("i"), j.cast("bigint").alias("j"), own.cast("bigint").alias("own"), F.lit(role).alias("role"))
    zero, own = F.lit(0), spread("rest_blocks")
    among = F.transform(F.sequence(F.lit(0), F.col("rest_blocks") - 1), lambda o: place(F.least(own, o), F.greatest(own, o), own, 0))
    with_main = F.transform(F.sequence(F.lit(0), F.col("main_blocks") - 1), lambda i: place(i, F.lit(-1), zero, 0))
    places = F.when(F.col("main").isNull(), F.array(place(zero, zero, zero, 0))).when(F.col("part") == F.col("main"), F.array(place(spread("main_blocks"), F.lit(-1), zero, 1))).otherwise(F.concat(among, with_main))
    return rows.select("key", "band", "doc_id", "part", "size", F.explode(places).alias("p")).select("key", "p.*", "band", "doc_id", "part", "size")


def _compared(left: DataFrame, signed: DataFrame, sets: DataFrame, percent: int = 75) -> DataFrame:
    """Links (u, v) between different parts of the buckets of ``left(key, band, doc_id, part)``, confirmed on full sets.

    Rows of a bucket meet in the places of ``_dealt`` with their sets, and only confirmed links are written down. A pair is
    looked at in the first band whose keys are equal only, and not where links of this place have joined its parts, as a
    link inside a component adds nothing.
    """
    signed = written(_of(signed, left.select("doc_id")))
    rows = _dealt(left.join(_looked_up(signed.select("doc_id", "size")), "doc_id"))
    rows = rows.join(signed.select("doc_id", "bands", "signature").join(sets, "doc_id"), "doc_id")
    rows = rows.select("key", "i", "j", "own", "role", "band", "doc_id", "part", "size", "bands", "signature", "shingles")

    def links(group: pa.Table) -> tuple[list[int], list[int]]:
        i, j, band = (group.column(c)[0].as_py() for c in ("i", "j", "band"))
        own, role, ids, part, sizes = (group.column(c).to_numpy() for c in ("own", "role", "doc_id", "part", "size"))
        signs = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint8).reshape(len(ids), -1)
        keys = group.column("bands").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        held = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("shingles")]
        us, vs, main, joined = [], [], np.flatnonzero(role == 1), part.copy()
        for a in np.flatnonzero(role == 0) if j < 0 else range(len(ids) - 1):
            with_a = main if j < 0 else np.arange(a + 1, len(ids))
            n = sizes[with_a]
            with_a = with_a[(joined[with_a] != joined[a]) & (100 * np.minimum(n, sizes[a]) >= percent * np.maximum(n, sizes[a]))]
            if j >= 0 and i != j:
                with_a = with_a[own[with_a] != own[a]]
            if not len(with_a):
                continue
            same = signs[with_a] == signs[a]
            good = (same.mean(axis=1) - 1 / 256) / (1 - 1 / 256) >= SIGNATURE_LEAST
            first = (keys[with_a[good]] == keys[a]).argmax(axis=1)
            for b in with_a[good][first == band].tolist():
                if joined[b] != joined[a]:
                    both = _overlap(held[a], held[b])
                    if 100 * both >= percent * (len(held[a]) + len(held[b]) - both):
                        us.append(min(int(ids[a]), int(ids[b])))
                        vs.append(max(int(ids[a]), int(ids[b])))
                        joined[joined == joined[b]] = joined[a]
        return us, vs

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups() -> Iterator[pa.Table]:
            open_group, begun = None, []
            for part in parts:
                if not part.num_rows:
                    continue
                names = [part.column(c).to_numpy() for c in ("key", "i", "j")]
                cuts = np.flatnonzero(np.any([x[1:] != x[:-1] for x in names], axis=0)) + 1
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), part.num_rows], strict=True):
                    name = tuple(int(x[a]) for x in names)
                    if name != open_group and begun:
                        yield pa.Table.from_batches(begun).combine_chunks()
                        begun = []
                    open_group = name
                    begun.append(part.slice(a, b - a))
            if begun:
                yield pa.Table.from_batches(begun).combine_chunks()

        for group in groups():
            us, vs = links(group)
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(releasing(batches), "u bigint, v bigint")


def _proposed(members: DataFrame, at_most: int = 4) -> DataFrame:
    """Pairs (u, v) of each document with the leaders that it meets in most buckets, ``at_most`` for each document.

    A bucket of ``members(key, doc_id, part)`` has four leaders, least and greatest in different orders of the ids, so
    that it gives four rows for each member, however many it has. Leaders in the document's own part are left out.
    """
    orders = [F.lit(mask).cast("bigint") for mask in (0, -1 & ((1 << 62) - 1), 0x1555555555555555, 0x3333333333333333)]
    least = members.groupBy("key").agg(*[F.min(F.col("doc_id").bitwiseXOR(mask)).alias(f"l{i}") for i, mask in enumerate(orders)])
    leaders = F.array_distinct(F.array(*[F.col(f"l{i}").bitwiseXOR(mask) for i, mask in enumerate(orders)]))
    met = members.join(least.select("key", leaders.alias("leaders")), "key").select("doc_id", "part", F.explode("leaders").alias("leader"))
    votes = met.filter("doc_id <> leader").groupBy("doc_id", "part", "leader").agg(F.count(F.lit(1)).alias("votes"))
    parts = members.select(F.col("doc_id").alias("leader"), F.col("part").alias("other")).distinct()
    votes = votes.join(parts, "leader").filter("part <> other")
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.col("votes").desc(), "leader"))
    best = votes.withColumn("place", place).filter(F.col("place") <= at_most)
    return best.select(F.least("doc_id", "leader").alias("u"), F.greatest("doc_id", "leader").alias("v")).distinct()


def _mixed(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` with the part that each is in by ``links``, in buckets that hold several parts."""
    known = components(links).select(F.col("node").alias("doc_id"), F.col("component").alias("now"))
    rows = members.join(known, "doc_id", "left").select("key", "band", "doc_id", F.coalesce("now", "doc_id").alias("part"))
    rows = written(rows)
    several = rows.groupBy("key").agg(F.min("part").alias("a"), F.max("part").alias("b")).filter("a <> b").select("key")
    return rows.join(several, "key", "left_semi")


def near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", k: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id of the group), kept (whether the document is that one)."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    all_rows = written(signatures(docs, k=k))
    rows = _told_apart(all_rows.filter("n_shingles > 0 and doc_id is not null"), docs, k)
    # a node for each class of equal sets: numbers of their own, as one id may have several texts
    of_set = rows.groupBy("set_id").agg(F.min(F.struct("doc_id", "h")).alias("r"))
    classes = written(of_set.select("set_id", F.col("r.doc_id").alias("rep"), F.col("r.h").alias("h"), F.monotonically_increasing_id().alias("node")))
    # looked up by the digest too, so that it is the right text of an id
    standing = _looked_up(classes.select("set_id", F.col("rep").alias("doc_id"), "h", "node"), BROADCAST_CLASSES)
    signed = written(rows.join(standing, ["set_id", "doc_id", "h"]).select(F.col("node").alias("doc_id"), F.col("n_shingles").alias("size"), "bands", "signature"))
    if signed.count() > classes.count():  # repeated rows
        signed = written(signed.dropDuplicates(["doc_id"]))

    banded = signed.select("doc_id", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b").select("key")
    members = written(banded.join(shared, "key", "left_semi").withColumn("part", F.col("doc_id")))

    tested, links = None, None
    for again in (False, True):
        left = written(_mixed(members, links)) if again else members
        pairs = _proposed(left)
        pairs = written(pairs.join(tested, ["u", "v"], "left_anti") if tested is not None else pairs)
        found = written(_confirmed(written(_alike(pairs, signed, percent)), docs, classes, k, percent))
        tested = pairs if tested is None else tested.union(pairs)
        links = found if links is None else links.union(found)

    left = written(_mixed(members, links))
    sets = _sets(left.select(F.col("doc_id").alias("node")), docs, classes, k)
    links = links.union(written(_compared(left, signed, sets, percent)))

    # classes that one id is in belong together
    ids = rows.groupBy("doc_id").agg(F.min("set_id").alias("a"), F.max("set_id").alias("b")).filter("a <> b").select("doc_id")
    of_ids = written(rows.join(ids, "doc_id", "left_semi").select("doc_id", "set_id").distinct().join(classes, "set_id").select("doc_id", "node"))
    first = of_ids.groupBy("doc_id").agg(F.min("node").alias("v"))
    links = links.union(of_ids.join(first, "doc_id").filter("node <> v").select(F.col("node").alias("u"), "v"))

    groups = written(classes.select("set_id", "rep", "node").join(components(links), "node", "left"))
    smallest = written(groups.filter("component is not null").groupBy("component").agg(F.min("rep").alias("component_id")))
    of_class = written(groups.join(_looked_up(smallest), "component", "left").select("set_id", F.coalesce("component_id", "rep").alias("component_id")))
    linked = rows.select("doc_id", "n_shingles", "set_id").join(of_class, "set_id").select("doc_id", "n_shingles", "component_id")
    others = all_rows.filter("not (n_shingles > 0 and doc_id is not null)").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = linked.unionByName(others)
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def oracle_sql() -> str:
    """The result as DuckDB SQL: all pairs that share a shingle, and components by recursion."""
    return r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    both_in AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    e AS (SELECT x, y FROM both_in JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
    r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
    m AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, coalesce(component_id, d.doc_id) = d.doc_id AS kept
    FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.x = d.doc_id"""
