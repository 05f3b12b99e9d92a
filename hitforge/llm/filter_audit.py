"""Audit of how filters interact (operator 12): forward-backward path counting over the lattice of sets of filters.

A state is the set of filters that were applied, an edge applies one more. What an edge removes doesn't depend on the order
in which its state was reached, so every edge is summed up once. Forward counts say in how many orders a state is
reached, backward counts in how many ways it goes on: their product is the number of whole orders through an edge, the
weight of what the edge removes in the Shapley value. The steps of single orders are read from the same edges.

Documents shrink to a mask of failed filters in one pass; per part there are at most 2**n masks, whatever its size, and
n * 2**(n - 1) edges. Copies are found by digests of texts with the smallest id, first summed up by digest and part.

Edge cases: a null text is empty, and a null source is the empty part. Repeated rows count each. A row without id is no
copy of anything and has no labels, nor has anything a smaller id than none. An id with several texts has the same labels
for each; one labelled several times is good or toxic if any of its labels says so. Texts of any length are read whole, in
pieces. An empty table gives an empty table. Other columns, whatever their names, aren't read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitforge.llm.text_batches import SMALL_PIECE, bound_batches, counted_words, pieces
from hitforge.storage import written

FILTERS = "ABCDE"
MOST_SIGNS = np.frombuffer(b"#$%&*|", np.uint8)
#: Filters of which all orders are listed; their number grows with the factorial.
MOST_FILTERS = 8
#: Labels that may be broadcast, after a count (about 30 bytes each); more go through a shuffle join.
BROADCAST_LABELS = 1_000_000


def text_failures(data: np.ndarray) -> int:
    """The bits of the filters A to D that a text of UTF-8 bytes fails."""
    words = distinct = 0
    for found in counted_words(data, bytes.split):
        words, distinct = words + sum(found.values()), distinct + len(found)
    capitals = int(((data >= 65) & (data <= 90)).sum())
    points = len(data) - int(((data & 0xC0) == 0x80).sum())
    fails = (words < 50, 100 * distinct < 65 * words, 100 * capitals > 5 * points, bool(np.isin(data, MOST_SIGNS).any()))
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def judged(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id") -> DataFrame:
    """doc_id, part, fails (bits of A to D), digest (of the text) of every row."""
    bound_batches(docs.sparkSession)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(parts, "text", SMALL_PIECE):
            own = [texts.data[a:b] for a, b in itertools.pairwise(texts.offsets.tolist())]
            made = [pa.array([text_failures(x) for x in own], pa.int32()), pa.array([hashlib.sha256(x).digest() for x in own], pa.binary())]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *made], names=["doc_id", "part", "fails", "digest"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("part"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(batches, "doc_id bigint, part string, fails int, digest binary")


def failure_counts(docs: DataFrame, labels: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id") -> DataFrame:
    """part, fails (bits of the filters), n, good, toxic: one row for each part and mask.

    Rows of one id and text are summed up first, rows of one text in one part next; only then does each text look for its
    smallest id. So no group of copies is gathered anywhere.
    """
    rows = written(judged(docs, text, source, id_col))
    known = written(labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    known = F.broadcast(known) if known.count() <= BROADCAST_LABELS else known
    one = F.lit(1).cast("bigint")
    # one row for each id, text and part
    named = rows.filter("doc_id is not null").groupBy("doc_id", "digest", "part", "fails").agg(F.count(F.lit(1)).alias("n"))
    named = named.join(known, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})
    # one row for each text, part and labels, with its smallest id and the rows of that
    same = named.groupBy("digest", "part", "fails", "good", "toxic").agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("first"))
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    firsts = F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0 * one)
    copy = F.lit(1 << FILTERS.index("E"))
    split = F.array(F.struct(F.col("fails").alias("fails"), F.col("firsts").alias("n")), F.struct(F.col("fails").bitwiseOR(copy).alias("fails"), (F.col("n") - F.col("firsts")).alias("n")))
    told = same.withColumn("firsts", firsts).select("part", "good", "toxic", F.explode(split).alias("s")).select("part", "s.fails", "s.n", (F.col("s.n") * F.col("good")).alias("good"), (F.col("s.n") * F.col("toxic")).alias("toxic")).filter("n > 0")
    nameless = rows.filter("doc_id is null").select("part", "fails", one.alias("n"), (0 * one).alias("good"), (0 * one).alias("toxic"))
    return told.unionByName(nameless).groupBy("part", "fails").agg(*[F.sum(c).cast("bigint").alias(c) for c in ("n", "good", "toxic")])


def path_counts(n: int) -> tuple[list[int], list[int]]:
    """In how many orders each set of n filters is reached, and in how many it goes on to all of them."""
    forward, backward = [0] * (1 << n), [0] * (1 << n)
    forward[0] = backward[-1] = 1
    for state in range(1 << n):
        for bit in (1 << i for i in range(n) if not state >> i & 1):
            forward[state | bit] += forward[state]
    for state in reversed(range(1 << n)):
        for bit in (1 << i for i in range(n) if state >> i & 1):
            backward[state ^ bit] += backward[state]
    return forward, backward


def _edges(n: int) -> Column:
    """(state, bit, weight): every edge of the lattice with the number of orders through it."""
    forward, backward = path_counts(n)
    ends = [(state, 1 << i) for state in range(1 << n) for i in range(n) if not state >> i & 1]
    return F.array(*[F.struct(F.lit(s).alias("state"), F.lit(b).alias("bit"), F.lit(forward[s] * backward[s | b]).cast("bigint").alias("weight")) for s, b in ends])


def audit(counts: DataFrame, letters: str = FILTERS) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley from
    ``counts(part, fails, n, good, toxic)``, where bit i of fails stands for the i-th of up to MOST_FILTERS letters.
    """
    if not 1 <= len(letters) <= MOST_FILTERS or len(set(letters)) < len(letters):
        raise ValueError(f"from 1 to {MOST_FILTERS} different letters")
    at = counts.select("part", "fails", "n", "good", "toxic", F.explode(_edges(len(letters))).alias("e")).select("part", "fails", "n", "good", "toxic", "e.*")
    here, fails = F.col("fails").bitwiseAND(F.col("state")) == 0, F.col("fails").bitwiseAND(F.col("bit")) != 0
    cases = {"kept": (here & ~fails, "n"), "removed": (here & fails, "n"), "redundant": (~here & fails, "n"), "unique_fails": (F.col("fails") == F.col("bit"), "n"), "good_lost": (here & fails, "good"), "toxic_lost": (here & fails, "toxic")}
    edges = at.groupBy("part", "state", "bit", "weight").agg(*[F.sum(F.when(case, F.col(what)).otherwise(F.lit(0))).cast("bigint").alias(name) for name, (case, what) in cases.items()])
    edges = edges.withColumn("shapley", F.sum(F.col("removed") * F.col("weight")).over(Window.partitionBy("part", "bit")).cast("bigint"))
    bits = {letter: 1 << i for i, letter in enumerate(letters)}
    steps = [("".join(order), i + 1, sum(bits[x] for x in order[:i]), bits[letter]) for order in itertools.permutations(letters) for i, letter in enumerate(order)]
    listed = counts.sparkSession.createDataFrame(steps, "filter_order string, step int, state int, bit int")  # a table of the letters alone
    return edges.join(F.broadcast(listed), ["state", "bit"]).select("part", "filter_order", "step", *cases, "shapley")


def filter_audit(docs: DataFrame, labels: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id") -> DataFrame:
    """The audit of the five filters over all documents."""
    return audit(written(failure_counts(docs, labels, text, source, id_col)))


def oracle_sql() -> str:
    """The result as DuckDB SQL, where every order is gone through by itself."""
    return r"""WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
    f AS (SELECT part, len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b, 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS c,
        regexp_matches(text, '[#$%&*|]') AS d, coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false) AS e, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
    m AS (SELECT part, (CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END) AS fails,
        count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
    x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM x p, x q, x r, x s, x t WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
    g AS (SELECT part, filter_order, step, fails, n, good, toxic, substr(filter_order, step, 1) AS k, coalesce(regexp_matches(fails, '[' || nullif(substr(filter_order, 1, step - 1), '') || ']'), false) AS gone
        FROM m, o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
    h AS (SELECT part, filter_order, step, k, sum(CASE WHEN NOT gone AND NOT contains(fails, k) THEN n ELSE 0 END) AS kept, sum(CASE WHEN NOT gone AND contains(fails, k) THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN gone AND contains(fails, k) THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = k THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN NOT gone AND contains(fails, k) THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN NOT gone AND contains(fails, k) THEN toxic ELSE 0 END) AS toxic_lost FROM g GROUP BY ALL)
    SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
        (sum(removed) OVER (PARTITION BY part, k))::BIGINT AS shapley FROM h"""
