"""Audit of how far the sources of a language diverge (operator 13), by Gustavson's row accumulation.

Each source has smoothed integer frequencies of the terms that its language keeps. The divergence of two sources is a sum
over all kept terms, of which most occur in neither: these have the baselines of both, the frequencies of a count of zero.

The sum is split into three: the baselines over all terms; what a source's own terms change against the other's baseline,
which depends on their frequency only and is worked out for each different one against all peers at once; and what changes
where both have the term. For that last one a source goes through the term-major index of its terms and scatters into a
dense accumulator with one sum for each peer, so postings are never written out in pairs. The index is dealt into buckets
of whole terms of bounded size, and the accumulators of the buckets are added up.

Tasks hold one bucket, or one source's different frequencies with one number for each peer; the result itself has a row
for each two sources of a language, so this is no more than one source's share of it.

Edge cases: null text, language and source are empty strings. A source without terms, in a language without kept terms
too, has its rows of value 0 with all its peers; the only source of a language has no pairs. Repeated rows are documents
of their own. Texts of any length are counted whole, long ones in turns over shares of their terms. Equal values rank by
item. An empty table gives an empty table. Other columns, whatever their names, aren't read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitforge.llm.text_batches import SMALL_PIECE, bound_batches, counted_words, pieces
from hitforge.storage import written

#: Documents of a language that a term must be in, and the ranks of terms that are returned.
LEAST_DOCS, TOP_TERMS = 10, 10
#: Scale of the frequencies, and what is added to each count.
SCALE, PLUS = 1_000_000_000, 2
#: Terms that a worker counts before it hands them on.
HELD_TERMS = 300_000
#: Postings of a bucket, about: more where there are more pairs of sources, so that a bucket's sums are no more than its postings, up to MOST.
POSTINGS, MOST = 1 << 16, 1 << 20
#: Postings that are scattered at once.
STEP = 1 << 18
#: Numbers of one block of frequencies times peers.
BLOCK = 1 << 20
#: Sources that may be broadcast, after a count (about 60 bytes each); more go through a shuffle join.
BROADCAST_SOURCES = 100_000
#: Each byte as a space, or as it is in a term, A-Z in lower case.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(data: bytes) -> list[bytes]:
    """The terms ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` of a text of UTF-8 bytes, A-Z in lower case."""
    return data.translate(_TERM_BYTES).split()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it); each (lang, source) has a row without term too.

    Workers count the terms of their rows up to a bound before Spark adds the counts up.
    """
    bound_batches(docs.sparkSession)
    names = ["lang", "source", "term", "n", "docs"]

    def rows(held: dict) -> pa.RecordBatch:
        made: list[list] = [[], [], [], [], []]
        for (a, b), (found, within) in held.items():
            k = len(found) + 1
            for column, values in zip(made, ([a] * k, [b] * k, [None, *found], [0, *found.values()], [0, *(within[t] for t in found)]), strict=True):
                column.extend(values)
        kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        columns = [pa.array(x, kind) for x, kind in zip(made, kinds, strict=True)]
        columns[2] = columns[2].cast(pa.string())
        return pa.RecordBatch.from_arrays(columns, names=names)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for part, texts in pieces(parts, "text", SMALL_PIECE):
            of = zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)
            for i, key in enumerate(of):
                found, within = held.setdefault(key, (Counter(), Counter()))
                for terms in counted_words(texts.data[texts.offsets[i] : texts.offsets[i + 1]], terms_of):
                    before = len(found)
                    found.update(terms)
                    within.update(terms.keys())
                    size += len(found) - before
                    if size > HELD_TERMS:
                        yield rows(held)
                        held, size = {}, 0
                        found, within = held.setdefault(key, (Counter(), Counter()))
        if held:
            yield rows(held)

    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    source_rows = docs.select(named(lang).alias("lang"), named(source).alias("source"), F.col(text).cast("string").alias("text"))
    counted = source_rows.mapInArrow(batches, "lang string, source string, term string, n bigint, docs bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + PLUS) / (total + PLUS * terms)), exact; null without terms."""
    of = f"nullif(cast({total} as decimal(20,0)) + {PLUS} * cast({terms} as decimal(20,0)), 0)"
    return F.expr(f"1 + ((cast({count} as decimal(20,0)) + {PLUS}) * {SCALE}) div {of}")


def _far(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q) ** 2 / (p + q)); p and q are at most SCALE + 1, so that squares fit."""
    return (p - q) * (p - q) // (p + q)


def _looked_up(table: DataFrame) -> DataFrame:
    """A written table of sources for a join."""
    return F.broadcast(table) if table.count() <= BROADCAST_SOURCES else table


def scattered(term: np.ndarray, own: np.ndarray, p: np.ndarray, p0: np.ndarray, peers: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each source of a bucket, what changes against each peer over the terms of both.

    ``term``, ``own`` and ``p`` are term, source and frequency of the postings; ``p0`` are the baselines of the ``peers``
    sources. The index is term-major; a source's postings give the rows of it that it scatters.
    """
    major = np.argsort(term, kind="stable")
    term, own, p = term[major], own[major], p[major]
    first = np.searchsorted(term, np.arange(int(term[-1]) + 2)) if len(term) else np.zeros(1, np.int64)
    by_source = np.argsort(own, kind="stable")
    for rows in np.split(by_source, np.flatnonzero(np.diff(own[by_source])) + 1) if len(own) else []:
        one = int(own[rows[0]])
        sums = np.zeros(peers, np.int64)
        lengths = first[term[rows] + 1] - first[term[rows]]
        upto = np.cumsum(lengths)
        at = 0
        while at < len(rows):  # a stretch of the source's terms with STEP postings, or one term
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + STEP, side="right")))
            some, n = rows[at:end], lengths[at:end]
            places = np.repeat(first[term[some]] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            mine, theirs, peer = np.repeat(p[some], n), p[places], own[places]
            np.add.at(sums, peer, _far(mine, theirs) - _far(mine, p0[peer]) - _far(p0[one], theirs) + _far(p0[one], p0[peer]))
            at = end
        yield one, sums


def _in_buckets(postings: DataFrame) -> DataFrame:
    """(lang, one, other, value): over the terms of both, from ``postings(lang, bucket, term, place, p, p0)``."""

    def bucket(key: tuple, table: pa.Table) -> pa.Table:
        term = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        places, local = np.unique(table.column("place").to_numpy(), return_inverse=True)
        p0 = np.zeros(len(places), np.int64)
        p0[local] = table.column("p0").to_numpy()
        ones, others, values = [], [], []
        for one, sums in scattered(term, local, table.column("p").to_numpy(), p0, len(places)):
            some = np.flatnonzero(sums)
            some = some[some != one]
            ones.append(np.full(len(some), places[one]))
            others.append(places[some])
            values.append(sums[some])
        made = [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (ones, others, values)]
        return pa.table([pa.array([key[0].as_py()] * len(made[0]), pa.string()), *made], names=["lang", "one", "other", "value"])

    return postings.groupBy("lang", "bucket").applyInArrow(bucket, "lang string, one bigint, other bigint, value bigint")


def _baselines(rows: DataFrame) -> DataFrame:
    """(lang, one, other, value): baselines over all terms, and each source's own terms against its peers' baselines.

    ``rows(lang, place, terms, p0, ps, times, peers)`` has the different frequencies of a source, how many terms have
    each, and the baselines of all sources of the language in order of place.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for r in range(part.num_rows):
                lang, place, terms, p0 = (part.column(i)[r].as_py() for i in range(4))
                ps, times, peers = (part.column(i)[r].values.to_numpy(zero_copy_only=False).astype(np.int64) for i in (4, 5, 6))
                base = _far(np.int64(p0), peers)
                own = np.zeros(len(peers), np.int64)
                step = max(1, BLOCK // max(1, len(peers)))
                for at in range(0, len(ps), step):
                    own += ((_far(ps[at : at + step, None], peers) - base) * times[at : at + step, None]).sum(axis=0)
                others = np.flatnonzero(np.arange(len(peers)) != place)
                here, there = np.full(len(others), place), others
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * (2 * len(others)), pa.string()), pa.array(np.concatenate([here, there])), pa.array(np.concatenate([there, here])), pa.array(np.concatenate([own[others] + terms * base[others], own[others]]))],
                    names=["lang", "one", "other", "value"],
                )

    return rows.mapInArrow(batches, "lang string, one bigint, other bigint, value bigint")


def source_divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: the peers of every source by divergence, and the terms that it has most beyond its language."""
    counted = written(term_counts(docs, text, lang, source))
    term = Window.partitionBy("lang", "term")
    kept = counted.filter("term is not null").withColumns({"lang_docs": F.sum("docs").over(term), "lang_n": F.sum("n").over(term)}).filter(F.col("lang_docs") >= least_docs)
    kept = written(kept.withColumn("first", (F.row_number().over(term.orderBy("source")) == 1).cast("int")).select("lang", "source", "term", "n", "lang_n", "first"))

    langs = kept.groupBy("lang").agg(F.sum("first").alias("terms"), F.sum("n").alias("lang_total"), F.count(F.lit(1)).alias("postings"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counted.filter("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    groups = groups.withColumns({"place": F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1, "sources": F.count(F.lit(1)).over(Window.partitionBy("lang"))})
    groups = written(groups.withColumn("p0", F.coalesce(_share("0", "total", "terms"), F.lit(1))))

    named = kept.join(_looked_up(groups), ["lang", "source"]).withColumns({"p": _share("n", "total", "terms"), "q": _share("lang_n", "lang_total", "terms")})
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    above = named.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    above = above.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top_terms)

    size = F.greatest(F.lit(POSTINGS), F.least(F.lit(MOST), F.col("sources") * F.col("sources")))
    bucket = F.pmod(F.xxhash64("term"), F.ceil(F.col("postings") / size))
    postings = named.select("lang", bucket.alias("bucket"), "term", F.col("place").cast("bigint").alias("place"), "p", "p0")
    times = named.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m")).groupBy("lang", "source").agg(F.collect_list(F.struct("p", "m")).alias("h"))
    peers = groups.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "p0"))), lambda x: x.p0).alias("peers"))
    empty = F.array().cast("array<bigint>")
    sources = groups.join(times, ["lang", "source"], "left").join(peers, "lang").select("lang", F.col("place").cast("bigint").alias("place"), "terms", "p0", F.coalesce("h.p", empty).alias("ps"), F.coalesce("h.m", empty).alias("times"), "peers")
    pairs = _baselines(sources).unionByName(_in_buckets(postings)).groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))
    names = groups.select("lang", F.col("place").cast("bigint").alias("place"), "source")
    names = F.broadcast(names) if names.count() <= BROADCAST_SOURCES else names
    pairs = pairs.join(names.withColumnRenamed("place", "one"), ["lang", "one"]).join(names.withColumnsRenamed({"place": "other", "source": "item"}), ["lang", "other"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(by_value))
    return pairs.unionByName(above)


def oracle_sql() -> str:
    """The result as DuckDB SQL, over all kept terms of every two sources."""
    return r"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
    t AS (SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
    k AS (SELECT lang, term, sum(n) AS n FROM t GROUP BY ALL HAVING count(*) >= 10),
    l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
    c AS (SELECT t.lang, t.source, t.term, sum(t.n) AS n FROM t JOIN k ON k.lang = t.lang AND k.term = t.term GROUP BY ALL),
    g AS (SELECT DISTINCT lang, source FROM d),
    s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
    p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(s.total, 0) + 2 * l.v) AS p,
        1 + (1000000000::HUGEINT * (k.n + 2)) // (l.total + 2 * l.v) AS q
        FROM g JOIN k ON k.lang = g.lang JOIN l ON l.lang = g.lang LEFT JOIN s ON s.lang = g.lang AND s.source = g.source LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    e AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(e.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN e ON e.lang = a.lang AND e.source = a.source AND e.item = b.source
        UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q),
    y AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM x)
    SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM y WHERE part = 'pair' OR rank <= 10"""
