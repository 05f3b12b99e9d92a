"""Secret scans over a trigram inverted index (operator 3), with DataFrame functions only.

Every rule's regular expression gives a Boolean trigram query. The index holds postings for the trigrams that the queries
need, a few rare ones of each alternative: for each block of document ids and trigram the ids whose text has it. Postings
are intersected and united as the queries say, and the candidates are verified on whole texts. A rule without mandatory
trigrams scans every text.

A block has BLOCK ids at most, so a posting is bounded however common its trigram is. Candidates are joined to the
documents by a broadcast only after a count, else by a shuffle.

Edge cases: a null text is empty and has no spans. Rows without an id are verified for every rule that any of them is a
candidate of; so are texts of one id. Spans that start together are in order of their rules. Texts with very many spans
take time in proportion to them, as positions are summed up and texts rewritten in pieces. Repeated rows give repeated
rows. An empty table gives an empty table. Columns asked for by ``keep`` are returned whatever their names, but for one
that is called secret_spans.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitforge.functions.names import bound
from hitforge.llm.trigrams import ANY, Query, thinned, trigram_query
from hitforge.storage import written

BLOCK = 4096
#: Candidate ids with a mask of rules that may be broadcast, after a count (about 48 bytes each); more go through a shuffle join.
BROADCAST_ROWS = 500_000
#: Sums of positions, and code points of a text, that are worked on together.
RUN, PIECE = 256, 16384
#: Stands for a missing id.
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of a pattern; those whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    pattern: str
    base: bool = False
    group: int = 0
    least: int = 0
    any_case: bool = False

    @property
    def java(self) -> str:
        return ("(?i)" if self.any_case else "") + self.pattern


# The three base rules, and public formats of other credentials.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", base=True, group=2, least=6, any_case=True),
    Rule("access", r"AKIA[A-Z0-9]{16,}", base=True),
    Rule("hex", r"[0-9a-f]{24,}", base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """(block, gram, ids) of an index over ``docs(key, text)``, for the trigrams asked for."""
    low = docs.select("key", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    rows = low.select("key", F.explode(held).alias("gram"))
    block = F.floor(F.col("key") / F.lit(BLOCK))
    return rows.groupBy(block.alias("block"), "gram").agg(F.collect_set("key").alias("ids"))


def queries_of(rules: tuple[Rule, ...]) -> list[Query]:
    """The trigram query of each rule, with few trigrams in all."""
    return thinned([trigram_query(rule.pattern) for rule in rules])


def candidates(index: DataFrame, queries: list[Query]) -> DataFrame:
    """(key, mask): for each document the rules whose trigram query its postings satisfy, as bits."""
    none = F.array().cast("array<bigint>")
    lists = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("gram", "ids"))).alias("of"))
    found = []
    for i, query in enumerate(queries):
        if query != ANY:
            each = [reduce(F.array_intersect, [F.coalesce(F.col("of")[g], none) for g in sorted(grams)]) for grams in sorted(query, key=sorted)]
            found.append(F.struct(F.lit(1 << i).cast("bigint").alias("bit"), reduce(F.array_union, each).alias("ids")))
    rows = lists.select(F.explode(F.array(*found)).alias("r")).select("r.bit", F.explode("r.ids").alias("key"))
    return rows.groupBy("key").agg(F.bit_or("bit").alias("mask"))


def running(lengths: Column) -> Column:
    """Running sums of an array of numbers, in runs of RUN, so that no long array is copied for each element."""

    def summed(numbers: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        add = lambda state, n: F.struct((state["at"] + n).alias("at"), F.concat(state["out"], F.array(state["at"] + n)).alias("out"))
        return F.aggregate(numbers, zero, add, lambda state: state["out"])

    def of_array(numbers: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(numbers), F.lit(RUN)), lambda i: summed(F.slice(numbers, i, F.lit(RUN))))
        return bound(runs, lambda r: F.flatten(F.zip_with(r, bound(summed(F.transform(r, lambda x: F.element_at(x, -1))), lambda ends: ends), lambda x, end: F.transform(x, lambda n: n + end - F.element_at(x, -1)))))

    return bound(lengths, lambda n: F.when(F.size(n) > 0, of_array(n)).otherwise(F.array().cast("array<int>")))


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """The rule's spans in a text, as an array of (start, rank of the kind, end, kind) in code points.

    Matches and the pieces between them alternate, so running sums of their lengths give the positions.
    """
    pattern = F.lit(rule.java)
    between, whole = F.split(text, rule.java, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    checked = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    numbers = F.zip_with(F.transform(between, lambda x: F.length(x)), F.zip_with(whole, checked, lambda hit, group: F.struct(F.length(hit).alias("hit"), F.length(group).alias("group"))), lambda gap, hit: F.struct(gap.alias("gap"), hit["hit"].alias("hit"), hit["group"].alias("group")))

    def spans(rows: Column) -> Column:
        ends = running(F.transform(rows, lambda r: r["gap"] + F.coalesce(r["hit"], F.lit(0))))
        made = F.zip_with(rows, ends, lambda r, end: F.struct((end - r["hit"]).alias("start"), F.lit(order).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"), r["group"].alias("group")))
        # what stands behind the last match has no match of its own
        good = F.filter(made, lambda s: s["start"].isNotNull() & (s["group"] >= rule.least))
        return F.transform(good, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))

    return bound(numbers, spans)


def find_secrets(docs: DataFrame, text: str = "text", id_col: str = "doc_id", rules: tuple[Rule, ...] = RULES, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (id_col unless given) and ``secret_spans``: array of (start, rank, end, kind), sorted."""
    keep = keep or [id_col]
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("kept"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    queries = queries_of(rules)
    grams = sorted({g for query in queries for grams in query for g in grams})
    if grams:
        hits = written(candidates(postings(rows, grams), queries))
        hits = F.broadcast(hits) if hits.count() <= BROADCAST_ROWS else hits
        rows = rows.join(hits, "key", "left")
    else:
        rows = rows.withColumn("mask", F.lit(None).cast("bigint"))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    spans = []
    for i, rule in enumerate(rules):
        # a cheap search comes before positions are worked out
        may = F.col("mask").bitwiseAND(1 << i) != 0 if queries[i] != ANY else F.lit(True)
        spans.append(F.when(F.coalesce(may, F.lit(False)) & F.col("text").rlike(rule.java), rule_spans(F.col("text"), rule, i)).otherwise(none))
    return rows.select("kept.*", F.array_sort(F.concat(*spans)).alias("secret_spans"))


def redact(docs: DataFrame, spans: str, text: str, mask: str = "[SECRET]") -> DataFrame:
    """Replaces what sorted spans cover, overlapping ones together, by a mask; a null text stays null.

    A text is cut into pieces of PIECE code points; a mask stands in the piece in which its span starts.
    """

    def rewritten(piece: Column, number: Column) -> Column:
        low = number * PIECE
        inside = F.filter(spans, lambda s: (s["start"] >= low) & (s["start"] < low + PIECE))
        begin = F.aggregate(F.filter(spans, lambda s: s["start"] < low), low, lambda at, s: F.greatest(at, s["end"]))

        def add(state: Column, span: Column) -> Column:
            gap = F.substr(piece, state["at"] - low + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
            new = F.when(span["start"] >= state["at"], F.concat(state["out"], gap, F.lit(mask))).otherwise(state["out"])
            return F.struct(F.greatest(state["at"], span["end"]).alias("at"), new.alias("out"))

        return F.aggregate(inside, F.struct(begin.alias("at"), F.lit("").alias("out")), add, lambda s: F.concat(s["out"], F.substr(piece, s["at"] - low + 1)))

    pieces = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    return docs.withColumn(text, F.when(F.size(spans) > 0, F.array_join(F.transform(pieces, rewritten), "")).otherwise(F.col(text)))


def digests(found: DataFrame, id_col: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""
    base = [r.kind for r in rules if r.base]

    def said(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    spans = F.col("secret_spans")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in base]
    own = F.filter(spans, lambda s: s["kind"].isin(base))
    return found.select(id_col, *counts, F.sha2(said(own), 256).alias("base_sha256"), said(spans).alias("spans"))


def oracle_sql() -> str:
    """The result of ``digests`` as DuckDB SQL, by plain scans."""

    def any_case(words: str) -> str:
        return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)

    parts, counts = [], []
    for i, rule in enumerate(RULES):
        pattern = rule.pattern
        if rule.any_case:  # written out, as (?i) there also folds beyond ASCII
            names, rest = pattern[1:].split(")", 1)
            pattern = "(" + any_case(names) + ")" + rest
        quoted = "'" + pattern.replace("'", "''") + "'"
        parts.append(
            f"""SELECT doc_id, unnest(list_zip(range(1, len(m) + 1), m, g)) AS z, p, m AS ms, {i} AS r, '{rule.kind}' AS k, {rule.least} AS least
            FROM (SELECT doc_id, string_split_regex(t, {quoted}) AS p, regexp_extract_all(t, {quoted}) AS m, regexp_extract_all(t, {quoted}, {rule.group}) AS g
                  FROM d WHERE regexp_matches(t, {quoted}))"""
        )
        if rule.base:
            counts.append(f"count(*) FILTER (k = '{rule.kind}') AS n_{rule.kind}")
    total = "coalesce(list_sum(list_transform({}, lambda x: length(x))), 0)"
    base = ", ".join(f"'{r.kind}'" for r in RULES if r.base)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    m AS ({" UNION ALL ".join(parts)}),
    s AS (SELECT doc_id, r, k, {total.format("p[1:z[1]]")} + {total.format("ms[1:z[1] - 1]")} AS a, length(z[2]) AS n FROM m WHERE length(z[3]) >= least),
    c AS (SELECT doc_id, {", ".join(counts)},
            coalesce(string_agg(concat(k, ':', CAST(a AS BIGINT), ':', CAST(a + n AS BIGINT)), ',' ORDER BY a, r) FILTER (k IN ({base})), '') AS b,
            string_agg(concat(k, ':', CAST(a AS BIGINT), ':', CAST(a + n AS BIGINT)), ',' ORDER BY a, r) AS spans
          FROM s GROUP BY doc_id)
    SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in RULES if r.base)},
           sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN c ON d.doc_id = c.doc_id"""
