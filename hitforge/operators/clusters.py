"""Average-linkage clusters of a gene's hits, their scores, and the choice of name and symbol."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitforge.functions.names import extract_accessions, normalize_name
from hitforge.functions.rules import RuleSet
from hitforge.functions.similarity import TILE, Labels, tiled
from hitforge.operators.graphs import connected
from hitforge.operators.hits import one_value
from hitforge.operators.linkage import joined_pairs, linkage
from hitforge.operators.lots import clusters_of_genes
from hitforge.storage import written

#: Hits of a gene that is clustered whole; of a larger gene its parts that can merge are one task each.
LARGE = 4096


def cluster_hits(hits: DataFrame, threshold: float = 0.5, max_hits: int | None = None, large: int = LARGE, tile: int = TILE, counted: DataFrame | None = None) -> DataFrame:
    """Adds cluster_id (the smallest index in it) and member_pos (the place in order of merging).

    Hits are dealt out by gene once, or not at all where they are already, and a task clusters its genes in lots, a batch of
    rows at a time. Large genes are told by ``counted``, where ``hits`` aren't a written table: one that has as many rows of
    each gene, or more. Two clusters merge only
    if a pair of their hits reaches the threshold, so that parts of a gene which no such pair connects are clustered apart, with
    the same result: of genes of more than ``large`` hits the pairs are looked at in tiles of their different hits, and every
    connected part is a task. ``max_hits`` leaves out hits and is off unless asked for.
    """
    if max_hits:
        hits = hits.filter(F.col("hit_idx") < max_hits)
    many = written((hits if counted is None else counted).groupBy("gene_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > large).select("gene_id"))
    some = not many.isEmpty()
    if some and counted is not None:
        hits = written(hits)
    index = F.col("hit_idx").cast("bigint").alias("hit_idx")
    rows = hits.select("gene_id", index, *[c for c in hits.columns if c not in ("gene_id", "hit_idx")])
    texts = {"_name": F.coalesce(normalize_name(F.col("name")), F.lit("")), "_symbol": F.lower(F.coalesce("symbol", F.lit("")))}
    added = [T.StructField("cluster_id", T.LongType()), T.StructField("member_pos", T.LongType())]
    # a window, as it leaves hits where they are if they are dealt out by gene
    place = F.row_number().over(Window.partitionBy("gene_id").orderBy("hit_idx"))
    of_gene = (rows.join(many, "gene_id", "left_anti") if some else rows).withColumns(texts).withColumn("_at", place).sortWithinPartitions("gene_id", "hit_idx")
    out = of_gene.mapInArrow(_in_lots(threshold), T.StructType([*rows.schema, *added]))
    if some:
        hot = written(rows.join(many, "gene_id", "left_semi").withColumns(texts).select("gene_id", "hit_idx", "_name", "_symbol"))
        parts = hot.join(connected_parts(hot, threshold, tile), ["gene_id", "_name", "_symbol"])
        labels = parts.groupBy("gene_id", "part").applyInArrow(_labels(threshold), T.StructType([*hot.schema[:2], *added]))
        out = out.unionByName(rows.join(labels, ["gene_id", "hit_idx"]))
    return out


def connected_parts(hits: DataFrame, threshold: float, tile: int = TILE) -> DataFrame:
    """(gene_id, _name, _symbol, part): which different hits of a gene are connected by pairs that reach the threshold.

    A tile of a gene's pairs gives edges of a spanning forest only, so that there are fewer than two for each of its hits.
    """
    kinds = hits.groupBy("gene_id", "_name", "_symbol").agg(F.min("hit_idx").alias("first"), F.max("hit_idx").alias("last"))
    place = F.row_number().over(Window.partitionBy("gene_id").orderBy("first")) - 1
    kinds = written(kinds.withColumn("place", place).withColumn("node", F.monotonically_increasing_id()))

    def forest(key: tuple, table: pa.Table) -> pa.Table:
        node, own, first, last = (table.column(c).to_numpy() for c in ("node", "own", "first", "last"))
        labels = Labels(table.column("_name").to_pylist(), table.column("_symbol").to_pylist())
        a, b = np.flatnonzero(own == key[1].as_py()), np.flatnonzero(own == key[2].as_py())
        found = joined_pairs(labels, a, b, first, last, threshold)
        return pa.table([pa.array(node[[u for u, _ in found]], pa.int64()), pa.array(node[[v for _, v in found]], pa.int64())], names=["u", "v"])

    edges = tiled(kinds, "place", tile).groupBy("gene_id", "tile_i", "tile_j").applyInArrow(forest, "u bigint, v bigint")
    parts = connected(edges).withColumnRenamed("component", "part")
    return kinds.join(parts, "node", "left").select("gene_id", "_name", "_symbol", F.coalesce("part", "node").alias("part"))


def _in_lots(threshold: float):
    """Clusters the genes of sorted batches; the rows of a batch's last gene wait for the next one."""

    def of_rows(rows: pa.Table, starts: np.ndarray) -> pa.Table:
        encoded = [rows.column(c).combine_chunks().dictionary_encode() for c in ("_name", "_symbol")]
        texts = [(c.dictionary.to_pylist(), c.indices.to_numpy().astype(np.int64)) for c in encoded]
        first, place = clusters_of_genes(starts, *texts, threshold)
        index = rows.column("hit_idx").to_numpy()
        return rows.drop_columns(["_name", "_symbol", "_at"]).append_column("cluster_id", pa.array(index[first])).append_column("member_pos", pa.array(place))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in chain(batches, [None]):
            rows = held if batch is None else pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            if rows is None or not len(rows):
                continue
            gene = rows.column("gene_id").combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(np.diff(gene)) + 1, [len(rows)]])
            if batch is not None:
                starts = starts[:-1]
            held = rows.slice(starts[-1])
            if starts[-1]:
                yield from of_rows(rows.slice(0, starts[-1]), starts).to_batches()

    return of_batches


def _labels(threshold: float):
    def of_rows(table: pa.Table) -> pa.Table:
        rows = table.sort_by("hit_idx")
        index = rows.column("hit_idx").to_numpy()
        made = linkage(rows.column("_name").to_pylist(), rows.column("_symbol").to_pylist(), threshold)
        hit = np.array([i for c in made for i in c], np.int64)
        first, places = np.repeat([c[0] for c in made], [len(c) for c in made]), np.concatenate([np.arange(len(c)) for c in made])
        # all rows are of one gene
        return pa.table([rows.column("gene_id"), pa.array(index[hit]), pa.array(index[first]), pa.array(places)], names=["gene_id", "hit_idx", "cluster_id", "member_pos"])

    return of_rows


def _mean_bits():
    """Mean bitscore from an exact sum, so that it doesn't depend on the order of rows."""
    return F.sum(F.col("bitscore").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))


def cluster_scores(clustered: DataFrame) -> DataFrame:
    """gene_id, cluster_id, n, score: summed bitscore, times the root of the size, times a bonus for isoforms."""
    sums = clustered.groupBy("gene_id", "cluster_id").agg(
        F.sum(F.col("bitscore").cast("decimal(18,2)")).cast("double").alias("bits"), F.count(F.lit(1)).alias("n"), F.countDistinct("transcript_id").alias("isoforms")
    )
    return sums.select("gene_id", "cluster_id", "n", _score(F.col("bits"), F.col("n"), F.col("isoforms")).alias("score"))


def _score(bits: Column, n: Column, isoforms: Column) -> Column:
    return bits * F.sqrt(n) * (1 + 0.1 * (isoforms - 1))


def winning_cluster(clustered: DataFrame) -> DataFrame:
    """The best cluster of each gene, the first on a tie, with its share of the gene's hits."""
    scores = cluster_scores(clustered)
    place = F.row_number().over(Window.partitionBy("gene_id").orderBy(F.col("score").desc(), "cluster_id"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("gene_id"))
    return scores.withColumn("place", place).withColumn("fraction", share).filter("place = 1").select("gene_id", "cluster_id", "n", "score", "fraction")


def winning_hits(clustered: DataFrame) -> DataFrame:
    """The hits of the winning clusters: the scores of ``cluster_scores`` over windows, so that hits are dealt out by gene once, or not at all where they are already."""
    gene, cluster = Window.partitionBy("gene_id"), Window.partitionBy("gene_id", "cluster_id")
    # a window by gene goes first, so that the hits lie right for the others
    behind = gene.orderBy("cluster_id", "transcript_id", "hit_idx")
    again = (F.lag("cluster_id").over(behind) == F.col("cluster_id")) & (F.lag("transcript_id").over(behind) == F.col("transcript_id"))
    rows = clustered.withColumn("_new", (F.col("transcript_id").isNotNull() & ~F.coalesce(again, F.lit(False))).cast("int"))
    sums = {"_bits": F.sum(F.col("bitscore").cast("decimal(18,2)")), "_n": F.count(F.lit(1)), "_isoforms": F.sum("_new")}
    rows = rows.withColumns({c: of.over(cluster) for c, of in sums.items()})
    best = F.max(F.struct(_score(F.col("_bits").cast("double"), F.col("_n"), F.col("_isoforms")).alias("score"), (-F.col("cluster_id")).alias("first"))).over(gene)
    return rows.withColumn("_best", best).filter(F.col("cluster_id") == -F.col("_best.first")).drop("_new", "_bits", "_n", "_isoforms", "_best")


def cluster_summary(clustered: DataFrame, won: DataFrame | None = None) -> DataFrame:
    """For each winning cluster: n_cluster_hits, cluster_fraction, mean_cluster_bitscore, names and symbols in member order.

    ``won`` are the hits of the winning clusters, if they are known already.
    """
    won = winning_hits(clustered) if won is None else won
    members = F.sort_array(F.collect_list(F.struct("member_pos", "name", "symbol")))
    rows = won.groupBy("gene_id").agg(F.count(F.lit(1)).alias("n_cluster_hits"), _mean_bits().alias("mean_cluster_bitscore"), members.alias("m"))
    rows = rows.join(clustered.groupBy("gene_id").agg(F.count(F.lit(1)).alias("of")), "gene_id")
    symbols = F.filter(F.transform("m", lambda x: x["symbol"]), lambda s: s != "")
    return rows.select("gene_id", "n_cluster_hits", (F.col("n_cluster_hits") / F.col("of")).alias("cluster_fraction"), "mean_cluster_bitscore", F.col("m.name").alias("names"), symbols.alias("symbols"))


def symbol_group_scores(won: DataFrame) -> DataFrame:
    """gene_id, symbol_key, n, mean_bitscore, first_pos of each symbol in winning clusters, whatever its case."""
    rows = won.filter("symbol <> ''").withColumn("symbol_key", F.lower("symbol"))
    return rows.groupBy("gene_id", "symbol_key").agg(F.count(F.lit(1)).alias("n"), _mean_bits().alias("mean_bitscore"), F.min("member_pos").alias("first_pos"))


def winning_symbol_group(won: DataFrame) -> DataFrame:
    """gene_id, symbol_key of the best symbol: single hits only if there is nothing else, and no lone symbol among many hits."""
    gene = Window.partitionBy("gene_id")
    groups = symbol_group_scores(won).withColumn("many", F.max((F.col("n") >= 2).cast("int")).over(gene))
    groups = groups.filter("many = 0 or n >= 2")
    place = F.row_number().over(gene.orderBy(F.col("mean_bitscore").desc(), "first_pos"))
    best = groups.withColumn("place", place).filter("place = 1")
    sizes = won.groupBy("gene_id").agg(F.count(F.lit(1)).alias("size"))
    return best.join(sizes, "gene_id").filter("not (n = 1 and size >= 10 and n / size < 0.1)").select("gene_id", "symbol_key")


def symbol_group_hits(won: DataFrame) -> DataFrame:
    """The hits of the winning symbol group, or of the whole cluster where no symbol wins; ``by_symbol`` tells which."""
    groups = winning_symbol_group(won)
    joined = won.join(groups, "gene_id", "left")
    return joined.filter(F.col("symbol_key").isNull() | (F.lower("symbol") == F.col("symbol_key"))).withColumn("by_symbol", F.col("symbol_key").isNotNull()).drop("symbol_key")


def best_hit(hits: DataFrame, key: str = "gene_id") -> DataFrame:
    """The hit with the highest bitscore of each group, the first in member order on a tie."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.col("bitscore").desc(), "member_pos"))
    return hits.withColumn("place", place).filter("place = 1").drop("place")


def top_hits(hits: DataFrame, n: int = 5) -> DataFrame:
    """The n best hits of each gene's group."""
    place = F.row_number().over(Window.partitionBy("gene_id").orderBy(F.col("bitscore").desc(), "member_pos"))
    return hits.withColumn("place", place).filter(F.col("place") <= n)


def xref_symbol(accessions: DataFrame, id_map: DataFrame, gene_info: DataFrame, every: bool = False) -> DataFrame:
    """Adds the symbol behind each accession by way of its gene id; empty where there is none.

    The last line of a key counts. With ``every`` all lines do, and an accession gives a row for each of them.
    """
    if not every:
        id_map, gene_info = one_value(id_map, "accession", "gene_id"), one_value(gene_info, "gene_id", "symbol")
    found = symbol_lines(id_map, gene_info).drop("line")
    return accessions.join(found, "accession", "left").withColumn("ncbi_symbol", F.coalesce("ncbi_symbol", F.lit("")))


def symbol_lines(id_map: DataFrame, gene_info: DataFrame) -> DataFrame:
    """(accession, line, ncbi_symbol) of every line of ``id_map``: null where the gene has no symbol. ``line`` is in order of both tables."""
    place = lambda table, value: F.col("ord" if "ord" in table.columns else value)
    ids = id_map.select("accession", F.col("gene_id").alias("ncbi_id"), place(id_map, "gene_id").alias("_of"))
    info = gene_info.select(F.col("gene_id").alias("ncbi_id"), F.col("symbol").alias("ncbi_symbol"), place(gene_info, "symbol").alias("_at"))
    return ids.join(info, "ncbi_id", "left").select("accession", F.struct("_of", "_at").alias("line"), "ncbi_symbol")


def xref_first_valid_symbol(hits: DataFrame, id_map: DataFrame, gene_info: DataFrame, rules: RuleSet, every: bool = False) -> DataFrame:
    """gene_id and the first candidate key's symbol that is not empty and not bad.

    With ``every`` a key has such a symbol if any of its lines has one, of several the last line's; else its last line alone counts.
    """
    keys = hits.select("gene_id", F.posexplode(extract_accessions(F.col("subject_id"))).alias("pos", "accession"))
    if every:
        lines = symbol_lines(id_map, gene_info).filter(~rules.is_bad_symbol(F.col("ncbi_symbol")))
        good = keys.join(lines.groupBy("accession").agg(F.max_by("ncbi_symbol", "line").alias("ncbi_symbol")), "accession")
    else:
        good = xref_symbol(keys, id_map, gene_info).filter(~rules.is_bad_symbol(F.col("ncbi_symbol")))
    return good.groupBy("gene_id").agg(F.min_by("ncbi_symbol", "pos").alias("xref_symbol"))


def select_name_symbol(won: DataFrame, rules: RuleSet, id_map: DataFrame | None = None, gene_info: DataFrame | None = None, every: bool = False) -> DataFrame:
    """gene_id, protein_name, gene_symbol (lower case) and symbol_source.

    A symbol by cross-reference counts as ``uniprot`` where any hit of the cluster has a symbol, as the reports count it.
    ``every`` is handed on to ``xref_first_valid_symbol``.
    """
    best = best_hit(symbol_group_hits(won)).select("gene_id", F.col("name").alias("protein_name"), F.when(F.col("by_symbol"), F.col("symbol")).otherwise("").alias("own"), "by_symbol", "subject_id")
    if id_map is not None and gene_info is not None:
        found = xref_first_valid_symbol(best.filter(~F.col("by_symbol")), id_map, gene_info, rules, every)
        best = best.join(found, "gene_id", "left")
    else:
        best = best.withColumn("xref_symbol", F.lit(None).cast("string"))
    has = won.groupBy("gene_id").agg(F.max((F.col("symbol") != "").cast("int")).alias("has"))
    symbol = F.lower(F.when(F.col("by_symbol"), F.col("own")).otherwise(F.coalesce("xref_symbol", F.lit(""))))
    source = F.when(symbol == "", "").when(F.col("has") == 1, "uniprot").otherwise("ncbi")
    return best.join(has, "gene_id").select("gene_id", "protein_name", symbol.alias("gene_symbol"), source.alias("symbol_source"))
