"""The whole annotation: hits, genes and reference tables in, one row for each gene out."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitforge.functions.rules import DEFAULT, RuleSet
from hitforge.operators import clusters, hits, ontology, propagation, refdata
from hitforge.storage import written


@dataclass(frozen=True)
class Params:
    """Thresholds of a run."""

    evalue: float = 1e-5
    top_n: int = 30
    consensus: float = 0.5
    namespaces: tuple[str, ...] = ("BP", "MF", "CC")
    unique_subjects: bool = False
    rules: RuleSet = field(default=DEFAULT)


@dataclass(frozen=True)
class References:
    """Lookup tables; none of them is needed."""

    go_map: DataFrame | None = None
    id_map: DataFrame | None = None
    gene_info: DataFrame | None = None
    terms: DataFrame | None = None
    edges: DataFrame | None = None


def _good(raw: DataFrame, params: Params) -> DataFrame:
    """Names are cleaned before hits are shuffled, so that no title is; those without a good name go after it, as they count for the order."""
    named = hits.with_names(hits.hit_evalue_filter(raw, params.evalue), params.rules).drop("stitle")
    return hits.with_transcript_order(named).filter(~params.rules.is_bad_name(F.col("name")))


def selected_hits(raw: DataFrame, transcripts: DataFrame, params: Params) -> DataFrame:
    """Filtered, best hits of each transcript, pooled by gene and indexed."""
    best = hits.topn_per_transcript(_good(raw, params), params.top_n)
    return hits.isoform_merge(best, transcripts, params.unique_subjects)


def best_of_genes(raw: DataFrame, transcripts: DataFrame, params: Params) -> DataFrame:
    """The hits of ``selected_hits`` before they are pooled: with their genes, their places in their transcripts as ``ord``, and what later steps read.

    Where subjects are to be unique, the file order stays, as it decides between transcripts.
    """
    good = _good(raw, params)
    best = hits.topn_per_transcript(good, params.top_n) if params.unique_subjects else hits.with_transcript_place(good).filter(F.col("ord") <= params.top_n)
    return hits.transcript_to_gene(best.select("transcript_id", "subject_id", "bitscore", "name", "symbol", "tx_ord", "ord"), transcripts)


def pooled(best: DataFrame, params: Params) -> DataFrame:
    """The pool of ``selected_hits`` from ``best_of_genes``."""
    return hits.gene_hit_index(hits.dedup_subjects(best) if params.unique_subjects else best).drop("ord", "tx_ord")


def wanted_references(refs: References, won: DataFrame) -> References:
    """The lookup tables reduced to the keys of the winning hits, which is all that is looked up."""
    if refs.go_map is None and refs.id_map is None:
        return refs
    keys = written(hits.accession_set(won))
    go_map = refs.go_map if refs.go_map is None else refdata.wanted(refs.go_map, keys, "accession")
    if refs.id_map is None or refs.gene_info is None:
        return replace(refs, go_map=go_map)
    id_map = refdata.wanted(refs.id_map, keys, "accession")
    return replace(refs, go_map=go_map, id_map=id_map, gene_info=refdata.wanted(refs.gene_info, id_map, "gene_id"))


def annotate(raw: DataFrame, transcripts: DataFrame, genes: DataFrame, refs: References | None = None, params: Params | None = None) -> DataFrame:
    """One row for each of ``genes(gene_id, gene_ord)``: name, symbol, counts, concordance, terms and evidence.

    The best hits with their genes and the clustered hits are written once, and the latter are read by every later step. Between
    them hits are dealt out by gene once.
    """
    refs, params = refs or References(), params or Params()
    best = written(best_of_genes(raw, transcripts, params).join(genes.select("gene_id"), "gene_id", "left_semi"))
    clustered = written(clusters.cluster_hits(pooled(best, params), params.consensus, counted=best))
    won = written(clusters.winning_hits(clustered))
    refs = wanted_references(refs, won)
    chosen = written(clusters.select_name_symbol(won, params.rules, refs.id_map, refs.gene_info))
    first = propagation.propagate_symbols(chosen.join(genes.select("gene_id", "gene_ord"), "gene_id"))
    final = written(first.drop("gene_ord"))
    top = clusters.best_hit(clusters.symbol_group_hits(won)).select("gene_id", F.col("subject_id").alias("top_hit_sseqid"), F.col("bitscore").alias("top_hit_bitscore"))
    parts = [
        final, hits.gene_hit_counts(clustered), clusters.cluster_summary(clustered, won), top,
        propagation.name_concordance(clustered, final, params.consensus), propagation.symbol_concordance(clustered, final),
    ]
    if refs.go_map is not None and refs.terms is not None and refs.edges is not None:
        terms, specific, labels = ontology.gene_go_terms(won, chosen, refs.go_map, refs.terms, ontology.ancestor_index(refs.edges), params.namespaces, params.consensus)
        counts = specific.groupBy("gene_id").agg(F.count(F.lit(1)).alias("n_go_terms"), F.array_sort(F.collect_set("go_id")).alias("specific_go_terms"))
        all_terms = terms.groupBy("gene_id").agg(F.array_sort(F.collect_set("go_id")).alias("go_terms"))
        parts += [labels, counts, all_terms]
    out = genes
    for part in parts:
        out = out.join(part, "gene_id", "left")
    blank = {c: "" for c in ("gene_symbol", "protein_name", "symbol_source", "go_source") if c in out.columns}
    zero = {c: 0 for c in ("n_total_hits", "n_isoforms", "n_cluster_hits", "cluster_fraction", "mean_cluster_bitscore", "name_concordance", "symbol_concordance", "n_go_terms") if c in out.columns}
    return out.fillna(blank).fillna(zero).fillna({"propagated": False})
