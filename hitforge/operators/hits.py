"""Hits: filters, best hits of each transcript, pooling by gene, and their counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitforge.functions.names import extract_accessions, hit_source, name_from_title, symbol_from_title
from hitforge.functions.rules import RuleSet
from hitforge.storage import written


def hit_evalue_filter(hits: DataFrame, threshold: float = 1e-5) -> DataFrame:
    """Drops only e-values above the threshold; NaN stays."""
    return hits.filter(F.isnan("evalue") | (F.col("evalue") <= threshold))


def hit_stats(hits: DataFrame, threshold: float = 1e-5) -> DataFrame:
    """One row: hits before and after the e-value filter, distinct queries, and sources of what passes."""
    passes = F.isnan("evalue") | (F.col("evalue") <= threshold)
    source = hit_source(F.col("subject_id"))
    cases = {"filtered_hits": ~passes, "passing_hits": passes, **{f"{s}_hits": passes & (source == s) for s in ("sp", "tr", "other")}}
    # counted by query first, so that distinct queries are rows and no hit is handed on more than once
    by_query = hits.groupBy("transcript_id").agg(F.count(F.lit(1)).alias("total_hits"), *[F.count_if(case).alias(name) for name, case in cases.items()])
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).alias(name)
    return by_query.agg(
        total("total_hits"), total("filtered_hits"), total("passing_hits"),
        F.count("transcript_id").alias("queries_before"), F.count_if(F.col("transcript_id").isNotNull() & (F.col("passing_hits") > 0)).alias("queries_after"),
        total("sp_hits"), total("tr_hits"), total("other_hits"),
    )


def with_names(hits: DataFrame, rules: RuleSet) -> DataFrame:
    """Adds the cleaned name (null if nothing is left) and the valid symbol of each hit."""
    name = rules.clean(name_from_title(F.col("stitle"), F.col("subject_id")))
    return hits.withColumn("name", name).withColumn("symbol", rules.valid_symbol(symbol_from_title(F.col("stitle"))))


def with_transcript_order(hits: DataFrame) -> DataFrame:
    """Adds ``tx_ord``: the place of the transcript's first hit. Goes between the e-value filter and the name filter."""
    return hits.withColumn("tx_ord", F.min("ord").over(Window.partitionBy("transcript_id")))


def with_transcript_place(hits: DataFrame) -> DataFrame:
    """``ord`` becomes the hit's place in its transcript, best hits first: a small number that orders them alike, whatever the file order is made of."""
    return hits.withColumn("ord", F.row_number().over(Window.partitionBy("transcript_id").orderBy(F.col("bitscore").desc(), "ord")))


def filter_hits(hits: DataFrame, rules: RuleSet) -> DataFrame:
    """Cleans names, drops hits without a good name, and blanks bad symbols."""
    return with_names(hits, rules).filter(~rules.is_bad_name(F.col("name")))


def topn_per_transcript(hits: DataFrame, n: int = 30) -> DataFrame:
    """The best hits of each transcript by bitscore, ties by file order; Spark limits ranks before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("transcript_id").orderBy(F.col("bitscore").desc(), "ord"))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= n).drop("rank")


def filter_funnel(hits: DataFrame, rules: RuleSet, n: int = 30) -> DataFrame:
    """One row: hits that come in, survive the name filter, remain after the top n, and transcripts left."""
    good = ~rules.is_bad_name(F.col("name"))
    rows = with_names(hits, rules).select("transcript_id", good.cast("int").alias("good"))
    per = rows.groupBy("transcript_id").agg(F.count(F.lit(1)).alias("all"), F.sum("good").alias("good"))
    return per.agg(
        F.sum("all").alias("hits_in"), F.sum("good").alias("hits_surviving"), F.sum(F.least("good", F.lit(n))).alias("hits_topn"), F.count_if(F.col("good") > 0).alias("transcripts_left")
    )


def transcript_to_gene(hits: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Adds the gene of each transcript, by its last record where ``ord`` tells; an unknown transcript is its own gene."""
    return hits.join(one_value(transcripts, "transcript_id", "gene_id"), "transcript_id", "left").withColumn("gene_id", F.coalesce("gene_id", F.col("transcript_id")))


def gene_hit_index(hits: DataFrame) -> DataFrame:
    """Adds ``hit_idx``, the place in the gene's pool: transcripts in order of their first hit, best hits first."""
    place = F.row_number().over(Window.partitionBy("gene_id").orderBy("tx_ord", F.col("bitscore").desc(), "ord"))
    return hits.withColumn("hit_idx", (place - 1).cast("bigint"))


def dedup_subjects(hits: DataFrame) -> DataFrame:
    """Keeps the best hit where isoforms of one gene share a subject (an option)."""
    rank = F.row_number().over(Window.partitionBy("gene_id", "subject_id").orderBy(F.col("bitscore").desc(), "ord"))
    return hits.withColumn("rank", rank).filter("rank = 1").drop("rank")


def isoform_merge(hits: DataFrame, transcripts: DataFrame, unique_subjects: bool = False) -> DataFrame:
    """Pools the hits of a gene's transcripts, tagged with their transcript."""
    pooled = transcript_to_gene(hits, transcripts)
    return gene_hit_index(dedup_subjects(pooled) if unique_subjects else pooled)


def isoform_merge_by_way(hits: DataFrame, transcripts: DataFrame) -> DataFrame:
    """As ``isoform_merge``, with places in transcripts as ``ord``: hits with their genes are written before they are dealt out by gene.

    What was shuffled up to there is gone by then, and columns take less room than shuffled rows.
    """
    return gene_hit_index(written(transcript_to_gene(with_transcript_place(hits), transcripts)))


def gene_universe_join(genes: DataFrame, annotations: DataFrame) -> DataFrame:
    """Every gene once, without values where it has no hits; genes outside the universe go."""
    return genes.join(annotations, "gene_id", "left")


def gene_hit_counts(hits: DataFrame) -> DataFrame:
    """gene_id, n_total_hits, n_isoforms."""
    return hits.groupBy("gene_id").agg(F.count(F.lit(1)).alias("n_total_hits"), F.countDistinct("transcript_id").alias("n_isoforms"))


def first_seen_genes(transcripts: DataFrame) -> DataFrame:
    """gene_id and the place where it first occurs."""
    return transcripts.groupBy("gene_id").agg(F.min("ord").alias("gene_ord"))


def last_value(rows: DataFrame, key: str, value: str, order: str = "ord") -> DataFrame:
    """One row for each key, with its last value."""
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value))


def one_value(rows: DataFrame, key: str, value: str) -> DataFrame:
    """One row for each key: its last value by ``ord``, or of tables without order its greatest one."""
    return last_value(rows, key, value) if "ord" in rows.columns else rows.groupBy(key).agg(F.max(value).alias(value))


def fasta_stats(transcripts: DataFrame) -> DataFrame:
    """One row: sequences, unique genes, unique transcripts, genes with several sequences, a repeated transcript's included."""
    many = transcripts.groupBy("gene_id").agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("multi_isoform_genes"))
    return transcripts.agg(F.count(F.lit(1)).alias("sequences"), F.countDistinct("gene_id").alias("genes"), F.countDistinct("transcript_id").alias("transcripts")).crossJoin(F.broadcast(many))


def accession_set(hits: DataFrame) -> DataFrame:
    """The distinct candidate keys of all hits."""
    return hits.select("subject_id").distinct().select(F.explode(extract_accessions(F.col("subject_id"))).alias("accession")).distinct()


def combined_hits(*tables: DataFrame) -> DataFrame:
    """Hits of several searches as one table."""
    from functools import reduce

    return reduce(DataFrame.unionByName, tables)
