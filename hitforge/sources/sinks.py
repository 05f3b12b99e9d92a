"""Outputs: maps by gene, the evidence table, and text files in order. Part files are in order; none are merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitforge.functions.names import hit_source, strip_db_prefix
from hitforge.functions.similarity import fmt2

EVIDENCE = ("gene_id", "gene_symbol", "protein_name", "n_isoforms", "n_total_hits", "n_cluster_hits", "winning_cluster_names", "winning_cluster_symbols", "top_hit_sseqid", "top_hit_bitscore", "top_hit_source", "mean_cluster_bitscore", "name_concordance", "symbol_concordance", "go_source", "n_go_terms")


def _text(c: str) -> Column:
    return F.coalesce(c, F.lit(""))


def gene2symbol(annotations: DataFrame) -> DataFrame:
    return annotations.select("gene_id", _text("gene_symbol").alias("gene_symbol")).orderBy("gene_id")


def gene2name(annotations: DataFrame) -> DataFrame:
    return annotations.select("gene_id", strip_db_prefix(_text("protein_name")).alias("protein_name")).orderBy("gene_id")


def gene2go(genes: DataFrame, specific: DataFrame) -> DataFrame:
    """Every gene with its specific terms, sorted and joined by ``;``."""
    terms = specific.groupBy("gene_id").agg(F.array_join(F.array_sort(F.collect_set("go_id")), ";").alias("go_terms"))
    return genes.select("gene_id").join(terms, "gene_id", "left").select("gene_id", _text("go_terms").alias("go_terms")).orderBy("gene_id")


def annotation_evidence(annotations: DataFrame) -> DataFrame:
    """The 16 evidence columns, numbers raw; genes without hits have empty texts and zeros."""
    number = lambda c, kind: F.coalesce(c, F.lit(0)).cast(kind).alias(c)
    joined = lambda c: F.coalesce(F.array_join(c, "|"), F.lit("")).alias(f"winning_cluster_{c}")
    source = hit_source(F.col("top_hit_sseqid"))
    rows = annotations.select(
        "gene_id", _text("gene_symbol").alias("gene_symbol"), strip_db_prefix(_text("protein_name")).alias("protein_name"), number("n_isoforms", "bigint"), number("n_total_hits", "bigint"),
        number("n_cluster_hits", "bigint"), joined("names"), joined("symbols"), _text("top_hit_sseqid").alias("top_hit_sseqid"), number("top_hit_bitscore", "double"),
        F.when(F.coalesce(source, F.lit("other")) == "other", "").otherwise(source).alias("top_hit_source"), number("mean_cluster_bitscore", "double"),
        number("name_concordance", "double"), number("symbol_concordance", "double"), _text("go_source").alias("go_source"), number("n_go_terms", "bigint"),
    )
    return rows.select(*EVIDENCE).orderBy("gene_id")


def formatted(evidence: DataFrame) -> DataFrame:
    """Floats as text with two decimals."""
    return evidence.select(*[fmt2(c).alias(c) if kind == "double" else F.col(c) for c, kind in evidence.dtypes])


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated with a header, without quotes."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("escape", "").option("emptyValue", "").csv(path)


def write_go_map(lines: DataFrame, path: str) -> None:
    """One line for each accession, sorted."""
    lines.orderBy("accession").select(F.concat_ws("\t", "accession", "go_terms").alias("value")).write.mode("overwrite").text(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """Lines in the order of the file that they came from."""
    lines.orderBy("ord").select("value").write.mode("overwrite").text(path)


def renumbered_lines(features: DataFrame) -> DataFrame:
    """(value, ord) of features with new attributes."""
    return features.select(F.concat_ws("\t", "seqid", "source", "ftype", "start", "end", "score", "strand", "phase", "new_attrs").alias("value"), "ord")
