"""Symbols from genes with equal names, and concordance of choices with all hits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitforge.functions.names import normalize_name
from hitforge.functions.similarity import name_similarity


def majority_symbol(annotations: DataFrame, order: str = "gene_ord") -> DataFrame:
    """(norm, best_symbol): the most frequent symbol of each normalised name, the first seen on a tie."""
    rows = annotations.filter("protein_name <> '' and gene_symbol <> ''").withColumn("norm", normalize_name(F.col("protein_name")))
    counts = rows.groupBy("norm", "gene_symbol").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    place = F.row_number().over(Window.partitionBy("norm").orderBy(F.col("n").desc(), "first"))
    return counts.withColumn("place", place).filter("place = 1").select("norm", F.col("gene_symbol").alias("best_symbol"))


def propagate_symbols(annotations: DataFrame, order: str = "gene_ord") -> DataFrame:
    """Fills empty symbols from genes of the same name; ``propagated`` marks them."""
    named = annotations.withColumn("norm", F.when(F.coalesce("protein_name", F.lit("")) != "", normalize_name(F.col("protein_name"))))
    joined = named.join(majority_symbol(annotations, order), "norm", "left")
    empty = F.coalesce(F.col("gene_symbol"), F.lit("")) == ""
    filled = empty & F.col("best_symbol").isNotNull()
    return joined.withColumn("propagated", filled).withColumn("gene_symbol", F.when(filled, F.col("best_symbol")).otherwise(F.coalesce("gene_symbol", F.lit("")))).drop("norm", "best_symbol")


def symbol_concordance(hits: DataFrame, chosen: DataFrame) -> DataFrame:
    """(gene_id, symbol_concordance): share of all of a gene's hits whose symbol is the chosen one, whatever the case."""
    joined = hits.join(chosen.filter("gene_symbol <> ''").select("gene_id", "gene_symbol"), "gene_id")
    same = F.coalesce((F.col("symbol") != "") & (F.lower("symbol") == F.lower("gene_symbol")), F.lit(False))
    return joined.groupBy("gene_id").agg(F.avg(same.cast("int")).alias("symbol_concordance"))


def name_concordance(hits: DataFrame, chosen: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(gene_id, name_concordance): share of all of a gene's hits whose name is like the chosen one."""
    joined = hits.join(chosen.filter("protein_name <> ''").select("gene_id", normalize_name(F.col("protein_name")).alias("_x")), "gene_id")
    scored = name_similarity(joined.withColumn("_y", normalize_name(F.col("name"))), "_x", "_y")
    return scored.groupBy("gene_id").agg(F.avg((F.col("similarity") >= threshold).cast("int")).alias("name_concordance"))
