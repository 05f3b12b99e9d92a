"""Reports: coverage, sources of symbols, ontology reduction, concordance, and the summary table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitforge.functions.names import percent
from hitforge.storage import written


def annotation_coverage(annotations: DataFrame) -> DataFrame:
    """One row: genes in all, with hits, name, symbol and terms, and their percentages."""
    has = {"hits": F.col("n_total_hits") > 0, "name": F.col("protein_name") != "", "symbol": F.col("gene_symbol") != "", "go": F.col("n_go_terms") > 0}
    counts = annotations.agg(F.count(F.lit(1)).alias("genes"), *[F.count_if(c).alias(f"genes_with_{k}") for k, c in has.items()])
    return counts.select("*", *[percent(F.col(f"genes_with_{k}"), F.col("genes")).alias(f"percent_{k}") for k in has])


def symbol_source_stats(annotations: DataFrame) -> DataFrame:
    """(symbol_source, genes) for uniprot, ncbi and propagation."""
    source = F.when(F.col("propagated"), "propagation").otherwise(F.col("symbol_source"))
    return annotations.select(source.alias("symbol_source")).filter("symbol_source <> ''").groupBy("symbol_source").agg(F.count(F.lit(1)).alias("genes"))


def go_reduction_stats(terms: DataFrame, specific: DataFrame) -> DataFrame:
    """One row: distinct terms over all genes before and after the reduction, and the percentage that went."""
    before, after = terms.agg(F.countDistinct("go_id").alias("terms_before")), specific.agg(F.countDistinct("go_id").alias("terms_after"))
    gone = F.coalesce(percent(F.col("terms_before") - F.col("terms_after"), F.col("terms_before")), F.lit(0.0))
    return before.crossJoin(F.broadcast(after)).select("terms_before", "terms_after", gone.alias("percent_reduced"))


def exact_medians(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, median): the middle value of each key, or the mean of the two in the middle.

    Values are counted and dealt into ranges in order; from the ranges' sums it is known in which ones the middle places
    fall, and only these are looked into. So no task holds more than a range of the different values.
    """
    counts = rows.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    ranged = written(counts.repartitionByRange(key, value).withColumn("range", F.spark_partition_id()))
    by_range = Window.partitionBy(key).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(key, "range").agg(F.sum("n").alias("of"))
    sums = sums.withColumns({"before": F.coalesce(F.sum("of").over(by_range), F.lit(0)), "all": F.sum("of").over(Window.partitionBy(key))})
    places = F.array(F.floor((F.col("all") - 1) / 2), F.floor(F.col("all") / 2))
    middle = sums.withColumn("place", F.explode(places)).filter("place >= before and place < before + of").select(key, "range", "before", "place")
    inside = Window.partitionBy(key, "range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    near = ranged.join(F.broadcast(middle.select(key, "range").distinct()), [key, "range"], "left_semi")
    near = near.withColumn("inner", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    found = near.join(F.broadcast(middle), [key, "range"]).filter("place >= before + inner and place < before + inner + n")
    return found.groupBy(key).agg(F.avg(value).alias("median"))


def spread(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, mean, median, min, max) of a column for each key; the keys are few."""
    others = rows.groupBy(key).agg(F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"))
    return others.join(F.broadcast(exact_medians(rows, key, value)), key, "left").select(key, "mean", "median", "min", "max")


def concordance_stats(annotations: DataFrame) -> DataFrame:
    """(measure, mean, median, min, max) of name concordance over genes with a name and symbol concordance over genes with a symbol."""
    names = annotations.filter("protein_name <> ''").select(F.lit("name").alias("measure"), F.col("name_concordance").alias("x"))
    symbols = annotations.filter("gene_symbol <> ''").select(F.lit("symbol").alias("measure"), F.col("symbol_concordance").alias("x"))
    return spread(written(names.unionByName(symbols)), "measure", "x")


def cluster_fraction_stats(annotations: DataFrame) -> DataFrame:
    """One row: mean, median, min, max of the winning clusters' shares above 0; nulls without any."""
    rows = written(annotations.filter("cluster_fraction > 0").select(F.lit("cluster").alias("measure"), F.col("cluster_fraction").alias("x")))
    one = annotations.sparkSession.range(1).select(F.lit("cluster").alias("measure"))
    return one.join(F.broadcast(spread(rows, "measure", "x")), "measure", "left").drop("measure")


def ontology_stats(terms: DataFrame) -> DataFrame:
    """(namespace, terms)."""
    return terms.groupBy("namespace").agg(F.count(F.lit(1)).alias("terms"))


def annotation_output_counts(annotations: DataFrame) -> DataFrame:
    """One row: genes that are written with a name or symbol, and all."""
    named = (F.col("protein_name") != "") | (F.col("gene_symbol") != "")
    return annotations.agg(F.count_if(F.coalesce(named, F.lit(False))).alias("annotated"), F.count(F.lit(1)).alias("total"))


def queries_lost(stats: DataFrame) -> DataFrame:
    """One row: queries that have no hit below the e-value threshold, and their percentage, from ``hit_stats``."""
    lost = F.col("queries_before") - F.col("queries_after")
    return stats.select(lost.alias("queries_lost"), percent(lost, F.col("queries_before")).alias("percent_lost"))


def labelled(table: DataFrame, key: str, prefix: str = "") -> DataFrame:
    """(metric, value) of a table with a row for each ``key``: the metric is prefix, key and column."""
    values = [c for c in table.columns if c != key]
    pairs = F.array(*[F.struct(F.concat(F.lit(prefix), F.col(key), F.lit(f"_{c}")).alias("metric"), F.col(c).cast("double").alias("value")) for c in values])
    return table.select(F.explode(pairs).alias("p")).select("p.metric", "p.value")


def run_summary(*tables: DataFrame) -> DataFrame:
    """(metric, value) rows of one-row tables, and of tables that already have this form."""

    def melted(table: DataFrame) -> DataFrame:
        if table.columns == ["metric", "value"]:
            return table
        pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in table.columns])
        return table.select(F.explode(pairs).alias("p")).select("p.metric", "p.value")

    return reduce(DataFrame.unionByName, map(melted, tables))


def summary_text(summary: DataFrame) -> DataFrame:
    """One line of text for each metric."""
    return summary.select(F.concat_ws("\t", "metric", F.col("value").cast("string")).alias("value")).orderBy("value")
