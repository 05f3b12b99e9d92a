"""Ontology terms: closure, normal ids, namespaces, most specific terms, and the terms of a gene."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitforge.functions.names import extract_accessions, normalize_name
from hitforge.functions.similarity import name_similarity
from hitforge.operators.clusters import symbol_group_hits, top_hits
from hitforge.storage import written

#: Short and long names of namespaces.
NAMESPACES = {"BP": "biological_process", "MF": "molecular_function", "CC": "cellular_component"}
#: Terms with their ancestors that may be broadcast, after a count of the ancestors (about 20 bytes each).
BROADCAST_ANCESTORS = 2_000_000
#: Hits whose terms one task makes distinct.
TASK_HITS = 250_000


def ancestor_index(edges: DataFrame) -> DataFrame:
    """(go_id, above), written: one row for each term that has ancestors, with all of them, in rounds of doubled lengths.

    After k rounds ``above`` has what is up to 2**k edges away and ``reach`` what is just that far. A round appends the lists
    of the terms in ``reach``, so that a term is dealt out once a round, not once for each of its ancestors. A round without
    new ancestors ends it, on cycles too: a pair that is further apart than 2**k has one on its way that is just one edge further.
    """
    first = F.collect_set("parent")
    index = written(edges.groupBy(F.col("child").alias("go_id")).agg(first.alias("above"), first.alias("reach")))
    while True:
        further = index.select(F.col("go_id").alias("by"), F.col("above").alias("_above"), F.col("reach").alias("_reach"))
        met = index.select("go_id", F.explode("reach").alias("by")).join(further, "by").groupBy("go_id")
        met = met.agg(*[F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("_above", "_reach")])
        above = F.when(F.col("_above").isNull(), F.col("above")).otherwise(F.array_union("above", "_above"))
        reach = F.coalesce("_reach", F.slice("reach", 1, 0))
        grown = index.join(met, "go_id", "left").select("go_id", above.alias("all"), reach.alias("reach"), F.size("above").alias("_n"))
        round_ = written(grown.withColumn("grew", F.size("all") > F.col("_n")).drop("_n"))
        index = round_.select("go_id", F.col("all").alias("above"), "reach")
        if round_.filter("grew").isEmpty():
            return index.drop("reach")


def closure(edges: DataFrame) -> DataFrame:
    """(ancestor, descendant) over all paths."""
    return ancestor_index(edges).select(F.explode("above").alias("ancestor"), F.col("go_id").alias("descendant"))


def ancestors(edges: DataFrame) -> DataFrame:
    """(id, ancestor)."""
    return closure(edges).select(F.col("descendant").alias("id"), "ancestor")


def descendants(edges: DataFrame) -> DataFrame:
    """(id, descendant)."""
    return closure(edges).select(F.col("ancestor").alias("id"), "descendant")


def alt_id_join(terms: DataFrame, primary: DataFrame, alt_ids: DataFrame) -> DataFrame:
    """Replaces ``go_id`` by the primary id: primary ids stay, alternative ones are mapped, unknown ones go."""
    known = primary.select(F.col("id").alias("p"))
    alt = alt_ids.select(F.col("alt_id").alias("a"), F.col("id").alias("of"))
    joined = terms.join(known, terms["go_id"] == F.col("p"), "left").join(alt, terms["go_id"] == F.col("a"), "left")
    return joined.withColumn("go_id", F.coalesce("p", "of")).filter(F.col("go_id").isNotNull()).drop("p", "a", "of").distinct()


def namespace_filter(terms: DataFrame, primary: DataFrame, namespaces: tuple[str, ...] = ("BP", "MF", "CC")) -> DataFrame:
    """Terms whose namespace is one of those named; terms without one go."""
    wanted = [NAMESPACES.get(n, n) for n in namespaces]
    good = primary.filter(F.col("namespace").isin(wanted)).select(F.col("id").alias("go_id"))
    return terms.join(good, "go_id", "left_semi")


def ancestor_lists(paths: DataFrame) -> DataFrame:
    """(go_id, above): one row for each term that has ancestors, with all of them in order."""
    return paths.groupBy(F.col("descendant").alias("go_id")).agg(F.array_sort(F.collect_set("ancestor")).alias("above"))


def specific_intersection(terms: DataFrame, paths: DataFrame, key: str = "gene_id") -> DataFrame:
    """(key, go_id, n_below) of terms with descendants among the gene's own terms, and how many there are.

    A gene's terms are expanded upwards, by their lists of ancestors, so that between the joins there are as many rows as
    terms times their depth; a term near the root has few ancestors, but nearly all terms as descendants. ``paths`` are
    pairs as of ``closure``, or lists as of ``ancestor_index``.
    """
    index = paths if "above" in paths.columns else written(ancestor_lists(paths))
    if (index.agg(F.sum(F.size("above"))).first()[0] or 0) <= BROADCAST_ANCESTORS:
        index = F.broadcast(index)
    own = terms.select(key, "go_id").distinct()
    above = own.join(index, "go_id").select(key, F.explode("above").alias("go_id"))
    return above.groupBy(key, "go_id").agg(F.count(F.lit(1)).alias("n_below")).join(own, [key, "go_id"], "left_semi")


def most_specific_terms(terms: DataFrame, paths: DataFrame, key: str = "gene_id") -> DataFrame:
    """Drops each term of a gene that has a descendant among the gene's own terms."""
    return terms.join(specific_intersection(terms, paths, key), [key, "go_id"], "left_anti")


def hits_go_terms(hits: DataFrame, go_map: DataFrame, keys: list[str], n_hits: int | None = None) -> DataFrame:
    """(keys, go_id), distinct: the terms of every candidate key of each hit.

    Where ``n_hits`` tells how many hits there are at most, they are dealt out by ``keys`` before they are made distinct, so
    that a task holds the terms of ``TASK_HITS`` hits about, whatever it reads.
    """
    rows = hits.select(*keys, F.explode(F.array_distinct(extract_accessions(F.col("subject_id")))).alias("accession"))
    found = rows.join(go_map, "accession").select(*keys, "go_id")
    if n_hits is not None:
        found = found.repartition(max(hits.sparkSession.sparkContext.defaultParallelism, -(-n_hits // TASK_HITS)), *keys)
    return found.distinct()


def go_primary(won: DataFrame, go_map: DataFrame) -> DataFrame:
    """(gene_id, go_id) of the five best hits of the winning symbol group."""
    return hits_go_terms(top_hits(symbol_group_hits(won)), go_map, ["gene_id"])


def supplement_hits(won: DataFrame, chosen: DataFrame, threshold: float = 0.5) -> DataFrame:
    """SwissProt hits of the winning cluster outside the five, with the gene's symbol or a name like its name."""
    top = top_hits(symbol_group_hits(won)).select("gene_id", "hit_idx")
    rest = won.filter(F.col("subject_id").startswith("sp|")).join(top, ["gene_id", "hit_idx"], "left_anti").join(chosen.select("gene_id", "protein_name", "gene_symbol"), "gene_id")
    same = (F.col("gene_symbol") != "") & (F.lower("symbol") == F.col("gene_symbol"))
    rest = rest.withColumns({"same": F.coalesce(same, F.lit(False)), "_x": normalize_name(F.col("protein_name")), "_y": normalize_name(F.col("name"))})
    keep = ["gene_id", "hit_idx", "subject_id"]
    alike = name_similarity(rest.filter("not same and _x <> '' and _y <> ''"), "_x", "_y").filter(F.col("similarity") >= threshold)
    return rest.filter("same").select(*keep).unionByName(alike.select(*keep))


def gene_go_terms(won: DataFrame, chosen: DataFrame, go_map: DataFrame, primary: DataFrame, paths: DataFrame, namespaces: tuple[str, ...] = ("BP", "MF", "CC"), threshold: float = 0.5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(gene_id, go_id) after the namespace filter, the specific ones of them, and (gene_id, go_source).

    The source's label is set before the namespace filter, so it can stand without terms.
    """
    first = written(go_primary(won, go_map))
    more = written(hits_go_terms(supplement_hits(won, chosen, threshold), go_map, ["gene_id"]))
    new = more.join(first, ["gene_id", "go_id"], "left_anti").select("gene_id").distinct().withColumn("_new", F.lit(True))
    source = F.when(F.col("_new"), "cluster_top5+swissprot_supplement").otherwise("cluster_top5")
    labels = first.select("gene_id").distinct().join(new, "gene_id", "full").select("gene_id", source.alias("go_source"))
    terms = written(namespace_filter(first.unionByName(more).distinct(), primary, namespaces))
    return terms, most_specific_terms(terms, paths), labels
