"""Feature files: attributes rewritten with annotations, and identifiers numbered anew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitforge.functions.names import attribute, clean_header, first_attr, parse_attributes, replace_spaces, strip_db_prefix
from hitforge.storage import written

# Feature types that keep their ID, and those that keep only their parent.
SUB_ID = ("exon", "CDS", "five_prime_UTR", "three_prime_UTR")
PARENT_ONLY = ("start_codon", "stop_codon", "intron")


def lookup_id(ftype: Column, parsed: Column) -> Column:
    """The gene id of a feature: by gene_id or ID for genes, by Parent or gene_id for mRNA, else by gene_id."""
    own = lambda key: F.nullif(attribute(parsed, key), F.lit(""))
    return F.when(ftype == "gene", F.coalesce(own("gene_id"), own("ID"))).when(ftype == "mRNA", F.coalesce(own("Parent"), own("gene_id"))).otherwise(own("gene_id"))


def feature_annotation_join(features: DataFrame, annotations: DataFrame) -> DataFrame:
    """Adds protein_name and gene_symbol of the gene that each feature belongs to."""
    parsed = features.withColumn("parsed", parse_attributes(F.col("attrs")))
    keyed = parsed.withColumn("lookup_id", lookup_id(F.col("ftype"), F.col("parsed")))
    known = annotations.select(F.col("gene_id").alias("lookup_id"), "protein_name", "gene_symbol")
    return keyed.join(known, "lookup_id", "left")


def rebuild_attributes(ftype: Column, parsed: Column, name: Column, symbol: Column) -> Column:
    """The ninth column by feature type; a gene or mRNA without ID gives the literal ``ID=None``."""
    of = lambda key: F.when(F.coalesce(attribute(parsed, key), F.lit("")) != "", F.concat(F.lit(f"{key}="), attribute(parsed, key)))
    literal_id = F.concat(F.lit("ID="), F.coalesce(attribute(parsed, "ID"), F.lit("None")))
    named = F.when(symbol != "", F.concat(F.lit("Name="), symbol))
    product = F.when(name != "", F.concat(F.lit("product="), strip_db_prefix(name)))
    rest = F.filter(parsed, lambda p: ~p["k"].isin("ID", "Parent", "gene_id", "transcript_id"))
    others = F.array_join(F.transform(rest, lambda p: F.concat(p["k"], F.lit("="), p["v"])), ";")
    made = (
        F.when(ftype == "gene", F.concat_ws(";", literal_id, named, product))
        .when(ftype == "mRNA", F.concat_ws(";", literal_id, of("Parent"), named, product))
        .when(ftype.isin(*SUB_ID), F.concat_ws(";", of("ID"), of("Parent")))
        .when(ftype.isin(*PARENT_ONLY), F.concat_ws(";", of("Parent")))
        .otherwise(F.concat_ws(";", of("ID"), of("Parent"), F.when(F.size(rest) > 0, others)))
    )
    return F.when(made == "", ".").otherwise(made)


def annotate_gff3(features: DataFrame, annotations: DataFrame) -> DataFrame:
    """(value, ord) lines with rewritten attributes; lines that are no features pass through."""
    joined = feature_annotation_join(features, annotations)
    made = rebuild_attributes(F.col("ftype"), F.col("parsed"), F.coalesce("protein_name", F.lit("")), F.coalesce("gene_symbol", F.lit("")))
    line = F.concat_ws("\t", "seqid", "source", "ftype", "start", "end", "score", "strand", "phase", made)
    return joined.select(F.when(F.col("is_feature"), line).otherwise(F.rtrim("line")).alias("value"), "ord")


def gff3_gene_counts(features: DataFrame, annotations: DataFrame) -> DataFrame:
    """One row: annotated genes and all genes of a feature file."""
    genes = feature_annotation_join(features.filter("ftype = 'gene'"), annotations)
    named = (F.coalesce("protein_name", F.lit("")) != "") | (F.coalesce("gene_symbol", F.lit("")) != "")
    return genes.agg(F.count_if(named).alias("annotated"), F.count(F.lit(1)).alias("total"))


def annotate_headers(records: DataFrame, annotations: DataFrame) -> DataFrame:
    """Adds new_header: Name= and product= at the end where the gene has either, else the header as it was."""
    joined = records.join(annotations.select("gene_id", "protein_name", "gene_symbol"), "gene_id", "left")
    name, symbol = F.coalesce("protein_name", F.lit("")), F.coalesce("gene_symbol", F.lit(""))
    tags = F.concat_ws(" ", F.when(symbol != "", F.concat(F.lit("Name="), symbol)), F.when(name != "", F.concat(F.lit("product="), strip_db_prefix(name))))
    return joined.withColumn("new_header", F.when(tags != "", F.concat_ws(" ", clean_header(F.col("header")), tags)).otherwise(F.col("header")))


def annotate_fasta(records: DataFrame, annotations: DataFrame) -> DataFrame:
    """(value, ord): records with a new header where there is one; the lines below stay as they were.

    A repeated transcript takes the gene of its last record.
    """
    last = records.groupBy("transcript_id").agg(F.max_by("gene_id", "ord").alias("gene_id"))
    joined = annotate_headers(records.drop("gene_id").join(last, "transcript_id"), annotations)
    changed = F.concat(F.col("new_header"), F.substr("record", F.length(F.substring_index("record", "\n", 1)) + 1))
    return joined.select(F.concat(F.lit(">"), F.when(F.col("new_header") == F.col("header"), F.col("record")).otherwise(changed)).alias("value"), "ord")


def feature_type_counts(features: DataFrame) -> DataFrame:
    """(ftype, n) of features with an ID, spaces as underscores."""
    rows = features.filter(first_attr(F.col("attrs"), "ID").isNotNull())
    return rows.groupBy(replace_spaces(F.col("ftype")).alias("ftype")).agg(F.count(F.lit(1)).alias("n"))


def renumber_ids(features: DataFrame, order: list[str]) -> DataFrame:
    """Adds old_id and new_id = type_n, numbered by type in file order.

    Types are few and features many, so no window runs over a type: rows are ranged by file order into partitions,
    numbered inside them, and moved by the counts of the partitions before.
    """
    return _numbered(_with_ids(features), order)


def _with_ids(features: DataFrame) -> DataFrame:
    """Features that have an ID, with old_id and kind."""
    return features.withColumns({"old_id": first_attr(F.col("attrs"), "ID"), "kind": replace_spaces(F.col("ftype"))}).filter("old_id is not null")


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    inner = Window.partitionBy("part", "kind").orderBy(*order)
    before = Window.partitionBy("kind").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("part", "kind").agg(F.count(F.lit(1)).alias("n"))
    moved = counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    numbered = ranged.withColumn("nth", F.row_number().over(inner)).join(moved, ["part", "kind"])
    number = F.col("nth") + F.col("offset")
    return numbered.withColumn("new_id", F.concat_ws("_", "kind", number.cast("string"))).drop("part", "kind", "nth", "offset")


def last_id_wins(numbered: DataFrame, order: list[str]) -> DataFrame:
    """(old_id, new_id): an ID seen several times maps to its last number everywhere."""
    return numbered.groupBy("old_id").agg(F.max_by("new_id", F.struct(*order)).alias("new_id"))


def new_ids(features: DataFrame, order: list[str]) -> DataFrame:
    """(old_id, new_id) of all features; of a feature no more than its order, ID and type is dealt out and written."""
    return last_id_wins(_numbered(_with_ids(features).select(*order, "old_id", "kind"), order), order)


def parent_remap(features: DataFrame, ids: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, new_parent): each of a comma list of parents mapped, in order; unknown ones stay. Each list is mapped once."""
    parents = features.select(*keys, first_attr(F.col("attrs"), "Parent").alias("p")).filter("p is not null")
    rows = parents.select("p").distinct().select("p", F.posexplode(F.split("p", ",")).alias("pos", "old_id"))
    mapped = rows.join(ids, "old_id", "left").select("p", "pos", F.coalesce("new_id", "old_id").alias("new_id"))
    listed = mapped.groupBy("p").agg(F.sort_array(F.collect_list(F.struct("pos", "new_id"))).alias("l"))
    return parents.join(listed.select("p", F.array_join("l.new_id", ",").alias("new_parent")), "p").select(*keys, "new_parent")


def unmatched_parents(features: DataFrame, ids: DataFrame) -> DataFrame:
    """The distinct parents that no feature has as its ID."""
    parents = features.select(F.explode(F.split(first_attr(F.col("attrs"), "Parent"), ",")).alias("old_id")).distinct()
    return parents.join(ids, "old_id", "left_anti").select(F.col("old_id").alias("parent"))


#: Ids that may be broadcast, after a count (about 100 bytes each); more go through a shuffle join.
BROADCAST_IDS = 500_000


def renumber_gff3(features: DataFrame, order: list[str]) -> DataFrame:
    """Features with old_id, new_id, new_parent and new_attrs, which holds only those two; ``order`` identifies and sorts rows.

    A feature's own id and its parents are looked up together, so that whole features are joined once.
    """
    ids = written(new_ids(features, order))
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    own, parents = first_attr(F.col("attrs"), "ID"), F.split(first_attr(F.col("attrs"), "Parent"), ",")
    named = F.concat(F.array(own), F.coalesce(parents, F.array().cast("array<string>")))
    rows = features.select(*order, F.posexplode(named).alias("pos", "old_id")).filter("old_id is not null").join(ids, "old_id", "left")
    parent = F.when(F.col("pos") > 0, F.struct("pos", F.coalesce("new_id", "old_id").alias("id")))
    found = rows.groupBy(*order).agg(F.max(F.when(F.col("pos") == 0, F.col("new_id"))).alias("new_id"), F.sort_array(F.collect_list(parent)).alias("l"))
    found = found.select(*order, "new_id", F.when(F.size("l") > 0, F.array_join("l.id", ",")).alias("new_parent"))
    attrs = F.concat_ws(";", F.concat(F.lit("ID="), "new_id"), F.concat(F.lit("Parent="), "new_parent"))
    return features.withColumn("old_id", own).join(found, order, "left").withColumn("new_attrs", F.when(attrs != "", attrs).otherwise(F.lit(".")))
