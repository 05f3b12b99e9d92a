"""Reference data: annotation files to term maps, and keyed lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitforge.functions.names import taxa_of
from hitforge.sources.readers import is_written, placeholder_filter, table_name
from hitforge.storage import written


def gaf_filter(gaf: DataFrame, db: str = "UniProtKB") -> DataFrame:
    """Rows of one database with GO: ids; negated ones stay."""
    return gaf.filter((F.col("db") == db) & F.col("go_id").startswith("GO:"))


def gaf_evidence_filter(gaf: DataFrame, codes: list[str] | None) -> DataFrame:
    """Rows whose evidence is one of the codes, if codes are given."""
    return gaf.filter(F.col("evidence").isin(codes)) if codes else gaf


def gaf_taxon_filter(gaf: DataFrame, taxa: list[str] | None) -> DataFrame:
    """Rows of which any taxon is wanted, if taxa are given."""
    return gaf.filter(F.arrays_overlap(taxa_of(F.col("taxon")), F.array(*map(F.lit, taxa)))) if taxa else gaf


def build_go_map(gaf: DataFrame, taxa: list[str] | None = None, evidence: list[str] | None = None, db: str = "UniProtKB") -> DataFrame:
    """(accession, go_id), distinct, of the rows that pass all filters."""
    return gaf_taxon_filter(gaf_evidence_filter(gaf_filter(gaf, db), evidence), taxa).select("accession", "go_id").distinct()


def go_map_stats(gaf: DataFrame, go_map: DataFrame) -> DataFrame:
    """One row: lines, accessions and annotations."""
    by_key = go_map.groupBy("accession").agg(F.count(F.lit(1)).alias("n"))
    made = by_key.agg(F.count("accession").alias("accessions"), F.coalesce(F.sum("n"), F.lit(0)).alias("annotations"))
    return gaf.agg(F.count(F.lit(1)).alias("lines")).crossJoin(F.broadcast(made))


def go_map_lines(go_map: DataFrame) -> DataFrame:
    """(accession, go_terms), terms sorted and joined by ``;``."""
    return go_map.groupBy("accession").agg(F.array_join(F.array_sort(F.collect_set("go_id")), ";").alias("go_terms"))


#: Buckets of the keyed tables.
BUCKETS = 64
#: Keys of hits that may be broadcast, after a count (about 60 bytes each); more are joined by shuffle or by bucket.
BROADCAST_KEYS = 1_000_000
#: Names and keys of the lookup tables.
TABLES = {"go_mapping": "accession", "ncbi_idmapping": "accession", "ncbi_geneinfo": "gene_id"}


def build_reference_tables(path: str, go_map: DataFrame, id_map: DataFrame, gene_info: DataFrame, rebuild: bool = False, buckets: int = BUCKETS) -> None:
    """Writes three keyed tables of two columns, dealt into buckets of their keys and sorted in each; tables that are there stay unless rebuilt.

    A join on the key reads buckets where they are, so that a table of any size is shuffled once, when it is built.
    """
    spark = go_map.sparkSession
    tables = {
        "go_mapping": go_map.select("accession", "go_id"),
        "ncbi_idmapping": placeholder_filter(id_map, "gene_id").groupBy("accession").agg(F.max_by("gene_id", "ord").alias("gene_id")),
        "ncbi_geneinfo": placeholder_filter(gene_info, "symbol").groupBy("gene_id").agg(F.max_by("symbol", "ord").alias("symbol")),
    }
    for name, table in tables.items():
        where, key = f"{path}/{name}", TABLES[name]
        if not rebuild and is_written(spark, where):
            continue
        held = table_name(where)
        spark.sql(f"DROP TABLE IF EXISTS {held}")
        dealt = table.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
        dealt.option("path", where).saveAsTable(held)


def wanted(table: DataFrame, keys: DataFrame, key: str, most: int | None = None) -> DataFrame:
    """The rows of a lookup table whose key is among ``keys``, written: where these are few, no row of the table is shuffled."""
    keys = written(keys.select(key).distinct())
    few = keys.count() <= (BROADCAST_KEYS if most is None else most)
    return written(table.join(F.broadcast(keys) if few else keys, key, "left_semi"))
