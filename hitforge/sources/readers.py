"""Readers of the native file formats. Files are split by Spark; ``ord`` carries each row's place in its file."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitforge.functions.names import header_tag, split_terms, strip
from hitforge.sources import block_gzip


def file_order() -> Column:
    """Sorts rows as they stand in their files, over several files by path."""
    return F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"))


def _lines(spark: SparkSession, path, line_sep: str | None = None) -> DataFrame:
    """(value, ord) of text files. Block gzip is read in ranges of blocks; what plain gzip gives, which can't be cut, is dealt out after reading."""
    paths = [path] if isinstance(path, str) else list(path)
    zipped = all(p.endswith((".gz", ".bgz")) for p in paths)
    if zipped and block_gzip.are_block_gzip(paths):
        return block_gzip.read_records(spark, paths, line_sep or "\n").select("value", F.struct("path", "block", "seq").alias("ord"))
    reader = spark.read.option("lineSep", line_sep) if line_sep else spark.read
    lines = reader.text(path).select("value", file_order().alias("ord"))
    return lines.repartition(spark.sparkContext.defaultParallelism) if zipped else lines


def read_hits(spark: SparkSession, path) -> DataFrame:
    """Similarity hits: 12 tab fields and a title, which may hold tabs. Shorter lines are skipped; a bad number fails the job.

    Several paths are read as one table, which is how results of two databases are combined.
    """
    lines = _lines(spark, path)
    f = F.split(strip(F.col("value")), "\t", -1)
    names = ["query_id", "subject_id", "pident", "length", "mismatch", "gapopen", "qstart", "qend", "sstart", "send", "evalue", "bitscore"]
    kinds = ["string", "string", "double", "int", "int", "int", "int", "int", "int", "int", "double", "double"]
    whole = lines.select(f.alias("f"), "ord").filter(F.size("f") >= 12)
    columns = [F.col("f")[i].cast(kind).alias(name) for i, (name, kind) in enumerate(zip(names, kinds, strict=True))]
    title = F.array_join(F.slice("f", F.lit(13), F.greatest(F.size("f") - 12, F.lit(0))), "\t")
    return whole.select(*columns, title.alias("stitle"), "ord")


def read_fasta(spark: SparkSession, path) -> DataFrame:
    """(transcript_id, gene_id, header, sequence, record, ord): one splittable record for each ``>``; ``gene=`` names the gene.

    ``sequence`` is one line; ``record`` is the text as it stands, header and lines, with \\n between lines.
    """
    records = _lines(spark, path, "\n>")
    text = F.regexp_replace(F.regexp_replace("value", "\r", ""), "^>", "")
    rows = records.select(text.alias("t"), "ord").filter(F.col("t") != "")
    header = F.substring_index("t", "\n", 1)
    rows = rows.select(F.rtrim(header).alias("header"), F.regexp_replace(F.substr("t", F.length(header) + 1), r"\n", "").alias("sequence"), F.regexp_replace("t", r"\n\z", "").alias("record"), "ord")
    first = F.get(F.split(strip(F.col("header")), r"(?U)\s+"), 0)
    return rows.select(first.alias("transcript_id"), F.coalesce(header_tag(F.col("header"), "gene="), first).alias("gene_id"), "header", "sequence", "record", "ord")


def read_obo(spark: SparkSession, path) -> tuple[DataFrame, DataFrame, DataFrame]:
    """terms(id, name, namespace), edges(child, parent), alt_ids(alt_id, id) of an ontology's [Term] stanzas.

    Obsolete terms lose name, namespace and alternative ids, and keep their edges.
    """
    stanzas = _lines(spark, path, "\n[").select(F.regexp_replace("value", "\r", "").alias("t"), "ord")
    stanzas = stanzas.filter(F.col("t").rlike(r"^\[?Term\]"))

    def field(name: str) -> Column:
        return strip(F.regexp_extract("t", rf"(?m)^{name}: ([^\n]*)$", 1))

    def fields(pattern: str) -> Column:
        return F.regexp_extract_all("t", F.lit(pattern), F.lit(1))

    obsolete = F.col("t").rlike(r"(?m)^is_obsolete: true")
    rows = stanzas.select(field("id").alias("id"), field("name").alias("name"), field("namespace").alias("namespace"), obsolete.alias("obsolete"), fields(r"(?m)^is_a: (GO:[0-9]+)").alias("parents"), fields(r"(?m)^alt_id: (\S+)").alias("alts"))
    rows = rows.filter("id <> ''")
    live = rows.filter(~F.col("obsolete"))
    terms = live.select("id", F.when(F.col("name") != "", F.col("name")).alias("name"), F.when(F.col("namespace") != "", F.col("namespace")).alias("namespace"))
    edges = rows.select(F.col("id").alias("child"), F.explode("parents").alias("parent")).distinct()
    alts = live.select(F.explode("alts").alias("alt_id"), "id")
    return terms, edges, alts


def explode_go_map(rows: DataFrame) -> DataFrame:
    """(accession, go_id), distinct, from (accession, go_terms) with lists of terms."""
    return rows.select("accession", F.explode(split_terms(F.col("go_terms"))).alias("go_id")).distinct()


def read_go_map(spark: SparkSession, path) -> DataFrame:
    """(accession, go_id) of lines ``accession<TAB>terms``, terms parted by ``;``, ``,`` or tabs; repeated lines are united."""
    f = F.split(strip(F.col("value")), "\t", 2)
    lines = _lines(spark, path).select(f.alias("f")).filter(F.size("f") >= 2)
    return explode_go_map(lines.select(F.col("f")[0].alias("accession"), F.replace(F.col("f")[1], F.lit("\t"), F.lit(";")).alias("go_terms")))


def _columns(spark: SparkSession, path, comment: str | None, least: int, **at: int) -> DataFrame:
    lines = _lines(spark, path)
    if comment:
        lines = lines.filter(~F.col("value").startswith(comment))
    rows = lines.select(F.split(F.rtrim("value"), "\t", -1).alias("f"), "ord").filter(F.size("f") >= least)
    return rows.select(*[F.col("f")[i].alias(name) for name, i in at.items()], "ord")


def read_gaf(spark: SparkSession, path) -> DataFrame:
    """(db, accession, go_id, evidence, taxon, ord) of annotation lines; ``!`` lines and short ones are skipped."""
    return _columns(spark, path, "!", 13, db=0, accession=1, go_id=4, evidence=6, taxon=12)


def read_id_map(spark: SparkSession, path) -> DataFrame:
    """(accession, gene_id, ord); rows without a gene id are dropped."""
    return _columns(spark, path, None, 3, accession=0, gene_id=2).withColumn("gene_id", strip(F.col("gene_id"))).filter("gene_id <> ''")


def read_gene_info(spark: SparkSession, path) -> DataFrame:
    """(gene_id, symbol, ord); comments and placeholder symbols are dropped."""
    return placeholder_filter(_columns(spark, path, "#", 3, gene_id=1, symbol=2), "symbol")


def placeholder_filter(rows: DataFrame, column: str) -> DataFrame:
    """Without empty values, ``-`` and ``NEWENTRY``."""
    return rows.filter(~F.coalesce(F.trim(column), F.lit("")).isin("", "-", "NEWENTRY"))


def read_gff3(spark: SparkSession, path) -> DataFrame:
    """(line, is_feature, seqid, source, ftype, start, end, score, strand, phase, attrs, ord); other lines keep only ``line``."""
    f = F.split(F.rtrim("value"), "\t", -1)
    rows = _lines(spark, path).select(F.col("value").alias("line"), f.alias("f"), "ord")
    is_feature = ~F.col("line").startswith("#") & (F.size("f") == 9)
    names = ["seqid", "source", "ftype", "start", "end", "score", "strand", "phase", "attrs"]
    return rows.select("line", is_feature.alias("is_feature"), *[F.when(is_feature, F.get("f", i)).alias(n) for i, n in enumerate(names)], "ord")


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there as a whole."""
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


def table_name(path: str) -> str:
    """The name under which the session knows the table in a folder."""
    return f"`lookup_{hashlib.sha256(path.encode()).hexdigest()[:24]}`"


def read_reference_table(spark: SparkSession, path: str, keys: DataFrame | None = None, key: str | None = None, buckets: int | None = None) -> DataFrame:
    """A keyed lookup table, reduced to the keys that are wanted.

    With ``key`` and ``buckets``, as it was built, the session reads it by bucket: joins on the key don't shuffle it.
    """
    if buckets and key:
        name = table_name(path)
        if not spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
            spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
        table = spark.table(name)
    else:
        table = spark.read.parquet(path)
    return table if keys is None else table.join(keys.select(key), key, "left_semi")
