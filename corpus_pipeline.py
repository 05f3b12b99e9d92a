"""The corpus pipeline: quality rules, near-duplicate removal, secrets, mixing, encoding.

Each stage reads what the one before has kept, written as Parquet. SQL can't express the line labelling, MinHash, budget
fitting and byte-pair merging, so there is no SQL for the whole; tests hold every stage against a brute-force version.

Edge cases of all stages: a null text counts as empty. Rows without an id stay apart from each other and go through all
stages. Texts of any length are read whole, in bounded parts. An empty table gives an empty table. Columns of documents
that are not among COLUMNS are not carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitforge.llm import byte_bpe, mixing, near_duplicates, quality, secrets
from hitforge.storage import shared_dir, written

#: The columns of documents, which all stages but the last return.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the line labels reject go; null and blank texts are among them.

    Repeated rows are judged alike. A share of content of exactly the limit is enough.
    """
    field = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(docs, field, keep=COLUMNS).filter("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id, so that there are no ties.

    Of rows with one id the least by text, then by the other columns, stays. Rows without an id or without a word stay.
    Only ids are shuffled for that, and whole rows where an id is repeated.
    """
    groups = written(near_duplicates.near_duplicates(docs).select("doc_id", "kept"))

    def some(ids: DataFrame) -> DataFrame:
        ids = written(ids.distinct())
        return F.broadcast(ids) if ids.count() <= near_duplicates.BROADCAST_IDS else ids

    left = docs.select(*COLUMNS).join(some(groups.filter("not kept").select("doc_id")), "doc_id", "left_anti")
    counts = groups.filter("kept and doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    repeated = some(counts.filter("n > 1").select("doc_id"))
    least = left.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*COLUMNS[1:])).alias("row")).select("doc_id", "row.*")
    return left.join(repeated, "doc_id", "left_anti").select(*COLUMNS).unionByName(least.select(*COLUMNS))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mask, overlapping ones by one; all documents stay, null texts null, repeated rows repeated."""
    found = secrets.redact(secrets.find_secrets(docs, keep=COLUMNS), "secret_spans", "text")
    return found.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix takes documents once, twice or not at all, by their sizes and a seeded hash; each time is a row.

    Documents without a word are not taken. Rows of one id are taken alike; a null source is one source.
    """
    return mixing.take(docs.select(*COLUMNS)).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token counts and digests of ids and of decoded bytes for each row of the mix, repeated rows repeated."""
    import public_tokenizers

    return byte_bpe.encode_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicate removal", near_dedup),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to the documents, each written to the folder that driver and executors share."""
    shared_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
