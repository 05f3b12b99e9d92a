"""Registered queries of the training-data operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hitforge.llm.quality import judge, train

    docs = _table(spark, sf_dir, "documents")
    return judge(docs, train(docs, _table(spark, sf_dir, "labels")))


def op2_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hitforge.llm.languages import held_out, identify, train

    docs = _table(spark, sf_dir, "documents")
    found = identify(docs, train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hitforge.llm.secrets import digests, find_secrets

    return digests(find_secrets(_table(spark, sf_dir, "documents")))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hitforge.llm.pii import digests, find_personal_data, train

    docs = _table(spark, sf_dir, "documents")
    return digests(find_personal_data(docs, train(docs)))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hitforge.llm.mixing import mix

    return mix(_table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hitforge.llm.byte_bpe import encode_digests

    return encode_digests(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_multi_50k.tiktoken"))


def op7_audio_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hitforge.llm.audio_prints import align, as_recordings, fingerprints
    from hitforge.storage import written

    return align(written(fingerprints(as_recordings(_table(spark, sf_dir, "documents")))))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hitforge.llm.token_counts import token_counts

    return token_counts(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hitforge.llm.near_duplicates import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hitforge.llm.url_filters import filter_urls

    return filter_urls(_table(spark, sf_dir, "pages"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hitforge.llm.substring_dedup import substring_dedup

    return substring_dedup(_table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hitforge.llm.filter_audit import filter_audit

    return filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hitforge.llm.source_divergence import source_divergence

    return source_divergence(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_languages": op2_languages,
    "op3_secrets": op3_secrets,
    "op4_personal_data": op4_personal_data,
    "op5_mixing": op5_mixing,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_audio_prints": op7_audio_prints,
    "op8_token_counts": op8_token_counts,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_url_filters": op10_url_filters,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_filter_audit": op12_filter_audit,
    "op13_source_divergence": op13_source_divergence,
}


def _oracle_sql() -> dict[str, str]:
    from hitforge.llm import filter_audit, near_duplicates, secrets, source_divergence, substring_dedup

    return {
        "op3_secrets": secrets.oracle_sql(),
        "op9_near_duplicates": near_duplicates.oracle_sql(),
        "op11_substring_dedup": substring_dedup.oracle_sql(),
        "op12_filter_audit": filter_audit.oracle_sql(),
        "op13_source_divergence": source_divergence.oracle_sql(),
    }


ORACLE_SQL: dict[str, str] = _oracle_sql()
