"""The stateless front half of annotation, which also runs on a stream of hit lines."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hitforge.functions.rules import DEFAULT, RuleSet
from hitforge.operators.hits import filter_hits, hit_evalue_filter


def clean_hits(hits: DataFrame, rules: RuleSet = DEFAULT, threshold: float = 1e-5) -> DataFrame:
    """E-value filter, names and symbols; no state, so a stream needs no watermark."""
    return filter_hits(hit_evalue_filter(hits, threshold), rules)
