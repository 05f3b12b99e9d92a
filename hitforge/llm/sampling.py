"""Bounded samples of rows in order of a hash, which don't gather much in one task on any number of partitions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _place(key: Column) -> Column:
    """A number in [0, 1) by hash."""
    return F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) / (1 << 30)


def _enough(most: int) -> float:
    """Rows that the hash lets through on average, so that fewer than ``most`` come through with a chance below 1e-12."""
    return most + 10 * math.sqrt(most) + 30


def hashed_sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, those whose key's hash is least; what the count tells can't be among them goes first."""
    share = _enough(most) / max(1, rows.count())
    return rows.filter(_place(F.col(key)) < share).orderBy(_place(F.col(key)), key).limit(most)


def hashed_sample_by(rows: DataFrame, group: str, key: str, most: int) -> DataFrame:
    """The same for each group."""
    counts = rows.groupBy(F.col(group).alias("_group")).agg(F.count(F.lit(1)).alias("_n"))
    near = rows.join(counts, rows[group] == F.col("_group")).filter(_place(F.col(key)) < F.lit(_enough(most)) / F.col("_n"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(_place(F.col(key)), key))
    return near.withColumn("_rank", rank).filter(F.col("_rank") <= most).drop("_rank", "_n", "_group")
