"""Winning hits by windows against the scores, places instead of file order, and what is left on disk behind a written table."""

import random

from pyspark.sql import functions as F

from hitforge import storage
from hitforge.operators import clusters, hits
from hitforge.plans import queries
from hitforge.plans.proxies import Tables


def shuffle_files(spark):
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
    return {b for b in blocks.split() if b.startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before, set_to = shuffle_files(spark), spark.conf.get(storage.CLEANUP, None)
    df.collect()
    assert shuffle_files(spark) > before  # an action by itself leaves them
    before = shuffle_files(spark)
    table = storage.written(df)
    assert shuffle_files(spark) <= before and spark.conf.get(storage.CLEANUP, None) == set_to
    assert table.count() == 7 and df.count() == 7


def test_winning_hits(spark):
    dice = random.Random(8)
    rows = [(g, i, dice.randrange(4), dice.choice([0, 0, 1, 2, 5]), dice.choice([None, 1.0, 2.0, 2.5])) for g in range(80) for i in range(dice.randint(1, 9))]
    rows += [(None, 0, 1, 0, 1.0), (99, 0, None, 0, 1.0), (99, 1, 3, 0, 1.0), (99, 2, 3, 2, 2.0)]
    clustered = spark.createDataFrame(rows, "gene_id int, hit_idx bigint, transcript_id int, cluster_id bigint, bitscore double")
    won = clusters.winning_hits(clustered)
    plan = won._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    known = clusters.winning_cluster(clustered).select("gene_id", "cluster_id")
    want = clustered.alias("a").join(known.alias("b"), F.expr("a.gene_id <=> b.gene_id and a.cluster_id = b.cluster_id")).select("a.*")
    order = lambda df: sorted(map(str, df.collect()))
    assert order(won) == order(want) and 0 < won.count() < len(rows)


def test_pool_without_file_order(spark, sf):
    """Hits are dealt out by gene without their file order, with the same index."""
    t = Tables(spark, sf)
    clustered = queries._in_clusters(t)
    plan = clustered._jdf.queryExecution().executedPlan().toString()
    (exchange,) = [line for line in plan.splitlines() if "Exchange hashpartitioning(gene_id" in line]
    assert plan.count("Exchange hashpartitioning") == 1 and "lineitem" not in "".join(clustered.inputFiles())
    place = hits.with_transcript_place(queries._good(t))
    assert dict(place.dtypes)["ord"] == "int"
    same = lambda df: sorted(map(tuple, df.select("gene_id", "transcript_id", "subject_id", "bitscore", "hit_idx").collect()))
    assert same(clustered) == same(queries._merged(t))
