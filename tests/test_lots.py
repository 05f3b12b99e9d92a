"""Genes clustered side by side, against each of them clustered by itself."""

import random

import numpy as np
import pytest

from hitforge.operators import clusters
from hitforge.operators.linkage import linkage
from hitforge.operators.lots import SMALL, clusters_of_genes

WORDS = ["kinase", "beta", "protein", "zinc", "like", "tide", "diet", "é", "--", ""]


def some_genes(dice, n, sizes):
    return [[(" ".join(" ".join(dice.choices(WORDS, k=dice.randint(0, 3))).split()), dice.choice(["", "kin1", "kin2", "zf", "kin10"])) for _ in range(dice.choice(sizes))] for _ in range(n)]


def plain(hits, threshold):
    """(first, place) of each hit."""
    made = linkage([n for n, _ in hits], [s for _, s in hits], threshold)
    return [of for _, of in sorted((i, (c[0], p)) for c in made for p, i in enumerate(c))]


@pytest.mark.parametrize("threshold", [0.0, 0.3, 0.5, 0.6, 0.8, 1.0, 1.2])
def test_lots_of_genes(threshold):
    genes = some_genes(random.Random(int(threshold * 10)), 150, [1, 2, 3, 7, 8, 9, 20, 24, 33, SMALL, SMALL + 1])
    starts = np.cumsum([0, *map(len, genes)])
    numbers = []
    for part in (0, 1):
        texts = [hit[part] for hits in genes for hit in hits]
        own = list(dict.fromkeys(texts))
        numbers.append((own, np.array([own.index(t) for t in texts])))
    first, place = clusters_of_genes(starts, *numbers, threshold)
    for begin, hits in zip(starts.tolist(), genes, strict=False):
        rows = slice(begin, begin + len(hits))
        assert list(zip((first[rows] - begin).tolist(), place[rows].tolist(), strict=True)) == plain(hits, threshold)


@pytest.mark.parametrize("batch", ["1", "7", "10000"])
def test_genes_across_batches(spark, batch):
    """A task clusters many genes a call, wherever batches of rows end, and hits are dealt out once, with all their columns."""
    genes = some_genes(random.Random(4), 40, [1, 2, 5, 20, 90])
    rows = [(f"g{g}", i, n, s, float(i)) for g, hits in enumerate(genes) for i, (n, s) in enumerate(hits)]
    hits = spark.createDataFrame(rows, "gene_id string, hit_idx bigint, name string, symbol string, bitscore double").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = clusters.cluster_hits(hits)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "FlatMapGroupsInArrow" not in plan and plan.count("hashpartitioning(gene_id") == 1
        got = {tuple(r) for r in found.select("gene_id", "hit_idx", "cluster_id", "member_pos", "bitscore").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {(f"g{g}", i, c, p, float(i)) for g, hits in enumerate(genes) for i, (c, p) in enumerate(plain(hits, 0.5))}
