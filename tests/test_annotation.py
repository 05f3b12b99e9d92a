"""Clustering, selection and the whole plan against plain Python."""

import random
from difflib import SequenceMatcher
from itertools import product
from statistics import fmean

import numpy as np
import pytest
from pyspark.sql import functions as F

from hitforge.functions.rules import RuleSet
from hitforge.functions.similarity import classes, fmt2, names_alike, pair_alike, similar_pairs, within_gene_pairs
from hitforge.operators import clusters, propagation
from hitforge.operators.graphs import connected
from hitforge.operators.linkage import linkage
from hitforge.plans.annotate import Params, annotate

WORDS = ["kinase", "beta", "protein", "zinc", "finger", "like", "tide", "diet"]


def plain_clusters(names, symbols, threshold):
    """From the definition: of all pairs of groups the one with the greatest mean, then the least first members, becomes one."""

    def rank(pair):
        likeness = [pair_alike(names[i], symbols[i], names[j], symbols[j]) for i, j in (sorted(p) for p in product(*pair))]
        return round(fmean(likeness), 9), -pair[0][0], -pair[1][0]

    groups = {(i,) for i in range(len(names))}
    while len(groups) > 1:
        best = max(((a, b) for a in groups for b in groups if a[0] < b[0]), key=rank)
        if rank(best)[0] < threshold:
            break
        groups = groups - {*best} | {best[0] + best[1]}
    return sorted(map(list, groups))


def test_likeness():
    assert SequenceMatcher(None, "tide", "diet").ratio() != SequenceMatcher(None, "diet", "tide").ratio()
    assert names_alike("tide", "diet") == 0.25 and names_alike("diet", "tide") == 0.5
    assert pair_alike("same name", "a", "same name", "zz") == 0.3
    assert pair_alike("same", "ab", "same x", "ab") == min(1.0, names_alike("same", "same x") + 0.2)
    assert pair_alike("same", "", "same", "zz") == 1.0


def test_linkage():
    dice = random.Random(5)
    for _ in range(150):
        n = dice.randint(2, 12)
        names = [" ".join(dice.sample(WORDS, dice.randint(1, 3))) for _ in range(n)]
        symbols = [dice.choice(["", "kin1", "kin2", "zf"]) for _ in range(n)]
        threshold = dice.choice([0.3, 0.5, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0, 1.2])
        assert linkage(names, symbols, threshold) == plain_clusters(names, symbols, threshold)
        of, labels = classes(names, symbols)
        every = np.arange(len(labels.names))
        top = labels.bounds(every, every)
        assert all(top[u, v] >= labels.alike(u, v) - 1e-12 for u in every for v in every if u != v)
        like = labels.likeness(every, every[:, None] != every)
        assert all(like[u, v] == labels.alike(u, v) for u in every for v in every if u != v)


def test_linkage_of_many_hits():
    """50,000 hits of 500 different names and symbols; the memory of a matrix of hits would be 20 GB."""
    import tracemalloc

    dice = random.Random(6)
    parts = [a + b for a in ("ki", "ze", "pro", "al", "mu", "ta") for b in ("nase", "tein", "dine", "lase", "rin")]
    kinds = [(" ".join(dice.sample(parts, 4)), dice.choice(["", f"s{i % 40}"])) for i in range(500)]
    rows = [dice.choice(kinds) for _ in range(50_000)]
    tracemalloc.start()
    made = linkage([n for n, _ in rows], [s for _, s in rows], 0.6)
    assert tracemalloc.get_traced_memory()[1] < 1 << 30
    tracemalloc.stop()
    assert sorted(i for m in made for i in m) == list(range(50_000)) and len(made) > 1
    for m in made:  # equal hits are never parted
        assert {rows[i] for i in m}.isdisjoint(rows[i] for other in made if other is not m for i in other)


def test_cluster_hits_any_partitioning(spark):
    dice = random.Random(7)
    rows = [(g, i, " ".join(dice.sample(WORDS, 2)), dice.choice(["", "KIN", "zf"])) for g in range(12) for i in range(dice.randint(1, 9))]
    hits = spark.createDataFrame(rows, "gene_id bigint, hit_idx bigint, name string, symbol string")
    want = set()
    for g in range(12):
        own = [r for r in rows if r[0] == g]
        for c in plain_clusters([r[2] for r in own], [r[3].lower() for r in own], 0.5):
            want |= {(g, i, min(c), p) for p, i in enumerate(c)}
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = clusters.cluster_hits(hits.repartition(5)).select("gene_id", "hit_idx", "cluster_id", "member_pos").collect()
        assert {tuple(r) for r in got} == want
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    # genes of more than four hits in tiles of two kinds of hits, and one task for each connected part
    got = clusters.cluster_hits(hits, large=4, tile=2).select("gene_id", "hit_idx", "cluster_id", "member_pos").collect()
    assert {tuple(r) for r in got} == want
    kinds = hits.withColumnsRenamed({"name": "_name"}).selectExpr("gene_id", "hit_idx", "lower(_name) as _name", "lower(symbol) as _symbol")
    assert clusters.connected_parts(kinds, 0.5, 2).groupBy("gene_id").agg(F.countDistinct("part").alias("n")).filter("n > 1").count() > 0


@pytest.mark.parametrize("tile", [1, 3, 1000])
def test_pairs_in_tiles(spark, tile):
    dice = random.Random(9)
    rows = [(g, i, " ".join(dice.sample(WORDS, 2)), dice.choice(["", "KIN", "zf", None])) for g in range(6) for i in range(dice.randint(1, 9))]
    hits = spark.createDataFrame(rows, "gene_id string, hit_idx bigint, name string, symbol string")
    of = {(str(g), i): (n, (s or "").lower()) for g, i, n, s in rows}
    every = {(g, i, j): pair_alike(*of[g, i], *of[g, j]) for g, i in of for h, j in of if g == h and i < j}
    assert {(r.gene_id, r.i, r.j) for r in within_gene_pairs(hits, tile).collect()} == set(every)
    got = similar_pairs(hits, 0.3, tile).collect()
    assert {(r.gene_id, r.i, r.j): r.similarity for r in got} == {k: v for k, v in every.items() if v >= 0.3} and len(got) < len(every)


def test_connected(spark):
    dice = random.Random(3)
    pairs = [(dice.randint(0, 80), dice.randint(0, 80)) for _ in range(50)] + [(i, i + 1) for i in range(100, 140)] + [(7, 7)]
    root = {}
    for u, v in pairs:
        if u != v:
            a, b = root.setdefault(u, {u}), root.setdefault(v, {v})
            for i in (both := a | b):
                root[i] = both
    got = {r.node: r.component for r in connected(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()}
    assert got == {i: min(r) for i, r in root.items()}


def won(spark, rows):
    return spark.createDataFrame([("g", i, i, f"t{i}", "sp|P|X_Y", float(b), n, s) for i, (b, n, s) in enumerate(rows)], "gene_id string, hit_idx bigint, member_pos bigint, transcript_id string, subject_id string, bitscore double, name string, symbol string")


def test_symbol_choice(spark):
    chosen = lambda rows: clusters.select_name_symbol(won(spark, rows), RuleSet()).first()
    assert chosen([(90, "a", "Top"), (50, "b", "two"), (40, "c", "TWO")]).gene_symbol == "two"  # a pair beats a single hit
    guarded = chosen([(90 - i, f"n{i}", "solo" if i == 3 else "") for i in range(11)])
    assert (guarded.gene_symbol, guarded.protein_name) == ("", "n0")
    assert chosen([(90 - i, f"n{i}", "solo" if i == 3 else "") for i in range(10)]).gene_symbol == "solo"


def test_propagation(spark):
    rows = [("a", 0, "Same  name", "s1"), ("b", 1, "same name", "s2"), ("c", 2, "same name", ""), ("d", 3, "", ""), ("e", 4, "other", "")]
    ann = spark.createDataFrame(rows, "gene_id string, gene_ord int, protein_name string, gene_symbol string")
    got = {r.gene_id: (r.gene_symbol, r.propagated) for r in propagation.propagate_symbols(ann).collect()}
    assert got == {"a": ("s1", False), "b": ("s2", False), "c": ("s1", True), "d": ("", False), "e": ("", False)}


def test_two_decimals(spark):
    rows = spark.createDataFrame([(0.125,), (2.675,), (None,)], "x double").select(fmt2("x").alias("t")).collect()
    assert [r.t for r in rows] == ["0.12", "2.67", None]


def test_annotate(spark):
    hits = spark.createDataFrame(
        [("t1", "sp|P1|A_B", 1e-9, 90.0, "Zinc kinase OS=x GN=Zk", 1), ("t2", "tr|P2|A_B", 1e-9, 80.0, "Zinc kinase 2 OS=x GN=ZK", 2), ("t3", "xx|P3|A_B", 0.5, 70.0, "late OS=x", 3), ("t9", "xx", 1e-9, 70.0, "stray OS=x", 4)],
        "transcript_id string, subject_id string, evalue double, bitscore double, stitle string, ord bigint",
    )
    tx = spark.createDataFrame([("t1", "g1"), ("t2", "g1"), ("t3", "g2")], "transcript_id string, gene_id string")
    genes = spark.createDataFrame([("g1", 0), ("g2", 1)], "gene_id string, gene_ord bigint")
    got = {r.gene_id: r for r in annotate(hits, tx, genes, params=Params()).collect()}
    assert set(got) == {"g1", "g2"}
    assert (got["g1"].protein_name, got["g1"].gene_symbol, got["g1"].n_total_hits, got["g1"].n_isoforms, got["g1"].symbol_concordance) == ("Zinc kinase", "zk", 2, 2, 1.0)
    assert (got["g2"].protein_name, got["g2"].n_total_hits) == ("", 0)


def test_invariants(spark, sf):
    from hitforge.plans.queries import QUERIES

    table = QUERIES["annotate_genes"](spark, sf)
    rows = table.collect()
    assert len(rows) == len({r.gene_id for r in rows}) == spark.read.parquet(f"{sf}/customer.parquet").count()
    assert [r.gene_id for r in rows] == sorted(r.gene_id for r in rows)
    assert table.filter(F.col("n_cluster_hits") > F.col("n_total_hits")).count() == 0
