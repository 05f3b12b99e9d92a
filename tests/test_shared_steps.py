"""What the shared steps of the queries shuffle and write."""

from pyspark.sql import functions as F

from hitforge import storage
from hitforge.functions.similarity import name_similarity
from hitforge.operators import features, ontology
from hitforge.plans import queries
from hitforge.plans.proxies import Tables


def test_pool_without_titles(spark, sf, monkeypatch):
    """Titles aren't shuffled, and the first hit of a cluster is found without dealing the hits out again."""
    plans = []
    monkeypatch.setattr(queries, "written", lambda df: plans.append(df) or storage.written(df))
    queries._won(Tables(spark, sf))
    clustered = plans[0]
    assert not {"stitle", "ord", "tx_ord", "evalue"} & set(clustered.columns)
    plan = clustered._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(gene_id" in plan and not any("stitle" in line for line in plan.splitlines() if "Window" in line or "Exchange" in line)
    assert not any("hashpartitioning(gene_id" in line and "_w" in line for line in plan.splitlines())


def test_pool_once_for_the_whole_table(spark, sf, monkeypatch):
    pools = []
    monkeypatch.setattr(queries, "_pool", lambda t, f=queries._pool: pools.append(1) or f(t))
    queries.QUERIES["run_summary"](spark, sf)
    assert len(pools) == 1


def test_few_scored_pairs_are_broadcast(spark, monkeypatch):
    pairs = spark.createDataFrame([("a b", "b a"), ("a", "x"), ("a", "x")], "x string, y string")
    plan = lambda: name_similarity(pairs, "x", "y")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan()
    monkeypatch.setattr("hitforge.functions.similarity.BROADCAST_PAIRS", 1)
    assert "broadcast" not in plan() and sorted(r.similarity for r in name_similarity(pairs, "x", "y").collect()) == [0.0, 0.0, 1.0]


def test_numbering_without_attributes(spark, monkeypatch):
    """Ids are dealt out and written without attributes, and parents listed alike are mapped once."""
    rows = [(1, "gene", "ID=a"), (2, "exon", "ID=e;Parent=a,z"), (3, "exon", "ID=e;Parent=a,z"), (4, "exon", "Parent=e")]
    table, plans = spark.createDataFrame(rows, "ord int, ftype string, attrs string"), []
    monkeypatch.setattr(features, "written", lambda df: plans.append(df) or storage.written(df))
    ids = features.new_ids(table, ["ord"])
    assert "attrs" not in plans[0].columns and sorted(map(tuple, ids.collect())) == [("a", "gene_1"), ("e", "exon_2")]
    found = features.parent_remap(table, ids, ["ord"])
    assert sorted(map(tuple, found.collect())) == [(2, "gene_1,z"), (3, "gene_1,z"), (4, "exon_2")]


def test_names_without_terms(spark, sf, monkeypatch):
    """Maps of names and symbols, and their count, come from the choices alone and are those of the whole table."""
    t = Tables(spark, sf)
    whole = storage.written(queries._final(t)).select("gene_id", "gene_symbol", "protein_name").collect()
    monkeypatch.setattr(queries, "_terms", lambda *_: (_ for _ in ()).throw(AssertionError("terms aren't needed")))
    assert sorted(map(tuple, whole)) == sorted(map(tuple, queries._names(t).select("gene_id", "gene_symbol", "protein_name").collect()))
    assert {r.gene_id: r.gene_symbol for r in whole} == {r.gene_id: r.gene_symbol for r in queries.QUERIES["gene2symbol"](spark, sf).collect()}
    assert {r.gene_id for r in whole} == {r.gene_id for r in queries.QUERIES["gene2name"](spark, sf).collect()}
    counts = queries.QUERIES["annotation_output_counts"](spark, sf).first()
    assert tuple(counts) == (sum(bool(r.gene_symbol or r.protein_name) for r in whole), len(whole))


def test_ancestors_as_lists(spark, sf, monkeypatch):
    """Ancestors are put together as lists, a row for each term: no pairs are written, and the terms met are those of the pairs."""
    made = []
    monkeypatch.setattr(ontology, "written", lambda df: made.append(storage.written(df)) or made[-1])
    edges = spark.createDataFrame([(i, i // 2) for i in range(2, 500)] + [(i, i // 3) for i in range(9, 500)] + [(600, 601), (601, 600)], "child int, parent int")
    terms = spark.createDataFrame([(g, t) for g in range(40) for t in (1, 2 + g, 200 + 7 * g, 600, 601)], "gene_id int, go_id int")
    index = ontology.ancestor_index(edges)
    assert len(made) <= 6 and all(df.count() <= 500 for df in made)
    pairs = storage.written(index.select(F.explode("above").alias("ancestor"), F.col("go_id").alias("descendant")))
    want = {c: {c // 2, c // 3} if c >= 9 else {c // 2} for c in range(2, 500)} | {600: {601}, 601: {600}}
    for _ in range(12):
        want = {c: ps.union(*(want.get(p, set()) for p in ps)) for c, ps in want.items()}
    assert sorted(map(tuple, pairs.collect())) == sorted((p, c) for c, ps in want.items() for p in ps)
    met = {tuple(r) for r in ontology.specific_intersection(terms, index).collect()}
    assert met and met == {tuple(r) for r in ontology.specific_intersection(terms, pairs).collect()}


def test_terms_dealt_out_before_distinct(spark, monkeypatch):
    """With a number of hits, terms are dealt out by key in as many parts as it asks for, and made distinct there alone."""
    hits = spark.createDataFrame([(i % 700, f"sp|P{i % 90}|X_SYN") for i in range(5000)], "gene_id int, subject_id string")
    go_map = spark.createDataFrame([(f"P{i % 80}", f"GO:{i % 37}") for i in range(400)], "accession string, go_id string")
    monkeypatch.setattr(ontology, "TASK_HITS", 500)
    dealt = ontology.hits_go_terms(hits, go_map, ["gene_id"], 5000)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(gene_id" in plan and ", 10), REPARTITION_BY_NUM" in plan and "hashpartitioning(gene_id, go_id" not in plan.replace("#", " ").replace("  ", " ")
    assert not any("HashAggregate" in line for line in plan.split("REPARTITION_BY_NUM")[1].splitlines())
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, ontology.hits_go_terms(hits, go_map, ["gene_id"]).collect()))


def test_selected_hits_without_titles(spark, sf, monkeypatch):
    """The whole annotation shuffles no title either, and hits are selected once before they are clustered."""
    t, made = Tables(spark, sf), []
    plan = queries.selected_hits(t.ph.drop("gene_id"), t.pt, queries.Params(evalue=queries.EVALUE, rules=queries.RULES))._jdf.queryExecution().executedPlan().toString()
    assert not any("stitle" in line for line in plan.splitlines() if "Window" in line or "Exchange" in line)
    monkeypatch.setattr(queries, "written", lambda df: made.append(df) or storage.written(df))
    found = queries.QUERIES["cluster_hits"](spark, sf)
    assert len(made) == 1 and "lineitem" not in "".join(found.inputFiles())
