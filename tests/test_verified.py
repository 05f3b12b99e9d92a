"""Operators that SQL can't express, and rules on repeated keys, against plain Python."""

import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from hitforge import storage
from hitforge.functions.rules import RuleSet
from hitforge.functions.similarity import name_similarity, names_alike, pair_alike, similarity_pairs, within_gene_pairs
from hitforge.operators import clusters, features, hits, metrics, ontology, propagation
from hitforge.sources import readers, sinks
from hitforge.streaming.front import clean_hits

WORDS = ["kinase", "beta", "protein", "zinc", "finger", "like", "tide", "diet", "Kinase", "  beta"]


def norm(name):
    return re.sub(r"\s+", " ", (name or "").lower()).strip()


def pool(seed, genes=14, most=14):
    """(gene_id, hit_idx, member_pos, transcript_id, subject_id, bitscore, name, symbol) of invented winning clusters."""
    dice, rows = random.Random(seed), []
    for g in range(genes):
        for i in range(dice.randint(1, most)):
            subject = f"{dice.choice(['sp', 'tr'])}|P{dice.randint(1, 60)}|X_Y"
            rows.append((g, i, i, f"t{g}{i % 3}", subject, float(dice.randint(1, 40)), " ".join(dice.sample(WORDS, dice.randint(1, 3))), dice.choice(["", "", "Kin", "kin", "zf"])))
    return rows


HITS = "gene_id bigint, hit_idx bigint, member_pos bigint, transcript_id string, subject_id string, bitscore double, name string, symbol string"


def plain_choice(own):
    """Name, symbol and the positions of the winning symbol group, of one gene's winning cluster."""
    groups = defaultdict(list)
    for h in own:
        if h[7]:
            groups[h[7].lower()].append(h)
    usable = {k: v for k, v in groups.items() if len(v) >= 2} or groups
    won = max(usable.values(), key=lambda v: (sum(h[5] for h in v) / len(v), -min(h[2] for h in v))) if usable else None
    if won and len(won) == 1 and len(own) >= 10 and 1 / len(own) < 0.1:
        won = None
    group = won or own
    best = max(group, key=lambda h: (h[5], -h[2]))
    return best[6], best[7].lower() if won else "", sorted(group, key=lambda h: (-h[5], h[2]))


def test_concordance_and_terms(spark):
    """Concordance of names, the supplement, terms and labels of each gene, step by step as they are stated."""
    rows = pool(3)
    won = storage.written(spark.createDataFrame(rows, HITS))
    dice = random.Random(4)
    # a tree of 60 terms, two namespaces, and for most accessions a few terms
    parents = {i: i // 2 for i in range(2, 61)}
    term = "GO:{:07d}".format
    spaces = {i: "biological_process" if i % 3 else "molecular_function" for i in range(1, 61)}
    go = {f"P{p}": {dice.randint(1, 62) for _ in range(dice.randint(1, 4))} for p in range(1, 61) if p % 4}
    go_map = spark.createDataFrame([(a, term(i)) for a, ids in go.items() for i in ids], "accession string, go_id string")
    terms = spark.createDataFrame([(term(i), n) for i, n in spaces.items()], "id string, namespace string")
    edges = spark.createDataFrame([(term(c), term(p)) for c, p in parents.items()], "child string, parent string")
    chosen = storage.written(clusters.select_name_symbol(won, RuleSet()))
    got = {r.gene_id: r for r in chosen.collect()}
    names = {r.gene_id: r.name_concordance for r in propagation.name_concordance(won, chosen, 0.5).collect()}
    extra = {(r.gene_id, r.hit_idx) for r in ontology.supplement_hits(won, chosen, 0.5).collect()}
    all_terms, specific, labels = ontology.gene_go_terms(won, chosen, go_map, terms, ontology.closure(edges), ("BP",), 0.5)
    all_terms, specific = ({(r.gene_id, r.go_id) for r in df.collect()} for df in (all_terms, specific))
    labels = {r.gene_id: r.go_source for r in labels.collect()}

    def above(i):
        return set() if i not in parents else {parents[i]} | above(parents[i])

    want_terms, want_specific, want_labels, want_extra = set(), set(), {}, set()
    for g in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == g]
        name, symbol, group = plain_choice(own)
        assert (got[g].protein_name, got[g].gene_symbol) == (name, symbol)
        like = [names_alike(norm(name), norm(h[6])) >= 0.5 for h in own]
        assert abs(names[g] - sum(like) / len(own)) < 1e-12
        of = lambda h: go.get(h[4].split("|")[1], set())
        found = set().union(*(of(h) for h in group[:5]))
        label = "cluster_top5" if found else ""
        for h in own:
            if h in group[:5] or not h[4].startswith("sp|"):
                continue
            if (symbol and h[7].lower() == symbol) or (norm(h[6]) and names_alike(norm(name), norm(h[6])) >= 0.5):
                want_extra.add((g, h[1]))
                if of(h) - found:
                    label = "cluster_top5+swissprot_supplement"
                found |= of(h)
        if label:
            want_labels[g] = label
        found = {i for i in found if spaces.get(i) == "biological_process"}
        want_terms |= {(g, term(i)) for i in found}
        want_specific |= {(g, term(i)) for i in found if not any(i in above(j) for j in found)}
    assert extra == want_extra and labels == want_labels and all_terms == want_terms and specific == want_specific
    assert any("supplement" in x for x in labels.values()) and want_specific != want_terms
    below = {(r.gene_id, r.go_id): r.n_below for r in ontology.specific_intersection(spark.createDataFrame(sorted(want_terms), "gene_id bigint, go_id string"), ontology.closure(edges)).collect()}
    assert set(below) == want_terms - want_specific


def test_closure_by_doubling(spark, monkeypatch):
    """Chains, a tree, a graph with cycles: all paths, in as many rounds as the logarithm of the deepest one."""
    dice = random.Random(2)
    graphs = {
        "chain": [(i, i + 1) for i in range(30)], "tree": [(i, i // 2) for i in range(2, 200)], "cycle": [(i, (i + 1) % 7) for i in range(7)] + [(9, 3)],
        "mixed": [(dice.randint(0, 25), dice.randint(0, 25)) for _ in range(40)],
    }
    for pairs in graphs.values():
        above = defaultdict(set)
        for c, p in pairs:
            above[c].add(p)
        for _ in range(40):
            for c in list(above):
                above[c] |= set().union(*(above[p] for p in above[c] if p in above))
        rounds = []
        monkeypatch.setattr(ontology, "written", lambda df: rounds.append(1) or storage.written(df))
        got = {(r.descendant, r.ancestor) for r in ontology.closure(spark.createDataFrame(pairs, "child int, parent int")).collect()}
        assert got == {(c, p) for c, ps in above.items() for p in ps}
        assert len(rounds) <= 2 * 6 + 1


def test_specific_terms_go_upwards(spark):
    """A gene with the root has as many rows between the joins as terms times depth, not as the root has descendants."""
    edges = spark.createDataFrame([(i, i // 2) for i in range(2, 2001)], "child int, parent int")
    terms = spark.createDataFrame([(g, t) for g in range(50) for t in (1, 3, 1000 + 7 * g)], "gene_id int, go_id int")
    paths = storage.written(ontology.closure(edges))
    met = ontology.specific_intersection(terms, paths)
    want = {(g, a): sum(1 for d in own if a in {d >> k for k in range(1, 12)}) for g in range(50) for own in [(1, 3, 1000 + 7 * g)] for a in own}
    assert {(r.gene_id, r.go_id): r.n_below for r in met.collect()} == {k: v for k, v in want.items() if v}
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode(above") == 1 and "descendant" not in plan
    expanded = terms.join(ontology.ancestor_lists(paths), "go_id").agg(F.sum(F.size("above"))).first()[0]
    assert expanded <= 150 * 11


def test_similarity_of_pairs(spark):
    rows = pool(8, genes=5, most=9)
    table = spark.createDataFrame(rows, HITS)
    pairs = {(r.gene_id, r.i, r.j): r for r in within_gene_pairs(table).collect()}
    assert set(pairs) == {(a[0], a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1]}
    of = {(r[0], r[1]): r for r in rows}
    for r in name_similarity(within_gene_pairs(table), "name_i", "name_j").collect():
        assert r.similarity == names_alike(norm(of[r.gene_id, r.i][6]), norm(of[r.gene_id, r.j][6]))
    scored = similarity_pairs(table).collect()
    assert len(scored) == len(pairs)
    for r in scored:
        a, b = of[r.gene_id, r.i], of[r.gene_id, r.j]
        assert abs(r.similarity - pair_alike(norm(a[6]), a[7].lower(), norm(b[6]), b[7].lower())) < 1e-12


def test_last_record_wins(spark, tmp_path):
    (tmp_path / "f.fa").write_text(">t1 gene=g1\nAC\nGT\n>t2 gene=g1\nA\n>t1 gene=g2\nC\n>t3 gene=g3\n>t3 gene=g3\nGG\n\nT\n")
    records = storage.written(readers.read_fasta(spark, str(tmp_path / "f.fa")))
    table = spark.createDataFrame([("t1",), ("t2",), ("t9",)], "transcript_id string")
    assert {(r.transcript_id, r.gene_id) for r in hits.transcript_to_gene(table, records).collect()} == {("t1", "g2"), ("t2", "g1"), ("t9", "t9")}
    assert hits.transcript_to_gene(table, records).count() == 3
    assert hits.fasta_stats(records).first().asDict() == {"sequences": 5, "genes": 3, "transcripts": 3, "multi_isoform_genes": 2}
    ann = spark.createDataFrame([("g2", "kinase", "kin")], "gene_id string, protein_name string, gene_symbol string")
    lines = [r.value for r in features.annotate_fasta(records, ann).orderBy("ord").collect()]
    assert lines == [">t1 gene=g1 Name=kin product=kinase\nAC\nGT", ">t2 gene=g1\nA", ">t1 gene=g2 Name=kin product=kinase\nC", ">t3 gene=g3", ">t3 gene=g3\nGG\n\nT"]
    (tmp_path / "i.tsv").write_text("P1\tx\t7\nP2\tx\t8\nP1\tx\t9\n")
    (tmp_path / "n.tsv").write_text("1\t7\told\n1\t9\tfirst\n1\t9\tlast\n1\t8\t-\n")
    ids, info = readers.read_id_map(spark, str(tmp_path / "i.tsv")), readers.read_gene_info(spark, str(tmp_path / "n.tsv"))
    found = clusters.xref_symbol(spark.createDataFrame([("P1",), ("P2",), ("P3",)], "accession string"), ids, info).collect()
    assert sorted((r.accession, r.ncbi_symbol) for r in found) == [("P1", "last"), ("P2", ""), ("P3", "")]


def test_plans_hold_each_pattern_once(spark, sf):
    """Cleaning of names isn't repeated for each mention of the name."""
    from hitforge.plans.queries import QUERIES

    for name in ("filter_hits", "topn_per_transcript"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("GN=\\S+, ") <= 3 and plan.count("regexp_replace(") < 40, plan.count("regexp_replace(")


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("g1", 2.675, None), ("g2", 0.125, 'a "b"')], "gene_id string, score double, note string")
    sinks.write_tsv(sinks.formatted(rows), str(tmp_path / "t"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "t")).collect() if not r.value.startswith("gene_id")) == ["g1\t2.67\t", 'g2\t0.12\ta "b"']
    lines = spark.createDataFrame([("b", 2), ("a", 1), ("", 3)], "value string, ord int").repartition(3)
    sinks.write_lines(lines, str(tmp_path / "l"))
    assert [r.value for r in spark.read.text(str(tmp_path / "l")).collect()] == ["a", "b", ""]
    feats = spark.createDataFrame([(1, "s", ".", "my gene", "1", "2", ".", "+", ".", "ID=a"), (2, "s", ".", "CDS", "1", "2", ".", "+", ".", "ID=c;Parent=a")], "ord int, seqid string, source string, ftype string, start string, end string, score string, strand string, phase string, attrs string")
    out = [r.value for r in sinks.renumbered_lines(features.renumber_gff3(feats, ["ord"])).orderBy("ord").collect()]
    assert [v.split("\t")[-1] for v in out] == ["ID=my_gene_1", "ID=CDS_1;Parent=my_gene_1"] and all(v.count("\t") == 8 for v in out)
    summary = metrics.run_summary(spark.createDataFrame([(3, 2)], "a int, b int"), metrics.labelled(spark.createDataFrame([("x", 1.5)], "k string, mean double"), "k", "p_"))
    assert [r.value for r in metrics.summary_text(summary).collect()] == ["a\t3.0", "b\t2.0", "p_x_mean\t1.5"]


def test_hits_on_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = "\t".join(["t1", "sp|P1|A_B", "90", "1", "1", "1", "1", "1", "1", "1", "{}", "50", "{} OS=x GN=Kin"])
    (tmp_path / "in" / "a.tsv").write_text("\n".join([line.format("1e-9", "Zinc kinase"), line.format("0.5", "late"), line.format("1e-9", "none")]) + "\n")
    schema = "transcript_id string, subject_id string, pident double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int, evalue double, bitscore double, stitle string"
    stream = clean_hits(spark.readStream.schema(schema).option("sep", "\t").csv(str(tmp_path / "in")))
    run = stream.writeStream.format("memory").queryName("cleaned").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    run.awaitTermination(60)
    assert [(r.name, r.symbol) for r in spark.table("cleaned").collect()] == [("Zinc kinase", "Kin")]


def test_shared_folder(spark):
    table = storage.written(spark.range(5))
    assert table.count() == 5 and storage.tables_dir(spark) in table.inputFiles()[0]
    assert spark.conf.get("spark.checkpoint.dir") in storage.shared_dir(spark)
