"""Native files: readers, rewriting, sinks."""

import pytest
from pyspark.sql import functions as F

from hitforge.operators import features, hits, ontology, refdata
from hitforge.sources import readers, sinks


def put(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def hit(query, subject, evalue, bits, title=None):
    return "\t".join([query, subject, "90", "1", "1", "1", "1", "1", "1", "1", evalue, bits] + ([title] if title is not None else []))


def test_hits(spark, tmp_path):
    lines = [hit("t1", "sp|P1|A_B", "1e-5", "50", "one\ttwo"), hit("t1", "tr|P2|C_D", "nan", "40"), hit("t2", "xx", "0.1", "30", "x"), "a\tb\tc"]
    rows = readers.read_hits(spark, put(tmp_path, "h.tsv", "\n".join(lines) + "\n"))
    got = {r.subject_id: r for r in rows.collect()}
    assert len(got) == 3 and got["sp|P1|A_B"].stitle == "one\ttwo" and got["tr|P2|C_D"].stitle == ""
    assert {r.subject_id for r in hits.hit_evalue_filter(rows).collect()} == {"sp|P1|A_B", "tr|P2|C_D"}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_hits(spark, put(tmp_path, "bad.tsv", hit("t", "s", "x", "1", "t"))).collect()


def test_fasta(spark, tmp_path):
    path = put(tmp_path, "f.fa", ">t1 gene=g1 Name=old\r\nACG>T\r\nAA\r\n>t2\nCC\n>t3 gene=\nGG\n>t1 gene=g2\nTT\n")
    rows = readers.read_fasta(spark, path)
    got = sorted((r.transcript_id, r.gene_id, r.sequence) for r in rows.collect())
    assert got == [("t1", "g1", "ACG>TAA"), ("t1", "g2", "TT"), ("t2", "t2", "CC"), ("t3", "", "GG")]
    ann = spark.createDataFrame([("g2", "sp|Q|A_B kinase", "kin")], "gene_id string, protein_name string, gene_symbol string")
    lines = [r.value for r in features.annotate_fasta(rows, ann).orderBy("ord").collect()]
    assert lines[0] == ">t1 gene=g1 Name=kin product=kinase\nACG>T\nAA" and lines[1] == ">t2\nCC"
    assert hits.fasta_stats(rows).first().asDict() == {"sequences": 4, "genes": 4, "transcripts": 3, "multi_isoform_genes": 0}


def test_obo_and_terms(spark, tmp_path):
    obo = "format: 1\n\n[Term]\nid: GO:1\nname: root\nnamespace: biological_process\n\n[Term]\nid: GO:2\nalt_id: GO:9\nname: b\nnamespace: biological_process\nis_a: GO:1 ! root\n\n[Typedef]\nid: part_of\nis_a: GO:1\n\n[Term]\nid: GO:3\nname: c\nnamespace: biological_process\nis_a: GO:2 ! b\nis_a: GO:1\n\n[Term]\nid: GO:4\nname: old\nnamespace: biological_process\nis_obsolete: true\nis_a: GO:3\n"
    terms, edges, alts = readers.read_obo(spark, put(tmp_path, "o.obo", obo))
    assert {r.id for r in terms.collect()} == {"GO:1", "GO:2", "GO:3"}
    assert [(r.alt_id, r.id) for r in alts.collect()] == [("GO:9", "GO:2")]
    paths = ontology.closure(edges)
    assert {(r.ancestor, r.descendant) for r in paths.collect()} == {("GO:1", "GO:2"), ("GO:2", "GO:3"), ("GO:1", "GO:3"), ("GO:3", "GO:4"), ("GO:2", "GO:4"), ("GO:1", "GO:4")}
    own = spark.createDataFrame([("g", "GO:1"), ("g", "GO:3"), ("h", "GO:1")], "gene_id string, go_id string")
    assert {(r.gene_id, r.go_id) for r in ontology.most_specific_terms(own, paths).collect()} == {("g", "GO:3"), ("h", "GO:1")}


def test_maps(spark, tmp_path):
    rows = readers.read_go_map(spark, put(tmp_path, "m.tsv", "P1\tGO:1; GO:2,XX:3\nP1\tGO:2\tGO:4\nP2\n"))
    assert {(r.accession, r.go_id) for r in rows.collect()} == {("P1", "GO:1"), ("P1", "GO:2"), ("P1", "GO:4")}
    gaf = "!c\n" + "\n".join("\t".join([db, acc, "s", q, go, "r", ev, "", "", "", "", "", tax]) for db, acc, q, go, ev, tax in [("UniProtKB", "P1", "NOT|x", "GO:1", "IEA", "taxon:1|taxon:2"), ("Other", "P1", "", "GO:2", "IEA", "taxon:1"), ("UniProtKB", "P2", "", "GO:3", "EXP", "taxon:12")]) + "\nshort\tline\n"
    table = readers.read_gaf(spark, put(tmp_path, "g.gaf", gaf))
    assert {(r.accession, r.go_id) for r in refdata.build_go_map(table, ["2"]).collect()} == {("P1", "GO:1")}
    assert refdata.build_go_map(table, None, ["EXP"]).collect()[0].accession == "P2"
    ids = readers.read_id_map(spark, put(tmp_path, "i.tsv", "P1\tx\t7\nP2\tx\t\nP1\tx\t8\n"))
    info = readers.read_gene_info(spark, put(tmp_path, "n.tsv", "#h\n9\t7\tabc\n9\t8\t-\n"))
    assert ids.count() == 2 and [r.symbol for r in info.collect()] == ["abc"]
    folder = str(tmp_path / "ref")
    refdata.build_reference_tables(folder, refdata.build_go_map(table), ids, info)
    refdata.build_reference_tables(folder, refdata.build_go_map(table).limit(0), ids, info)
    assert readers.read_reference_table(spark, f"{folder}/go_mapping").count() == 2
    assert readers.read_reference_table(spark, f"{folder}/ncbi_idmapping").first().gene_id == "8"
    sinks.write_go_map(refdata.go_map_lines(rows), str(tmp_path / "out"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ["P1\tGO:1;GO:2;GO:4"]


def test_gff3(spark, tmp_path):
    def line(ftype, attrs):
        return "\t".join(["s", ".", ftype, "1", "2", ".", "+", ".", attrs])

    text = ["##gff", line("gene", "ID=g1;gene_id=g1"), line("gene", "x=1"), line("mRNA", "ID=t1;Parent=g1"), line("exon", "ID=e;Parent=t1;z=1"), line("intron", "ID=i;Parent=t1"), line("other", "k=1;gene_id=g1;k=2"), line("intron", "a"), "a\tb", ""]
    rows = readers.read_gff3(spark, put(tmp_path, "a.gff3", "\n".join(text) + "\n"))
    ann = spark.createDataFrame([("g1", "kinase", "kin")], "gene_id string, protein_name string, gene_symbol string")
    got = [r.value for r in features.annotate_gff3(rows, ann).orderBy("ord").collect()]
    assert [v.split("\t")[-1] for v in got[1:8]] == ["ID=g1;Name=kin;product=kinase", "ID=None", "ID=t1;Parent=g1;Name=kin;product=kinase", "ID=e;Parent=t1", "Parent=t1", "k=2", "."]
    assert (got[0], got[8], got[9]) == ("##gff", "a\tb", "")
    assert features.gff3_gene_counts(rows, ann).first().asDict() == {"annotated": 1, "total": 2}


def test_renumber(spark, tmp_path):
    rows = spark.createDataFrame([(1, "my gene", "ID=a"), (2, "CDS", "ID=c;Parent=a"), (3, "CDS", "ID=c;Parent=a,zz"), (4, "my gene", "ID=b"), (5, "CDS", "note=1")], "ord int, ftype string, attrs string")
    got = {r.ord: r.new_attrs for r in features.renumber_gff3(rows, ["ord"]).collect()}
    assert got == {1: "ID=my_gene_1", 2: "ID=CDS_2;Parent=my_gene_1", 3: "ID=CDS_2;Parent=my_gene_1,zz", 4: "ID=my_gene_2", 5: "."}
    ids = features.last_id_wins(features.renumber_ids(rows, ["ord"]), ["ord"])
    assert [r.parent for r in features.unmatched_parents(rows, ids).collect()] == ["zz"]
    assert {r.ftype: r.n for r in features.feature_type_counts(rows).collect()} == {"my_gene": 2, "CDS": 2}
    window = rows.filter("attrs like 'ID=%'").selectExpr("ord", "concat(replace(ftype, ' ', '_'), '_', row_number() over (partition by ftype order by ord)) as w")
    assert features.renumber_ids(rows, ["ord"]).join(window, "ord").filter(F.col("new_id") != F.col("w")).count() == 0
