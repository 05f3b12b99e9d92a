"""Text expressions against their stated results."""

from pyspark.sql import functions as F

from hitforge.functions import names as N
from hitforge.functions.rules import parse_rules


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_titles(spark):
    name = lambda title: one(spark, N.name_from_title(F.lit(title), F.lit("id1")))
    assert name("sp|P1|AB_X Kinase beta OS=Mus sp. GN=Kb PE=1 SV=2") == "sp|P1|AB_X Kinase beta"
    assert name("Kinase [sic] beta [Mus sp.]") == "Kinase"
    assert name("Kinase {ECO:0001} GN=a PE=1 SV=3") == "Kinase"
    assert name("") == "id1"
    assert one(spark, N.symbol_from_title(F.lit("x GN=Abc1 GN=d"))) == "Abc1"
    assert one(spark, N.symbol_from_title(F.lit(None).cast("string"))) == ""


def test_rules(spark):
    rules = parse_rules(spark, ["# note", "", "strip_regex: ^probable\\s+", "orf", "Uncharacterized protein", "regex: ^unknown", "regex: (", "symbol_regex: ^loc\\d+$"])
    assert (rules.exact, rules.substring, rules.regex) == (("orf",), ("uncharacterized protein",), ("^unknown",))
    assert one(spark, rules.clean(F.lit("Probable  kinase, "))) == "kinase"
    assert one(spark, rules.clean(F.lit("probable "))) in (None, "probable")
    for bad in ("ORF", "an UNCHARACTERIZED protein x", "Unknown thing", ""):
        assert one(spark, rules.is_bad_name(F.lit(bad)))
    assert not one(spark, rules.is_bad_name(F.lit("orf1 kinase")))
    assert one(spark, rules.valid_symbol(F.lit("LOC12"))) == ""
    assert {r.kind for r in rules.table(spark).collect()} == {"strip", "exact", "substring", "regex", "symbol"}


def test_accented_case(spark):
    assert one(spark, N.bad_regex(F.lit("É x"), ["^é"]))
    assert one(spark, N.tokens(F.lit("béta-2 α"))) == ["béta", "2", "α"]


def test_accessions(spark):
    keys = lambda s: one(spark, N.extract_accessions(F.lit(s)))
    assert keys("sp|P1|AB_MOUSE") == ["sp|P1|AB_MOUSE", "P1", "AB"]
    assert keys("ref|NP_001.2|") == ["ref|NP_001.2|", "NP_001.2", "", "NP_001.2", "NP_001"]
    assert keys("plain") == ["plain"]


def test_headers_and_attributes(spark):
    assert one(spark, N.header_tag(F.lit("t1 x gene=g1 gene=g2"), "gene=")) == "g1"
    assert one(spark, N.header_tag(F.lit("t1 gene="), "gene=")) == ""
    assert one(spark, N.header_tag(F.lit("gene=g"), "gene=")) is None
    assert one(spark, N.clean_header(F.lit("t1 Name=a product=long name of it note=x"))) == "t1 note=x"
    parsed = one(spark, N.parse_attributes(F.lit("ID=a; x ;k=1=2;ID=b;")))
    assert [(p.k, p.v) for p in parsed] == [("ID", "b"), ("k", "1=2")]
    assert one(spark, N.first_attr(F.lit("geneID=z;ID=a"), "ID")) == "z"
    assert one(spark, N.strip_db_prefix(F.lit("sp|Q1|A_B name"))) == "name"
    assert one(spark, N.strip_db_prefix(F.lit("sp|Q1|A_B "))) == "sp|Q1|A_B "
