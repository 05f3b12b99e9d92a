"""Lookups in tables whose keys have several lines, against their SQL and by hand."""

import duckdb
import pytest

from hitforge.functions.rules import RuleSet
from hitforge.operators import clusters
from hitforge.plans.queries import ORACLE_SQL, QUERIES

IDS = [("P1", "7", 1), ("P1", "8", 2), ("P1", "9", 3), ("P2", "6", 4), ("P2", "9", 5), ("P3", "5", 6)]
INFO = [("7", "old", 1), ("8", "late", 2), ("6", "LOC1", 3)]


def tables(spark):
    return spark.createDataFrame(IDS, "accession string, gene_id string, ord int"), spark.createDataFrame(INFO, "gene_id string, symbol string, ord int")


def test_every_line_of_a_key(spark):
    wanted = spark.createDataFrame([("P1",), ("P3",), ("P4",)], "accession string")
    found = lambda every: sorted((r.accession, r.ncbi_symbol) for r in clusters.xref_symbol(wanted, *tables(spark), every).collect())
    assert found(True) == [("P1", ""), ("P1", "late"), ("P1", "old"), ("P3", ""), ("P4", "")]
    assert found(False) == [("P1", ""), ("P3", ""), ("P4", "")]


def test_last_good_line_of_a_key(spark):
    hits = spark.createDataFrame([(1, "P1|P3"), (2, "P2|P1"), (3, "P3|P2"), (4, "P4")], "gene_id int, subject_id string")
    rules = RuleSet(symbol=(r"^loc\d",))
    found = lambda every: {r.gene_id: r.xref_symbol for r in clusters.xref_first_valid_symbol(hits, *tables(spark), rules, every).collect()}
    assert found(True) == {2: "late"}
    hits = hits.replace({"P1|P3": "P1"})
    assert found(True) == {1: "late", 2: "late"} and found(False) == {}


@pytest.fixture(scope="module")
def cut(spark, tmp_path_factory):
    """Tables whose part keys of seven digits give accessions of six that others have too."""
    folder = tmp_path_factory.mktemp("cut")
    con = duckdb.connect()
    source = "/root/testdata/sf0.001"
    for name in ("nation", "orders", "lineitem", "part"):
        table = f"'{source}/{name}.parquet'"
        if name == "part":
            rows = " UNION ALL ".join(f"SELECT * REPLACE (p_partkey + {k} AS p_partkey) FROM {table}" for k in (0, 100000, 1000000))
        elif name == "lineitem":
            rows = f"SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN l_partkey + 100000 ELSE l_partkey END AS l_partkey) FROM {table}"
        else:
            rows = f"SELECT * FROM {table}"
        con.sql(f"COPY ({rows}) TO '{folder}/{name}.parquet' (FORMAT PARQUET)")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    con.sql("SET threads = 1")  # of lines with the same place SQL then takes the last one
    return str(folder), con


@pytest.mark.parametrize("name", ["xref_symbol_lookup", "xref_first_valid_symbol"])
def test_lookups_with_cut_keys(spark, cut, name):
    folder, con = cut
    got = QUERIES[name](spark, folder)
    want = con.sql(ORACLE_SQL[name])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())


#: Where the SQL leaves open which of a key's lines is taken.
OPEN = "min_by(symbol, pos) AS xsym FROM (SELECT k.gene_id, pos, i.symbol"


@pytest.fixture(scope="module")
def tied(spark, tmp_path_factory):
    """Tables whose accessions all have ten lines, most of them of parts without a valid symbol, so that many genes look theirs up."""
    folder = tmp_path_factory.mktemp("tied")
    con = duckdb.connect()
    shifted = {
        "part": "p_partkey + 1000000 AS p_partkey, CASE WHEN p_partkey % 5 > 0 THEN 'Brand#12' ELSE p_brand END AS p_brand",
        "lineitem": "l_partkey + 1000000 AS l_partkey",
    }
    for name in ("nation", "customer", "orders", "lineitem", "part"):
        table = f"SELECT *{f' REPLACE ({shifted[name]})' if name in shifted else ''} FROM '/root/testdata/sf0.001/{name}.parquet'"
        con.sql(f"COPY ({table}) TO '{folder}/{name}.parquet' (FORMAT PARQUET)")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", ["symbol_concordance_recalc", "annotation_evidence"])
def test_symbols_of_tied_lines(spark, tied, name):
    """Of the lines among which its SQL may take any, the last good one is taken; all else is as in the SQL."""
    folder, con = tied
    assert ORACLE_SQL[name].count(OPEN) == 1
    last = ORACLE_SQL[name].replace(OPEN, "min_by(symbol, pos * 1000000000 - ord) AS xsym FROM (SELECT k.gene_id, pos, d.ord, i.symbol")
    got, want = QUERIES[name](spark, folder), con.sql(last)
    rows = sorted(map(tuple, got.select(*want.columns).collect()))
    assert rows and rows == sorted(want.fetchall())
