"""Tables of the given star schema read as hits, genes, ontology, cross-references, annotation lines and features.

The SQL runs alike in Spark and in other engines; ``{name}`` stands for a table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from hitforge.functions.rules import RuleSet

GO = "concat('GO:', lpad(CAST({} AS VARCHAR(20)), 7, '0'))"

PROXIES = {
    "ph": """SELECT l_orderkey AS transcript_id, o_custkey AS gene_id,
        concat(CASE l_returnflag WHEN 'A' THEN 'sp' WHEN 'R' THEN 'tr' ELSE 'xx' END,
               '|P', lpad(CAST(l_partkey AS VARCHAR(20)), 6, '0'), '|', p_type, '_SYN') AS subject_id,
        l_discount AS evalue, l_extendedprice AS bitscore,
        concat(CASE l_returnflag WHEN 'A' THEN 'sp' WHEN 'R' THEN 'tr' ELSE 'xx' END,
               '|P', lpad(CAST(l_partkey AS VARCHAR(20)), 6, '0'), '|', p_type, '_SYN ', p_name,
               ' OS=Syn sp. OX=1 GN=', replace(p_brand, '#', ''), ' PE=1 SV=1') AS stitle,
        concat(lpad(CAST(l_orderkey AS VARCHAR(20)), 12, '0'), lpad(CAST(l_linenumber AS VARCHAR(20)), 4, '0'),
               lpad(CAST(l_partkey AS VARCHAR(20)), 12, '0'), lpad(CAST(l_suppkey AS VARCHAR(20)), 12, '0')) AS ord
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey""",
    "pt": "SELECT o_orderkey AS transcript_id, o_custkey AS gene_id, o_orderkey AS ord FROM {orders}",
    # each order's lines are records of one transcript, most of them with other genes; the last one counts
    "ptr": """SELECT l_orderkey AS transcript_id, l_suppkey AS gene_id, concat(lpad(CAST(l_linenumber AS VARCHAR(20)), 4, '0'),
        lpad(CAST(l_partkey AS VARCHAR(20)), 12, '0'), lpad(CAST(l_suppkey AS VARCHAR(20)), 12, '0')) AS ord FROM {lineitem}""",
    # accessions and gene ids that occur several times
    "px_ids": """SELECT concat('P', lpad(CAST(l_partkey AS VARCHAR(20)), 6, '0')) AS accession, CAST(l_suppkey % 40 AS VARCHAR(20)) AS gene_id,
        concat(lpad(CAST(l_orderkey AS VARCHAR(20)), 12, '0'), lpad(CAST(l_linenumber AS VARCHAR(20)), 4, '0'), lpad(CAST(l_suppkey AS VARCHAR(20)), 12, '0')) AS ord FROM {lineitem}""",
    "px_infos": "SELECT CAST(s_suppkey % 40 AS VARCHAR(20)) AS gene_id, s_name AS symbol, s_suppkey AS ord FROM {supplier}",
    "ptp": "SELECT o_orderkey AS transcript_id, o_custkey AS gene_id FROM {orders} WHERE o_orderstatus <> 'P'",
    "pu": "SELECT c_custkey AS gene_id, c_custkey AS gene_ord FROM {customer}",
    "pg": f"""SELECT concat('P', lpad(CAST(p_partkey AS VARCHAR(20)), 6, '0')) AS accession,
        concat({GO.format("p_size")}, ';', {GO.format("p_partkey")}) AS go_terms FROM {{part}}""",
    "po_edges": f"""SELECT {GO.format("p_partkey")} AS child, {GO.format("CAST((p_partkey - p_partkey % 2) / 2 AS BIGINT)")} AS parent
        FROM {{part}} WHERE p_partkey > 1""",
    "po_terms": f"""SELECT {GO.format("p_partkey")} AS id, CASE p_partkey % 3 WHEN 0 THEN 'biological_process'
        WHEN 1 THEN 'molecular_function' ELSE 'cellular_component' END AS namespace FROM {{part}}""",
    "po_alt": f"""SELECT concat('GO:A', CAST(p_partkey AS VARCHAR(20))) AS alt_id, {GO.format("p_partkey")} AS id FROM {{part}} WHERE p_size < 25""",
    "px_id": """SELECT concat('P', lpad(CAST(p_partkey AS VARCHAR(20)), 6, '0')) AS accession,
        CASE WHEN p_partkey % 3 = 0 THEN '' ELSE CAST(p_partkey % 40 AS VARCHAR(20)) END AS gene_id, p_partkey AS ord FROM {part}""",
    "px_info": "SELECT CAST(n_nationkey AS VARCHAR(20)) AS gene_id, CASE WHEN n_nationkey % 7 = 0 THEN '-' ELSE n_name END AS symbol, n_nationkey AS ord FROM {nation}",
    "pa": """SELECT CASE WHEN value < 50 THEN 'UniProtKB' ELSE 'Other' END AS db, CAST(user_id AS VARCHAR(20)) AS accession,
        concat('GO:', lpad(regexp_extract(props, '([0-9]+)', 1), 7, '0')) AS go_id, event_type AS evidence,
        concat('taxon:', CAST(event_id % 5 AS VARCHAR(20)), '|taxon:', CAST(event_id % 7 AS VARCHAR(20))) AS taxon FROM {events}""",
    "pf": """SELECT concat('type ', l_returnflag) AS ftype,
        concat('ID=', l_returnflag, '-', CAST(l_orderkey AS VARCHAR(20)), ';Parent=A-', CAST(l_orderkey AS VARCHAR(20)), ',R-', CAST(l_orderkey AS VARCHAR(20))) AS attrs,
        l_orderkey, l_linenumber, l_partkey, l_suppkey FROM {lineitem}""",
    "pc": """SELECT concat(CAST(conv_id AS VARCHAR(20)), '-', CAST(turn AS VARCHAR(20)), ' gene=', CAST(conv_id AS VARCHAR(20)), ' Name=old product=long ', role, ' note=', role) AS header,
        conv_id, turn FROM {conversations}""",
}

#: What file order means for features.
FEATURE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
EVALUE, TOP_N = 0.05, 2
RULES = RuleSet(strip=(r"^(?:sp|tr|xx)\|\w+\|\w+\s+", r"^small\s+"), exact=("ring",), substring=("old gear",), regex=("^cold",), symbol=(r"^Brand1\d$",))


class Tables:
    """The tables of one folder, and the proxies over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in PROXIES:
            return self.table(name)
        return self.sql(PROXIES[name])

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{t: self.table(t) for t in set(re.findall(r"\{(\w+)\}", text))})


def ctes(*names: str) -> str:
    """The proxies as common table expressions over tables of those names."""
    return ", ".join(f"{n} AS ({re.sub(r'[{}]', '', PROXIES[n])})" for n in names)
