"""SQL for comparison: the same steps as common table expressions for DuckDB."""

from __future__ import annotations

from hitforge.plans.proxies import EVALUE, TOP_N, ctes

TOKENS = r"[\p{L}\p{N}_]+"
#: Description in a title.
TITLE = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(split_part(stitle, ' OS=', 1), '\s*\[.*?\]\s*$', ''),
    '\s*GN=\S+', '', 'g'), '\s*PE=\d+', '', 'g'), '\s*SV=\d+', '', 'g'), '\s*\{ECO:[^}]+\}', '', 'g'))"""
CLEAN = r"""nullif(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, '^(?:sp|tr|xx)\|\w+\|\w+\s+', '', 'gi'),
    '^small\s+', '', 'gi'), ',\s*$', ''), '\s+', ' ', 'g')), '')"""
BAD = "(name IS NULL OR lower(trim(name)) IN ('ring') OR contains(lower(name), 'old gear') OR regexp_matches(name, '(?i)^cold'))"
GN = r"regexp_extract(stitle, 'GN=(\S+)', 1)"
SYMBOL = rf"CASE WHEN {GN} = '' OR regexp_matches({GN}, '(?i)^Brand1\d$') THEN '' ELSE {GN} END"
SOURCE = "CASE WHEN subject_id LIKE 'sp|%' THEN 'sp' WHEN subject_id LIKE 'tr|%' THEN 'tr' ELSE 'other' END"
KEYS = r"""list_concat([subject_id, split_part(subject_id, '|', 2), split_part(split_part(subject_id, '|', 3), '_', 1)],
    flatten(list_transform(regexp_extract_all(subject_id, '[A-Z]{2}_[0-9]+\.?[0-9]*'), lambda m: [m, split_part(m, '.', 1)])))"""


def jaccard(a: str, b: str) -> str:
    """Shared words over all words."""
    x, y = (f"list_distinct(regexp_extract_all({c}, '{TOKENS}'))" for c in (a, b))
    return f"CASE WHEN len({x}) > 0 AND len({y}) > 0 THEN len(list_intersect({x}, {y}))::DOUBLE / len(list_distinct(list_concat({x}, {y}))) ELSE 0.0::DOUBLE END"


def equal(a: str, b: str) -> str:
    """Whether two names have likeness 1: the same text or the same words, whatever the case."""
    x, y = (f"list_sort(list_distinct(regexp_extract_all(lower({c}), '{TOKENS}')))" for c in (a, b))
    return f"(lower({a}) = lower({b}) OR (len({x}) > 0 AND {x} = {y}))"


HITS = f"""{ctes("ph", "pt", "ptp", "pu")},
ev AS (SELECT * FROM ph WHERE evalue <= {EVALUE}),
nm AS (SELECT *, min(ord) OVER (PARTITION BY transcript_id) AS tx_ord, {CLEAN.format(TITLE)} AS name, {SYMBOL} AS symbol FROM ev),
good AS (SELECT * FROM nm WHERE NOT {BAD}),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY bitscore DESC, ord) AS r FROM good) WHERE r <= {TOP_N}),
pool AS (SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY tx_ord, bitscore DESC, ord) - 1 AS hit_idx FROM good)"""

CLUSTERS = f"""{HITS}, {ctes("px_id", "px_info", "pg", "po_terms", "po_edges", "po_alt")},
clus AS (SELECT *, min(hit_idx) OVER (PARTITION BY gene_id, regexp_extract(name, '({TOKENS})$', 1)) AS cluster_id, hit_idx AS member_pos FROM pool),
scores AS (SELECT gene_id, cluster_id, count(*) AS n,
    CAST(sum(CAST(bitscore AS DECIMAL(18,2))) AS DOUBLE) * sqrt(count(*)) * (1 + CAST(0.1 AS DOUBLE) * (count(DISTINCT transcript_id) - 1)) AS score FROM clus GROUP BY ALL),
winner AS (SELECT * FROM (SELECT *, n / sum(n) OVER (PARTITION BY gene_id) AS fraction,
    row_number() OVER (PARTITION BY gene_id ORDER BY score DESC, cluster_id) AS r FROM scores) WHERE r = 1),
won AS (SELECT clus.* FROM clus JOIN winner USING (gene_id, cluster_id)),
groups AS (SELECT gene_id, lower(symbol) AS symbol_key, count(*) AS n, CAST(sum(CAST(bitscore AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_bitscore, min(member_pos) AS first_pos
    FROM won WHERE symbol <> '' GROUP BY ALL),
cand AS (SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY mean_bitscore DESC, first_pos) AS r
    FROM (SELECT *, max(CASE WHEN n >= 2 THEN 1 ELSE 0 END) OVER (PARTITION BY gene_id) AS many FROM groups) WHERE many = 0 OR n >= 2),
sized AS (SELECT gene_id, count(*) AS size, max(CASE WHEN symbol <> '' THEN 1 ELSE 0 END) AS has FROM won GROUP BY ALL),
wsym AS (SELECT cand.gene_id, symbol_key FROM cand JOIN sized USING (gene_id) WHERE r = 1 AND NOT (n = 1 AND size >= 10 AND n / size < 0.1)),
grp AS (SELECT won.*, symbol_key IS NOT NULL AS by_symbol FROM won LEFT JOIN wsym USING (gene_id) WHERE symbol_key IS NULL OR lower(symbol) = symbol_key),
ranked AS (SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY bitscore DESC, member_pos) AS place FROM grp),
top1 AS (SELECT * FROM ranked WHERE place = 1),
keyed AS (SELECT gene_id, unnest({KEYS}) AS accession, generate_subscripts({KEYS}, 1) AS pos FROM top1 WHERE NOT by_symbol),
xref AS (SELECT gene_id, min_by(symbol, pos) AS xsym FROM (SELECT k.gene_id, pos, i.symbol FROM keyed k JOIN px_id d ON k.accession = d.accession JOIN px_info i ON d.gene_id = i.gene_id
    WHERE d.gene_id <> '' AND i.symbol NOT IN ('', '-', 'NEWENTRY')) GROUP BY gene_id),
chosen AS (SELECT top1.gene_id, name AS protein_name, lower(CASE WHEN by_symbol THEN symbol ELSE coalesce(xsym, '') END) AS gene_symbol, has
    FROM top1 LEFT JOIN xref USING (gene_id) JOIN sized USING (gene_id)),
sel AS (SELECT gene_id, protein_name, gene_symbol, CASE WHEN gene_symbol = '' THEN '' WHEN has = 1 THEN 'uniprot' ELSE 'ncbi' END AS symbol_source FROM chosen),
major AS (SELECT * FROM (SELECT lower(protein_name) AS norm, gene_symbol AS best_symbol, row_number() OVER (PARTITION BY lower(protein_name) ORDER BY count(*) DESC, min(gene_id)) AS r
    FROM sel WHERE gene_symbol <> '' GROUP BY lower(protein_name), gene_symbol) WHERE r = 1),
ann AS (SELECT gene_id, protein_name, CASE WHEN gene_symbol = '' THEN coalesce(best_symbol, '') ELSE gene_symbol END AS gene_symbol, symbol_source,
    gene_symbol = '' AND best_symbol IS NOT NULL AS propagated FROM sel LEFT JOIN major ON lower(protein_name) = norm),
counts AS (SELECT gene_id, count(*) AS n_total_hits, count(DISTINCT transcript_id) AS n_isoforms FROM pool GROUP BY ALL),
conc AS (SELECT p.gene_id, avg(CASE WHEN symbol <> '' AND lower(symbol) = gene_symbol THEN 1 ELSE 0 END) AS symbol_concordance
    FROM pool p JOIN ann USING (gene_id) WHERE gene_symbol <> '' GROUP BY ALL),
gm AS (SELECT DISTINCT accession, unnest(string_split(go_terms, ';')) AS go_id FROM pg),
prim AS (SELECT DISTINCT gene_id, go_id FROM (SELECT gene_id, unnest({KEYS}) AS accession FROM ranked WHERE place <= 5) JOIN gm USING (accession)),
nsp AS (SELECT gene_id, go_id FROM prim JOIN po_terms ON go_id = id WHERE namespace IN ('biological_process', 'molecular_function')),
paths AS (WITH RECURSIVE c(ancestor, descendant) AS (SELECT parent, child FROM po_edges UNION SELECT e.parent, c.descendant FROM c JOIN po_edges e ON e.child = c.ancestor) SELECT * FROM c),
spec AS (SELECT * FROM nsp t WHERE NOT EXISTS (SELECT 1 FROM paths p JOIN nsp o ON o.go_id = p.descendant WHERE p.ancestor = t.go_id AND o.gene_id = t.gene_id)),
nconc AS (SELECT p.gene_id, avg(CASE WHEN {equal("p.name", "protein_name")} THEN 1 ELSE 0 END) AS name_concordance FROM pool p JOIN ann USING (gene_id) WHERE protein_name <> '' GROUP BY ALL),
supp AS (SELECT w.gene_id, w.hit_idx, w.subject_id FROM won w JOIN sel USING (gene_id) WHERE w.subject_id LIKE 'sp|%' AND ((gene_symbol <> '' AND lower(w.symbol) = gene_symbol) OR {equal("w.name", "protein_name")})
    AND NOT EXISTS (SELECT 1 FROM ranked r WHERE r.place <= 5 AND r.gene_id = w.gene_id AND r.hit_idx = w.hit_idx)),
more AS (SELECT DISTINCT gene_id, go_id FROM (SELECT gene_id, unnest({KEYS}) AS accession FROM supp) JOIN gm USING (accession)),
labels AS (SELECT gene_id, CASE WHEN max(new) = 1 THEN 'cluster_top5+swissprot_supplement' ELSE 'cluster_top5' END AS go_source
    FROM (SELECT gene_id, 0 AS new FROM prim UNION ALL SELECT gene_id, 1 FROM more m WHERE NOT EXISTS (SELECT 1 FROM prim p WHERE p.gene_id = m.gene_id AND p.go_id = m.go_id)) GROUP BY gene_id),
full_terms AS (SELECT gene_id, go_id FROM (SELECT * FROM prim UNION SELECT * FROM more) JOIN po_terms ON go_id = id WHERE namespace IN ('biological_process', 'molecular_function')),
full_spec AS (SELECT * FROM full_terms t WHERE NOT EXISTS (SELECT 1 FROM paths p JOIN full_terms o ON o.go_id = p.descendant WHERE p.ancestor = t.go_id AND o.gene_id = t.gene_id)),
nspec AS (SELECT gene_id, count(*) AS n_go_terms, string_agg(go_id, ';' ORDER BY go_id) AS go_terms FROM full_spec GROUP BY gene_id),
summ AS (SELECT w.gene_id, count(*) AS n_cluster_hits, round(max(fraction), 6) AS cluster_fraction, CAST(sum(CAST(bitscore AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_cluster_bitscore,
    string_agg(name, '|' ORDER BY member_pos) AS names, coalesce(string_agg(symbol, '|' ORDER BY member_pos) FILTER (symbol <> ''), '') AS symbols
    FROM won w JOIN winner USING (gene_id, cluster_id) GROUP BY w.gene_id),
final AS (SELECT pu.gene_id, coalesce(protein_name, '') AS protein_name, coalesce(gene_symbol, '') AS gene_symbol, coalesce(symbol_source, '') AS symbol_source, coalesce(propagated, false) AS propagated,
    coalesce(n_total_hits, 0) AS n_total_hits, coalesce(n_isoforms, 0) AS n_isoforms, coalesce(n_cluster_hits, 0) AS n_cluster_hits, coalesce(cluster_fraction, 0) AS cluster_fraction,
    coalesce(mean_cluster_bitscore, 0) AS mean_cluster_bitscore, coalesce(names, '') AS names, coalesce(symbols, '') AS symbols, top1.subject_id AS top_hit_sseqid, coalesce(top1.bitscore, 0) AS top_hit_bitscore,
    round(coalesce(name_concordance, 0), 6) AS name_concordance, coalesce(go_source, '') AS go_source, round(coalesce(symbol_concordance, 0), 6) AS symbol_concordance, coalesce(n_go_terms, 0) AS n_go_terms, coalesce(go_terms, '') AS go_terms
    FROM pu LEFT JOIN ann USING (gene_id) LEFT JOIN counts USING (gene_id) LEFT JOIN summ USING (gene_id) LEFT JOIN top1 USING (gene_id) LEFT JOIN conc USING (gene_id) LEFT JOIN nconc USING (gene_id) LEFT JOIN labels USING (gene_id) LEFT JOIN nspec USING (gene_id))"""


def hits_sql(select: str) -> str:
    return f"WITH {HITS} {select}"


def clusters_sql(select: str) -> str:
    return f"WITH RECURSIVE {CLUSTERS} {select}"


def proxy_sql(names: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes(*names.split())} {select}"
