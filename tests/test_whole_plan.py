"""The whole annotation with all lookup tables against plain Python, column by column; reading and lookups at scale."""

import gzip
import math
import random
import re
import statistics
import struct
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hitforge import storage
from hitforge.functions import names as N
from hitforge.functions.matching import ratios
from hitforge.functions.rules import RuleSet, parse_rules
from hitforge.functions.similarity import fmt2, names_alike
from hitforge.operators import hits, metrics, refdata
from hitforge.plans.annotate import Params, References, annotate
from hitforge.sources import block_gzip, readers
from tests.test_annotation import plain_clusters
from tests.test_verified import norm, plain_choice

WORDS = ["kinase", "beta", "protein", "zinc", "finger", "like", "tide", "diet", "Kinase", "alpha", "7"]
RULES = RuleSet(strip=(r"^probable\s+",), exact=("beta",), substring=("zinc finger",), regex=(r"^like\b",), symbol=(r"^loc\d+$",))


def keys_of(subject):
    parts = subject.split("|")
    return [subject, *parts[1:2], *(p.split("_")[0] for p in parts[2:3])]


def bad_symbol(symbol):
    return not symbol or bool(re.search(RULES.symbol[0], symbol, re.I))


def invented(seed, genes=200):
    """Raw hits, records of transcripts, and lookups: accessions to terms and gene ids, gene ids to symbols, a tree of terms."""
    dice, raw, records = random.Random(seed), [], []
    order = 0
    for g in range(genes):
        for t in range(dice.randint(0, 4)):
            transcript = f"t{g}.{t}"
            if dice.random() < 0.95:
                records.append((transcript, f"g{g}"))
            if dice.random() < 0.1:
                records.append((transcript, f"g{dice.randrange(genes)}"))  # a later record of the same transcript
            theme = dice.sample(WORDS, 4)
            for _ in range(dice.randint(0, 9)):
                name = ("probable " if dice.random() < 0.2 else "") + " ".join(dice.sample(theme, dice.randint(1, 3)))
                symbol = dice.choice(["", "", "Kin1", "kin1", "KIN2", "ZF", "LOC12"])
                subject = f"{dice.choice(['sp', 'tr', 'xx'])}|P{dice.randint(1, 90)}|X{dice.randint(1, 5)}_Y"
                title = f"{subject} {name} OS=x" + (f" GN={symbol}" if symbol else "")
                raw.append((transcript, subject, dice.choice([1e-9, 1e-7, 1e-5, 1e-3, float("nan")]), dice.randint(40, 60) + dice.choice([0.0, 0.25, 0.5]), title.removeprefix(f"{subject} "), order))
                order += 1
    terms = {i: dice.choice(["biological_process", "molecular_function", "cellular_component", None]) for i in range(1, 81)}
    parents = {i: i // 2 for i in range(2, 81)}
    go = {f"P{i}": {dice.randint(1, 82) for _ in range(dice.randint(1, 3))} for i in range(1, 91) if i % 3}
    ids = [(f"P{dice.randint(1, 90)}", str(dice.randint(1, 30)), i) for i in range(80)]
    info = [(str(dice.randint(1, 30)), dice.choice(["abc", "LOC7", "Def", "ghi2"]), i) for i in range(40)]
    return raw, records, terms, parents, go, ids, info


def plain_annotate(raw, records, universe, terms, parents, go, ids, info, top_n, namespaces):
    """Each gene's row, from the statement of each step."""
    gene_of, id_of, symbol_of = dict(records), {a: g for a, g, _ in ids}, {g: s for g, s, _ in info}
    passing = [h for h in raw if math.isnan(h[2]) or h[2] <= 1e-5]
    first, per = {}, defaultdict(list)
    for h in passing:
        first[h[0]] = min(first.get(h[0], h[5]), h[5])
    for t, subject, _, bits, title, order in passing:
        name = re.sub(RULES.strip[0], "", title.split(" OS=")[0], flags=re.I).strip()
        symbol = (re.findall(r"GN=(\S+)", title) or [""])[0]
        if name and name.lower() not in RULES.exact and RULES.substring[0] not in name.lower() and not re.search(RULES.regex[0], name, re.I):
            per[t].append((-bits, order, t, subject, name, "" if bad_symbol(symbol) else symbol))
    pool = defaultdict(list)
    for t, own in per.items():
        pool[gene_of.get(t, t)] += [(first[t], *h) for h in sorted(own)[:top_n]]
    out, chosen, kept = {}, {}, {}
    for gene in set(pool) & set(universe):
        own = [(h[3], h[4], -h[1], h[5], h[6]) for h in sorted(pool[gene])]  # transcript, subject, bits, name, symbol
        best = None
        for cluster in sorted(plain_clusters([norm(h[3]) for h in own], [h[4].lower() for h in own], 0.5)):
            score = sum(own[i][2] for i in cluster) * math.sqrt(len(cluster)) * (1 + 0.1 * (len({own[i][0] for i in cluster}) - 1))
            if best is None or score > best[0]:
                best = score, cluster
        won = [(gene, i, place, own[i][0], own[i][1], own[i][2], own[i][3], own[i][4]) for place, i in enumerate(best[1])]
        name, symbol, group = plain_choice(won)
        if not symbol:
            found = [symbol_of.get(id_of.get(k, ""), "") for k in keys_of(group[0][4])]
            symbol = next((s.lower() for s in found if not bad_symbol(s)), "")
        chosen[gene] = name, symbol
        kept[gene] = own
        source = "" if not symbol else "uniprot" if any(h[7] for h in won) else "ncbi"
        of = lambda h: set().union(*(go.get(k, set()) for k in keys_of(h[4])))
        found = set().union(*(of(h) for h in group[:5]))
        label = "cluster_top5" if found else None
        for h in won:
            if h not in group[:5] and h[4].startswith("sp|") and ((symbol and h[7].lower() == symbol) or names_alike(norm(name), norm(h[6])) >= 0.5):
                if of(h) - found:
                    label = "cluster_top5+swissprot_supplement"
                found |= of(h)
        found = {i for i in found if terms.get(i) in namespaces}
        above = lambda i: set() if i not in parents else {parents[i]} | above(parents[i])  # noqa: B023, E731
        specific = {i for i in found if not any(i in above(j) for j in found)}
        out[gene] = {
            "protein_name": name, "symbol_source": source, "n_total_hits": len(own), "n_isoforms": len({h[0] for h in own}), "n_cluster_hits": len(won), "cluster_fraction": len(won) / len(own),
            "mean_cluster_bitscore": sum(h[5] for h in won) / len(won), "names": [h[6] for h in won], "symbols": [h[7] for h in won if h[7]], "top_hit_sseqid": group[0][4], "top_hit_bitscore": group[0][5],
            "go_source": label or "", "n_go_terms": len(specific), "specific_go_terms": sorted(map("GO:{:07d}".format, specific)) or None, "go_terms": sorted(map("GO:{:07d}".format, found)) or None,
        }
    votes = defaultdict(lambda: defaultdict(list))
    for gene in universe:
        if gene in chosen and chosen[gene][1]:
            votes[norm(chosen[gene][0])][chosen[gene][1]].append(universe.index(gene))
    for gene, row in out.items():
        name, symbol = chosen[gene]
        most = votes.get(norm(name), {})
        row["propagated"] = not symbol and bool(most)
        symbol = symbol or (min(most, key=lambda s: (-len(most[s]), min(most[s]))) if most else "")
        row["gene_symbol"] = symbol
        row["name_concordance"] = sum(names_alike(norm(name), norm(h[3])) >= 0.5 for h in kept[gene]) / len(kept[gene])
        row["symbol_concordance"] = sum(bool(h[4]) and h[4].lower() == symbol for h in kept[gene]) / len(kept[gene]) if symbol else 0
    return out


@pytest.mark.parametrize("seed,most", [(1, 1_000_000), (2, 0)])
def test_annotate_with_references(spark, monkeypatch, seed, most):
    """Every output column of 200 random genes; with few keys, and with as many keys as need a shuffle."""
    monkeypatch.setattr(refdata, "BROADCAST_KEYS", most)
    raw, records, terms, parents, go, ids, info = invented(seed)
    universe = [f"g{i}" for i in range(200) if i % 7]
    random.Random(9).shuffle(universe)
    term = "GO:{:07d}".format
    frame = spark.createDataFrame
    refs = References(
        frame([(a, term(i)) for a, own in go.items() for i in own], "accession string, go_id string"), frame(ids, "accession string, gene_id string, ord int"), frame(info, "gene_id string, symbol string, ord int"),
        frame([(term(i), n) for i, n in terms.items()], "id string, namespace string"), frame([(term(c), term(p)) for c, p in parents.items()], "child string, parent string"),
    )
    transcripts = frame([(*r, i) for i, r in enumerate(records)], "transcript_id string, gene_id string, ord int")
    genes = frame(list(zip(universe, range(len(universe)), strict=True)), "gene_id string, gene_ord int")
    table = frame(raw, "transcript_id string, subject_id string, evalue double, bitscore double, stitle string, ord int").repartition(3)
    rows = {r.gene_id: r.asDict() for r in annotate(table, transcripts, genes, refs, Params(top_n=4, namespaces=("BP", "MF"), rules=RULES)).collect()}
    want = plain_annotate(raw, records, universe, terms, parents, go, ids, info, 4, ("biological_process", "molecular_function"))
    assert set(rows) == set(universe) and len(want) > 100
    for gene, row in rows.items():
        if gene not in want:
            assert (row["protein_name"], row["gene_symbol"], row["n_total_hits"], row["n_go_terms"], row["propagated"]) == ("", "", 0, 0, False)
            continue
        for column, value in want[gene].items():
            assert row[column] == (pytest.approx(value, abs=1e-9) if isinstance(value, float) else value), (gene, column)
    assert {r["go_source"] for r in want.values()} == {"", "cluster_top5", "cluster_top5+swissprot_supplement"} and {r["symbol_source"] for r in want.values()} == {"", "uniprot", "ncbi"}
    assert any(r["propagated"] for r in want.values())


def test_lookups_read_by_bucket(spark, tmp_path):
    """A keyed table is joined as it lies: no exchange on its side, in a session that didn't build it either."""
    frame = spark.createDataFrame
    go_map = frame([(f"P{i}", f"GO:{i % 50}") for i in range(500)], "accession string, go_id string")
    ids = frame([(f"P{i}", str(i % 40), i) for i in range(500)], "accession string, gene_id string, ord int")
    info = frame([(str(i), f"S{i}", i) for i in range(40)], "gene_id string, symbol string, ord int")
    refdata.build_reference_tables(str(tmp_path), go_map, ids, info, buckets=4)
    keys = frame([(f"P{i}",) for i in range(0, 600, 7)], "accession string")
    where = f"{tmp_path}/go_mapping"
    spark.sql(f"DROP TABLE {readers.table_name(where)}")
    table = readers.read_reference_table(spark, where, key="accession", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = keys.join(table, "accession")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
        assert joined.count() == len(range(0, 500, 7))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for most in (0, 1000):
        assert {r.accession for r in refdata.wanted(table, keys, "accession", most).collect()} == {f"P{i}" for i in range(0, 500, 7)}
    refdata.build_reference_tables(str(tmp_path), go_map.limit(0), ids, info, buckets=4)
    assert spark.read.parquet(where).count() == 500
    refdata.build_reference_tables(str(tmp_path), go_map.limit(9), ids, info, rebuild=True, buckets=4)
    assert readers.read_reference_table(spark, where, key="accession", buckets=4).count() == 9


def blocked(data: bytes, size: int) -> bytes:
    """Block gzip, members of ``size`` bytes of content, with the empty one at the end."""
    out = b""
    for at in [*range(0, len(data), size), len(data)]:
        part = data[at : at + size]
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = packer.compress(part) + packer.flush()
        head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25)
        out += head + body + struct.pack("<II", zlib.crc32(part), len(part))
    return out


@pytest.mark.parametrize("end", ["\n", ""])
def test_block_gzip(spark, tmp_path, end):
    """Lines and records over all cuts of members and ranges; several tasks read one file."""
    dice = random.Random(4)
    lines = ["".join(dice.choice("abé\t") for _ in range(dice.choice([0, 3, 40, 400]))) + f"|{i}" for i in range(300)]
    lines[7] = ""
    text = "\n".join(lines) + end
    path = str(tmp_path / "a.gz")
    for size in (97, 1000, 60_000):
        (tmp_path / "a.gz").write_bytes(blocked(text.encode(), size))
        assert gzip.decompress((tmp_path / "a.gz").read_bytes()).decode() == text and block_gzip.is_block_gzip(path)
        for span in (50, 333, 4 << 20):
            rows = block_gzip.read_records(spark, [path], "\n", span)
            got = rows.withColumn("task", F.spark_partition_id()).orderBy("path", "block", "seq").collect() if span > 50 or size == 1000 else None
            if got is not None:
                assert [r.value for r in got] == lines
                assert len({r.task for r in got}) > 1 or span > 333 or size > 1000
    fasta = "".join(f">t{i} gene=g{i}\nAC\nG{i}\n" for i in range(200))
    (tmp_path / "f.fa.gz").write_bytes(blocked(fasta.encode(), 41))
    reader = block_gzip.BlockGzipReader({"path": str(tmp_path / "f.fa.gz"), "lineSep": "\n>", "rangeBytes": "100"})
    values = [v for part in reader.partitions() for v, *_ in reader.read(part)]
    assert len(reader.partitions()) > 20 and ("\n>".join(values) + "\n").rstrip("\n") == fasta.rstrip("\n")
    got = readers.read_fasta(spark, str(tmp_path / "f.fa.gz")).orderBy("ord").collect()
    assert [(r.transcript_id, r.sequence) for r in got] == [(f"t{i}", f"ACG{i}") for i in range(200)]
    (tmp_path / "p.tsv.gz").write_bytes(gzip.compress(b"P1\tx\t7\nP2\tx\t8\nP1\tx\t9\n"))
    rows = readers.read_id_map(spark, str(tmp_path / "p.tsv.gz"))
    assert [(r.accession, r.gene_id) for r in rows.orderBy("ord").collect()] == [("P1", "7"), ("P2", "8"), ("P1", "9")]
    assert not block_gzip.is_block_gzip(str(tmp_path / "p.tsv.gz"))


def test_exact_medians(spark):
    dice = random.Random(5)
    rows = [(k, dice.choice([dice.random(), 0.5, 0.25]) if n > 3 else dice.random()) for k, n in (("a", 1), ("b", 2), ("c", 301), ("d", 1000)) for _ in range(n)] + [("c", None), ("e", None)]
    table = spark.createDataFrame(rows, "k string, x double").repartition(5)
    want = {k: statistics.median(x for key, x in rows if key == k and x is not None) for k in "abcd"}
    assert {r.k: r["median"] for r in metrics.exact_medians(table, "k", "x").collect()} == want
    got = {r.k: r for r in metrics.spread(table, "k", "x").collect()}
    assert got["e"]["median"] is None and got["d"]["median"] == want["d"] and got["d"]["max"] == max(x for k, x in rows if k == "d")
    empty = metrics.cluster_fraction_stats(spark.createDataFrame([(0.0,)], "cluster_fraction double")).collect()
    assert [tuple(r) for r in empty] == [(None, None, None, None)]


def test_one_matcher_for_all_rules(spark):
    """The plan holds one pattern of each kind however many rules there are, and says what single rules say."""
    dice = random.Random(6)
    names = [" ".join(dice.choice(["kinase", "beta", "AB12", "like 7", "É", "x.y", "a$b"]) for _ in range(3)) for _ in range(200)]
    patterns = [r"^like\b", r"\d$", r"(kin)ase \1?ase", r"(b)eta \1eta", "É$", r"(?x) x \. y # note", r"a\$b kin"]
    words = [f"a{i}b{i}" for i in range(100)] + ["x.y kin", "a$b", "beta beta beta", "like 7"]
    table = spark.createDataFrame([(n,) for n in names], "name string")
    got = table.select("name", N.bad_regex(F.col("name"), patterns).alias("regex"), N.bad_substring(F.col("name"), words).alias("word"))
    for r in got.collect():
        assert r.regex == any(re.search(p, r.name, re.I) for p in patterns) and r.word == any(w in r.name.lower() for w in words)
    many = RuleSet(substring=tuple(words), regex=tuple(f"^x{i}y" for i in range(100)))
    plan = table.filter(~many.is_bad_name(F.col("name")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") + plan.count("rlike") <= 2 and plan.count("Contains(") + plan.count("contains(") == 0
    with pytest.warns(UserWarning, match="not a regular"):
        assert parse_rules(spark, ["regex: (", "regex: a", "strip_regex: [", "symbol_regex: PATTERN"]) == RuleSet(regex=("a",), symbol=("PATTERN",))


def test_counts_without_expansion(spark):
    rows = [("t1", "sp|a", 1e-9), ("t1", "tr|a", 0.5), ("t2", "xx", 0.5), (None, "sp|b", float("nan")), ("t3", "sp|c", 1e-6)]
    table = spark.createDataFrame(rows, "transcript_id string, subject_id string, evalue double")
    stats = hits.hit_stats(table)
    assert stats.first().asDict() == {"total_hits": 5, "filtered_hits": 2, "passing_hits": 3, "queries_before": 3, "queries_after": 2, "sp_hits": 3, "tr_hits": 0, "other_hits": 0}
    assert "Expand" not in stats._jdf.queryExecution().executedPlan().toString()
    assert hits.hit_stats(table.limit(0)).first().total_hits == 0
    made = refdata.go_map_stats(spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1")], "accession string, go_id string"))
    assert made.first().asDict() == {"lines": 1, "accessions": 2, "annotations": 3} and "Expand" not in made._jdf.queryExecution().executedPlan().toString()
    twice = hits.one_value(spark.createDataFrame([("t", "a"), ("t", "b")], "k string, v string"), "k", "v")
    assert [tuple(r) for r in twice.collect()] == [("t", "b")]


def test_ratios_of_batches():
    """Against the standard library, frequent characters of long texts included."""
    from difflib import SequenceMatcher

    dice, one, other = random.Random(7), [], []
    for k in range(3000):
        letters, most = dice.choice(["ab", "abcd", "abcdefghij kl", "é漢x \U0001f600"]), dice.choice([250, 500]) if k % 60 == 0 else dice.choice([3, 12, 40])
        one.append("".join(dice.choice(letters) for _ in range(dice.randint(0, most))))
        other.append("".join(dice.choice(letters) for _ in range(dice.randint(0, most))) if dice.random() < 0.7 else one[-1][: dice.randint(0, most)] + "z")
    assert ratios(one, other).tolist() == [SequenceMatcher(None, a, b).ratio() for a, b in zip(one, other, strict=True)]


def test_two_decimals_of_any_number(spark):
    dice = random.Random(8)
    values = [0.125, 2.675, -0.001, 0.0, -0.0, 1e-300, 0.005, 0.015, 1.005, 0.995, 99.995, -2.5, 1e12 + 0.125, 35184372088831.9]
    values += [dice.choice([1, 10, 1000, 1e6, 1e9]) * dice.uniform(-1, 1) for _ in range(3000)] + [dice.randint(0, 10**7) / 1000 for _ in range(3000)] + [dice.randint(0, 10**6) / 8 for _ in range(1000)]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double").select("i", fmt2("x").alias("t")).collect()
    assert {r.i: r.t for r in rows} == {i: f"{x:.2f}" for i, x in enumerate(values)}
    odd = spark.createDataFrame([(float("nan"),), (None,), (1e15,)], "x double").select(fmt2("x").alias("t"), F.lit(1).alias("n"))
    assert [r.t for r in odd.collect()] == [None, None, "1000000000000000.00"]
    assert "Python" not in odd._jdf.queryExecution().executedPlan().toString() and Counter(r.n for r in odd.collect()) == {1: 3}
    assert storage.written(odd).count() == 3
