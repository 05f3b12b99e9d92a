"""Substring dedup, filter audit and source divergence against plain Python on edge cases."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from hitforge.llm import filter_audit, source_divergence, substring_dedup
from hitforge.llm.text_batches import counted_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = "doc_id bigint, text string, lang string, source string, h bigint, words string, part string, at string, n_words string"


def corpus(seed, n=160):
    """Texts with passages of others, near and exact copies, repeated ids and rows, null ids, texts, sources and languages."""
    dice = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "émile", "漢字", "A", "a", "#x", "\x1c", "x\x85y", "SHOUT", "½"]
    space = lambda: dice.choice([" ", " ", " ", "\n", "\t", "  ", " \x0b"])
    rows = []
    for i in range(n):
        words = [dice.choice(vocabulary) for _ in range(dice.choice([0, 1, 5, 12, 13, 14, 40, 120]))]
        for _ in range(dice.randint(0, 3)):
            other = dice.choice(rows)[1] if rows else None
            if other:
                taken = WORD.findall(other)
                a = dice.randint(0, max(0, len(taken) - 5))
                at = dice.randint(0, len(words))
                words[at:at] = taken[a : a + dice.choice([5, 12, 13, 14, 30, 200])]
        text = "".join(w + space() for w in words)
        if i % 9 == 4 and rows:
            text = dice.choice(rows)[1]
        if i % 17 == 3:
            text = dice.choice([None, "", " \n "])
        rows.append((dice.choice([i, i, i, max(0, i - 3)]) if i % 23 else None, text, dice.choice(["en", "de", None, ""]), dice.choice(["s1", "s1", "s2", "é", None])))
    rows += rows[:5] + [r for r in rows if r[1] and len(r[1]) > 100][:4] * 3
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "w", "p", "a", "n") for r in rows], COLUMNS).repartition(5)


def plain_dedup(rows):
    holders = {}
    for i, text, *_ in rows:
        words = WORD.findall(text or "")
        for k in range(len(words) - 12):
            if i is not None:
                key = tuple(words[k : k + 13])
                holders[key] = min(i, holders.get(key, i))
    out = Counter()
    for i, text, *_ in rows:
        words, gone = WORD.findall(text or ""), set()
        for k in range(len(words) - 12):
            if i is not None and holders[tuple(words[k : k + 13])] < i:
                gone.update(range(k, k + 13))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out[i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("small", [False, True])
def test_substring_dedup(spark, monkeypatch, small):
    """Whole chunks, and chunks of few words, ranges of few windows, texts in parts."""
    if small:
        import hitforge.llm.shingles as module

        for name, value in (("CHUNK_WORDS", 300), ("RANGE_WINDOWS", 200), ("BROADCAST_IDS", 0), ("BROADCAST_SPANS", 0)):
            monkeypatch.setattr(substring_dedup, name, value)
        monkeypatch.setattr(module, "PIECE_BYTES", 64)
    for seed in (1,) if small else (1, 2):
        rows = corpus(seed)
        got = Counter(map(tuple, substring_dedup.substring_dedup(table(spark, rows)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()))
        assert got == plain_dedup(rows)
        assert sum(k[2] for k in got) > 100
    assert substring_dedup.substring_dedup(table(spark, rows).limit(0)).count() == 0


def test_levels_of_windows(spark):
    assert substring_dedup.lengths() == [4, 8, 13] and substring_dedup.lengths(32, 4) == [4, 8, 16, 32] and substring_dedup.lengths(3, 4) == [3]
    planes = np.sort(np.random.default_rng(1).integers(0, 2**32, 1000).astype(np.uint32))
    assert (substring_dedup._numbers(substring_dedup._planes(planes), np.uint32) == planes).all()
    # other lengths of passages, and a first level that is the last
    rows = [(1, "a b c d e f"), (2, "x b c d y"), (3, "c d e f"), (4, "d c b a")]
    for passage, first, want in ((3, 4, {2: 3, 3: 4}), (2, 1, {2: 3, 3: 4}), (4, 1, {3: 4}), (5, 4, {})):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        got = {r.doc_id: r.n_removed for r in substring_dedup.substring_dedup(docs, passage=passage, first=first).collect() if r.n_removed}
        assert got == want


def test_long_text_in_dedup(spark):
    """A text of 20 MB, one word of 1 MB in it, and a passage of it in another document."""
    words = [f"w{i * i % 1_000_003}" for i in range(2_500_000)]
    words[1_000_000] = "x" * 1_000_000
    long = " ".join(words)
    docs = spark.createDataFrame([(1, long), (2, "start " + " ".join(words[2_000_000:2_000_040]) + " end"), (3, long)], "doc_id bigint, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(docs).collect()}
    assert got == {1: (2_500_000, 0), 2: (42, 40), 3: (2_500_000, 2_500_000)}


def test_words_in_turns():
    dice = random.Random(3)
    data = np.frombuffer(" ".join("ab\ncé"[dice.randint(0, 4)] * dice.randint(1, 40) for _ in range(300)).encode(), np.uint8)
    found = list(counted_words(data, bytes.split, 50))
    assert len(found) > 5 and sum(found, Counter()) == Counter(data.tobytes().split())
    assert all(not (a.keys() & b.keys()) for a, b in itertools.combinations(found, 2))


def fails(text):
    words = WORD.findall(text)
    return (len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), any(c in "#$%&*|" for c in text))


def test_filter_audit(spark):
    rows = corpus(5)
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 160, 2)] + [(4, 1, 1), (None, 1, 1), (6, None, None)]
    known = spark.createDataFrame([(i, q, None if t is None else int(t)) for i, q, t in labels], "doc_id bigint, quality int, toxic int")
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, *_ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    masks = [(r[3] or "", fails(r[1] or "") + (r[0] is not None and r[0] > least[r[1] or ""],), r[0]) for r in rows]
    want = {}
    for part in {m[0] for m in masks}:
        own = [m for m in masks if m[0] == part]
        shapley, steps = Counter(), []
        for order in itertools.permutations("ABCDE"):
            left, gone = own, []
            for step, letter in enumerate(order):
                k = "ABCDE".index(letter)
                here = [m for m in left if m[1][k]]
                redundant, left = sum(m[1][k] for m in gone), [m for m in left if not m[1][k]]
                gone = gone + here
                shapley[letter] += len(here)
                unique = sum(m[1][k] and sum(m[1]) == 1 for m in own)
                steps.append((part, "".join(order), step + 1, letter, len(left), len(here), redundant, unique, sum(m[2] in good for m in here), sum(m[2] in toxic for m in here)))
        want |= {s[:3]: (*s[4:], shapley[s[3]]) for s in steps}
    got = filter_audit.filter_audit(table(spark, rows), known).collect()
    assert {tuple(r[:3]): tuple(r[3:]) for r in got} == want and len(got) == len(want)
    assert filter_audit.filter_audit(table(spark, rows).limit(0), known).count() == 0


def test_path_counts():
    """Forward and backward counts against the orders themselves, and orders through an edge."""
    for n in (1, 3, 5):
        forward, backward = filter_audit.path_counts(n)
        orders = list(itertools.permutations(range(n)))
        for state in range(1 << n):
            inside = [i for i in range(n) if state >> i & 1]
            assert forward[state] == len({o[: len(inside)] for o in orders if set(o[: len(inside)]) == set(inside)})
            assert forward[state] * backward[state] == sum(set(o[: len(inside)]) == set(inside) for o in orders)
    with pytest.raises(ValueError):
        filter_audit.audit(None, "AAB")


def plain_divergence(rows, least):
    docs = [(lang or "", source or "", [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text or "")]) for _, text, lang, source in rows]
    within, counts = Counter(), Counter()
    for lang, source, terms in docs:
        within.update((lang, t) for t in set(terms))
        counts.update((lang, source, t) for t in terms)
    out = set()
    sources = defaultdict(set)
    for lang, source, _ in docs:
        sources[lang].add(source)
    for lang, names in sources.items():
        kept = sorted(t for (of, t), n in within.items() if of == lang and n >= least)
        share = lambda c, n: 1 + 1_000_000_000 * (c + 2) // (n + 2 * len(kept))
        of = {s: [counts[lang, s, t] for t in kept] for s in names}
        ps = {s: [share(c, sum(cs)) for c in cs] for s, cs in of.items()}
        whole = [sum(of[s][i] for s in names) for i in range(len(kept))]
        qs = [share(c, sum(whole)) for c in whole]
        far = lambda p, q: (p - q) ** 2 // (p + q)
        for s in names:
            pairs = [(sum(map(far, ps[s], ps[o])), o) for o in names if o != s]
            terms = [(far(p, q), t) for p, q, c, t in zip(ps[s], qs, of[s], kept, strict=True) if c and p > q]
            for part, found, most in (("pair", pairs, None), ("term", terms, 10)):
                found = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out |= {(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found)}
    return out


@pytest.mark.parametrize("least,postings", [(10, 1 << 16), (2, 8), (1000, 8)])
def test_source_divergence(spark, monkeypatch, least, postings):
    """Whole buckets and buckets of few postings, scattered a few at a time; no kept terms at all."""
    monkeypatch.setattr(source_divergence, "POSTINGS", postings)
    monkeypatch.setattr(source_divergence, "MOST", postings)
    monkeypatch.setattr(source_divergence, "STEP", 5 if postings == 8 else 1 << 18)
    monkeypatch.setattr(source_divergence, "HELD_TERMS", 50 if postings == 8 else 300_000)
    rows = corpus(7) + [(999, "only one here", "xx", "alone"), (1000, None, "en", "empty")]
    got = source_divergence.source_divergence(table(spark, rows), least_docs=least).select("lang", "source", "part", "item", "value", "rank").collect()
    assert {tuple(r) for r in got} == plain_divergence(rows, least) and len(got) == len(set(map(tuple, got)))
    assert any(r.value for r in got) == (least < 1000)
    assert source_divergence.source_divergence(table(spark, rows).limit(0)).count() == 0
