"""The corpus pipeline, stage by stage, against plain Python."""

import re
from collections import Counter

import corpus_pipeline
from hitforge.llm import quality, secrets
from tests.llm.test_operators import groups, measured, plain_secrets


def encoded(rows):
    """The last stage by the tiktoken library."""
    import base64
    import hashlib

    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    code = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = code.encode_ordinary_batch([r.text or "" for r in rows])
    said = lambda x: hashlib.sha256(x).hexdigest()
    return Counter((r.doc_id, len(i), said(",".join(map(str, i)).encode()), said((r.text or "").encode())) for r, i in zip(rows, ids, strict=True))


def test_stages_on_edges(spark, sf):
    """Rows without id, null and empty texts, repeated rows, one id with two texts, a column more that has an inner name."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(None, "no id " + long), (None, "no id " + long), (1, None), (2, ""), (3, long), (3, long), (4, long + " end"), (5, "other " * 9 + "token=abcdefghij"), (5, "another " * 9), (6, "last words of all " + long[::-1])]
    docs = spark.createDataFrame([(i, t, None, None if i == 6 else "s", len(t or ""), 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, kept int")
    dedup, mask, mix = (stage for _, stage in corpus_pipeline.STAGES[1:4])
    got = Counter((r.doc_id, r.text) for r in dedup(spark, docs, sf).collect())
    assert got == Counter([(None, "no id " + long)] * 2 + [(1, None), (2, ""), (3, long), (5, "another " * 9), (6, rows[-1][1])])
    masked = mask(spark, docs, sf).collect()
    assert len(masked) == len(rows) and any(r.text == "other " * 9 + "[SECRET]" for r in masked) and sum(r.text is None for r in masked) == 1
    mixed = mix(spark, docs, sf)
    assert mixed.columns == corpus_pipeline.COLUMNS and mixed.filter("text is null or text = ''").isEmpty() and not mixed.filter("doc_id is null").isEmpty()
    judged = corpus_pipeline.quality_rules(spark, docs, sf)
    assert judged.columns == corpus_pipeline.COLUMNS and judged.filter("doc_id in (1, 2)").isEmpty()
    last = corpus_pipeline.encode(spark, docs, sf)
    assert Counter(map(tuple, last.collect())) == encoded(docs.collect())


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept, seen = {}, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(i)))
        after = spark.read.parquet(str(tmp_path / str(i)))
        seen[name], kept[name] = docs.collect(), after.collect()
        if i < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == corpus_pipeline.COLUMNS
        docs = after
    first = {r.doc_id for r in kept["quality rules"]}
    for r in seen["quality rules"]:
        n, _, _, _, again = measured(r.text)
        assert not (r.doc_id in first and (n < 50 or 100 * again > 50 * n))
    want = groups([(r.doc_id, r.text) for r in seen["near-duplicate removal"]])
    assert {r.doc_id for r in kept["near-duplicate removal"]} == {i for i, (_, _, keep) in want.items() if keep}
    before = {r.doc_id: r.text for r in seen["secret scans"]}
    for r in kept["secret scans"]:
        spans = plain_secrets(before[r.doc_id])
        assert (r.text == before[r.doc_id]) == (not spans) and r.n_chars == len(r.text)
        assert not re.search(r"[0-9a-f]{24}", r.text)
    sizes, taken = Counter(), Counter()
    for r in seen["mixing sources to target weights"]:
        sizes[r.source] += len(r.text.encode().split())
    for r in kept["mixing sources to target weights"]:
        taken[r.source] += len(r.text.encode().split())
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 0.02 * sum(sizes.values())  # few documents in each source
    assert max(Counter(r.doc_id for r in kept["mixing sources to target weights"]).values()) <= 2
    assert Counter(map(tuple, kept["byte-level BPE encoding and decoding"])) == encoded(kept["mixing sources to target weights"])


def test_rows_of_run(spark, sf):
    rows = corpus_pipeline.run(spark, sf)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and rows.count() > 0


def test_stages_on_nothing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0
    assert quality.PRIOR.moves.shape == (2, 2) and secrets.RULES[0].base
