"""One text of 64 MB goes through each operator's worker code in less than 2 GB."""

import subprocess
import sys
from pathlib import Path

import pytest

HEAD = """
import resource, numpy as np, pyarrow as pa, public_tokenizers
from hitforge.llm.text_batches import Texts, pieces, parts, SMALL_PIECE
unit = "The quick brown fox, number {} of 12, jumps over the lazy dog.\\n"
text = "".join(unit.format(i % 1000) for i in range(1000)) * 1040
column = pa.array([text], pa.large_string())
del text
size = Texts(column).data.nbytes
assert size >= 64_000_000
"""
TAIL = """
used = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
assert used < 2_000_000, used
print(used)
"""
CODE = {
    "quality": """
from hitforge.llm import quality
m = next(quality.measure(Texts(column)))
assert m.n_words == 13 * 1_040_000 and m.n_dup_lines == 1_039_000
assert len(quality.PRIOR.content(m.features)) == 1_040_000
""",
    "languages": """
from hitforge.llm import languages
from hitforge.llm.shingles import bounded
model = languages.LanguageModel(("a", "b"), np.log(np.random.default_rng(1).random((languages.BUCKETS, 2))).astype(np.float32), np.ones((languages.N_SCRIPTS, 2), bool))
emit = np.concatenate([model.scores(w)[w.which].astype(np.float32) for w in map(languages.read_words, bounded(Texts(column)))])
assert len(languages.viterbi(emit, np.array([0, len(emit)]))) == 13 * 1_040_000
""",
    "byte_bpe": """
from hitforge.llm import byte_bpe
code = byte_bpe.coder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
assert sum(len(code.decode(ids.tolist())) for ids in next(code.encoded(Texts(column)))) == size
""",
    "token_counts": """
from hitforge.llm import token_counts
counter = token_counts.tokenizer(public_tokenizers.path("word_bpe_49k.json"))
data = Texts(column).data
cuts = list(parts(data, SMALL_PIECE))
assert len(cuts) > 50 and sum(int(counter.counts([data[a:b].tobytes().decode()])[0]) for a, b in cuts) > 13 * 1_040_000
""",
    "shingles": """
from hitforge.llm.shingles import shingle_sets
assert 5_000 <= len(next(shingle_sets(Texts(column), 5))) < 6_000
""",
    "filter_audit": """
from hitforge.llm import filter_audit
assert filter_audit.text_failures(Texts(column).data) == 0b0010
""",
    "source_divergence": """
from collections import Counter
from hitforge.llm import source_divergence
from hitforge.llm.text_batches import counted_words
found = Counter()
for terms in counted_words(Texts(column).data, source_divergence.terms_of):
    found.update(terms)
assert sum(found.values()) == 11 * 1_040_000 and len(found) == 10
""",
    "substring_dedup": """
from hitforge.llm import substring_dedup
table = pa.table({"doc_id": pa.array([1]), "text": pa.chunked_array([column])})
del column
for length in substring_dedup.lengths():
    windows = substring_dedup.Windows(table, length, length == 13)
    assert len(windows.order) == 13 * 1_040_000 - length + 1 and len(windows.first) < 14_000
    del windows
""",
    "personal_data": """
from hitforge.llm import pii
t = column[0].as_py()
assert pii.base_spans(t) == [] and pii.decode(pii.candidates(t), pii.plain_weights()) == []
""",
}


@pytest.mark.parametrize("name", CODE)
def test_long_text(name):
    root = Path(__file__).resolve().parent.parent.parent
    done = subprocess.run([sys.executable, "-c", HEAD + CODE[name] + TAIL], cwd=root, env={"PYTHONPATH": str(root), "PATH": "/usr/bin:/bin"}, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
