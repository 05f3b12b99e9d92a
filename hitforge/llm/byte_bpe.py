"""Byte-level BPE encoding and decoding (operator 6).

Texts are split without a regular expression: every code point becomes a class, a transducer over classes runs as an
associative scan and marks where pieces begin. Pieces are byte slices of the text, looked up in a cache of finished
merges; only a piece that isn't there is merged. Offsets of tokens in the text's bytes are kept on request, for
decoding of a stretch.

Edge cases: a null or empty text has no tokens, and the digests are those of empty input. A text of any length is read in
bounded parts, cut where a word ends; only a single run of letters can't be cut. Of equal ranks the leftmost pair merges
first. Repeated rows give repeated rows. An empty table gives an empty table. Other columns of the input are not carried
along, whatever their names.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitforge.llm.pair_merge import NEVER, KeptPieces, merge
from hitforge.llm.text_batches import SMALL_PIECE, Texts, bound_batches, parts, pieces, releasing
from hitforge.llm.transducer import byte_level_splitter, split


#: Pieces that each of the cache's two generations holds, about 150 bytes each.
MOST_PIECES = 200_000


class ByteBpe(KeptPieces):
    """The cache of piece to packed token ids, with the ranks that fill it."""

    def __init__(self, path: str):
        super().__init__(MOST_PIECES)
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.packed = [np.int32(rank).tobytes() for rank in range(len(self.bytes_of))]
        self.single, self.sizes = [bytes([i]) for i in range(256)], np.array([len(b) for b in self.bytes_of], np.int64)

    def make(self, piece: bytes) -> bytes:
        """Token ids of one piece, four bytes each: the piece itself if it is a token, else what pair merging leaves."""
        if (whole := self.ranks.get(piece)) is not None:
            return self.packed[whole]
        get = self.ranks.get
        return b"".join([self.packed[self.ranks[part]] for part in merge([self.single[b] for b in piece], lambda a, b: get(a + b, NEVER))])

    def decode(self, ids) -> bytes:
        """The bytes that token ids stand for."""
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def encoded(self, texts: Texts) -> Iterator[Iterator[np.ndarray]]:
        """For each text its token ids, a long text's in several arrays."""
        if len(texts) == 1:
            yield (next(self.encode_texts(texts.data[a:b], np.array([0, b - a])))[0] for a, b in parts(texts.data))
        else:
            yield from map(iter, self.encode_texts(texts.data, texts.offsets))

    def encode_texts(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[list[np.ndarray]]:
        """For each text an array with the ids of its pieces, in order."""
        bounds, first, _ = split(byte_level_splitter(), data, offsets)
        raw, cuts, first = data.tobytes(), bounds.tolist(), first.tolist()
        for a, b in zip(first, first[1:], strict=False):
            yield [np.frombuffer(b"".join([self[raw[i:j]] for i, j in zip(cuts[a:b], cuts[a + 1 : b + 1], strict=True)]), np.int32)]


@functools.lru_cache(maxsize=2)
def coder(path: str) -> ByteBpe:
    """One coder for each worker and vocabulary."""
    return ByteBpe(path)


def _run(df: DataFrame, text: str, make, fields: list[tuple[str, str, pa.DataType]], keep: dict[str, Column]) -> DataFrame:
    """Adds columns that ``make`` yields for each text to the columns ``keep``."""
    bound_batches(df.sparkSession)
    source = df.select(*[c.alias(name) for name, c in keep.items()], F.col(text).cast("string").alias("_text"))
    kept, names, kinds = len(keep), [*keep, *[n for n, _, _ in fields]], [kind for _, _, kind in fields]
    shape = ", ".join([f"`{name}` {source.schema[name].dataType.simpleString()}" for name in keep] + [f"{n} {s}" for n, s, _ in fields])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(parts, "_text", SMALL_PIECE):
            made = list(zip(*make(texts), strict=True)) or [[] for _ in kinds]
            columns = [part.column(i) for i in range(kept)]
            columns += [pa.array(values, kind) for values, kind in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return source.mapInArrow(releasing(batches), shape)


def encode(df: DataFrame, path: str, text: str = "text", id_col: str = "doc_id", offsets: bool = False) -> DataFrame:
    """id_col, token_ids array<int>, and with ``offsets`` each token's first byte in the text, array<int>."""

    def make(texts):
        code = coder(path)
        for of_text in code.encoded(texts):
            flat = np.concatenate(list(of_text))
            if offsets:
                sizes = code.sizes[flat]
                yield flat, (np.cumsum(sizes) - sizes).astype(np.int32)
            else:
                yield (flat,)

    fields = [("token_ids", "array<int>", pa.list_(pa.int32()))] + [("token_starts", "array<int>", pa.list_(pa.int32()))] * offsets
    return _run(df, text, make, fields, {id_col: F.col(id_col)})


def decode(df: DataFrame, path: str, ids: str = "token_ids", id_col: str = "doc_id") -> DataFrame:
    """id_col and the decoded bytes of an array of token ids; null stays null."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        for part in parts:
            made = [None if row is None else code.decode(row) for row in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.binary())], names=[id_col, "decoded"])

    bound_batches(df.sparkSession)
    source = df.select(id_col, ids)
    return source.mapInArrow(releasing(batches), f"`{id_col}` {source.schema[id_col].dataType.simpleString()}, decoded binary")


def encode_digests(df: DataFrame, path: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id_col, n_tokens, ids_sha256, decoded_sha256: encodes each text, decodes its ids, and returns digests of both."""

    def make(texts):
        code = coder(path)
        for of_text in code.encoded(texts):
            n, said, decoded = 0, hashlib.sha256(), hashlib.sha256()
            for ids in of_text:
                flat = ids.tolist()
                said.update((("," if n and flat else "") + ",".join(map(str, flat))).encode())
                decoded.update(code.decode(flat))
                n += len(flat)
            yield n, said.hexdigest(), decoded.hexdigest()

    fields = [("n_tokens", "bigint", pa.int64()), ("ids_sha256", "string", pa.string()), ("decoded_sha256", "string", pa.string())]
    return _run(df, text, make, fields, {id_col: F.col(id_col)})
