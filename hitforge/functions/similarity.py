"""Similarity of names and symbols. The matching-blocks ratio has no built-in form; it runs on distinct ordered pairs, a batch at a time."""

from __future__ import annotations

import re
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from hitforge.functions.matching import ratios
from hitforge.functions.names import normalize_name, token_jaccard
from hitforge.storage import written

#: What equal symbols add, below which likeness of symbols caps, and the cap.
BONUS, SYMBOLS_DIFFER, CAP = 0.2, 0.8, 0.3


#: Likeness this close counts as equal, as sums of floats depend on their order.
NEAR = 1e-12
#: Texts of a worker's caches, and characters of the longest pair that is kept in them.
KEPT, KEPT_CHARS = 100_000, 400
#: Hits of one tile of a gene's pairs.
TILE = 1024
#: Different pairs of texts that may be broadcast with their likeness, after a count (about 150 bytes each).
BROADCAST_PAIRS = 300_000


def _ratio(a: str, b: str) -> float:
    return 1.0 if a == b else SequenceMatcher(None, a, b).ratio()


_kept_ratio = lru_cache(maxsize=KEPT)(_ratio)


def ratio(a: str, b: str) -> float:
    """Twice the characters in matching blocks over all characters; the order of the arguments matters."""
    return _kept_ratio(a, b) if len(a) + len(b) <= KEPT_CHARS else _ratio(a, b)


def _tokens(name: str) -> frozenset[str]:
    return _kept_tokens(name) if len(name) <= KEPT_CHARS else frozenset(re.findall(r"\w+", name))


@lru_cache(maxsize=KEPT)
def _kept_tokens(name: str) -> frozenset[str]:
    return frozenset(re.findall(r"\w+", name))


def names_alike(a: str, b: str) -> float:
    """The larger of token overlap and ratio, for two normalised names."""
    x, y = _tokens(a), _tokens(b)
    shared = len(x & y) / len(x | y) if x and y else 0.0
    return shared if shared == 1.0 else max(shared, ratio(a, b))


def pair_alike(name_a: str, symbol_a: str, name_b: str, symbol_b: str) -> float:
    """Likeness of two hits from normalised names and lower-case symbols; symbols count only where both hits have one."""
    if not (symbol_a and symbol_b):
        return names_alike(name_a, name_b)
    symbols = ratio(symbol_a, symbol_b)
    if symbols < SYMBOLS_DIFFER:
        x, y = _tokens(name_a), _tokens(name_b)
        if x and y and len(x & y) / len(x | y) >= CAP:  # capped whatever the ratio is
            return CAP
        return min(names_alike(name_a, name_b), CAP)
    likeness = names_alike(name_a, name_b)
    return min(1.0, likeness + BONUS) if symbols == 1.0 else likeness


def _char_counts(texts: list[str]) -> np.ndarray:
    """How often each character of the texts is in each of them."""
    place = {c: i for i, c in enumerate(sorted(set().union(*texts)))}
    counts = np.zeros((len(texts), len(place)), np.int32)
    for row, text in zip(counts, texts, strict=True):
        for c in text:
            row[place[c]] += 1
    return counts


def _ratio_bound(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """What the ratio can reach at most, from character counts: matching blocks take each character once."""
    shared = np.zeros((len(one), len(other)), np.int32)
    for a, b in zip(one.T, other.T, strict=True):
        some, more = np.flatnonzero(a), np.flatnonzero(b)
        if len(some) and len(more):
            shared[np.ix_(some, more)] += np.minimum.outer(a[some], b[more])
    size = one.sum(axis=1)[:, None] + other.sum(axis=1)
    return np.where(size > 0, 2 * shared / np.maximum(size, 1), 1.0)


class Labels:
    """Different pairs of normalised name and lower-case symbol, with their likeness and upper bounds of it as matrices.

    The bounds come from character counts and shared words, so that only pairs which can reach a threshold are compared.
    """

    def __init__(self, names: list[str], symbols: list[str]):
        self.names, self.symbols = names, symbols
        places = {n: i for i, n in enumerate(dict.fromkeys(names))}
        self.own = list(places)
        self.name = np.array([places[n] for n in names], np.int64)
        self.chars = _char_counts(self.own)
        words = [_tokens(n) for n in self.own]
        place = {w: i for i, w in enumerate(sorted(set().union(*words)))}
        self.words = np.zeros((len(self.own), len(place)), np.float32)
        for row, found in zip(self.words, words, strict=True):
            row[[place[w] for w in found]] = 1
        kinds = {s: i for i, s in enumerate(dict.fromkeys(symbols))}
        self.kinds = list(kinds)
        self.symbol = np.array([kinds[s] for s in symbols], np.int64)
        self.blank = np.array([not s for s in symbols], bool)
        chars = _char_counts(self.kinds)
        self.far = _ratio_bound(chars, chars) < SYMBOLS_DIFFER - NEAR

    def _shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Shared words over all words of names, by their numbers."""
        both = (self.words[a] @ self.words[b].T).astype(np.float64)
        return both / np.maximum(self.words[a].sum(axis=1, dtype=np.float64)[:, None] + self.words[b].sum(axis=1, dtype=np.float64) - both, 1)

    def bounds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Upper bounds of the likeness of pairs in ``a`` and ``b``, in whichever order."""
        (one, x), (other, y) = (np.unique(self.name[of], return_inverse=True) for of in (a, b))
        top = np.maximum(_ratio_bound(self.chars[one], self.chars[other]), self._shared(one, other))[np.ix_(x, y)]
        both = ~self.blank[a][:, None] & ~self.blank[b]
        top = np.where(both & (self.symbol[a][:, None] == self.symbol[b]), np.minimum(1.0, top + BONUS), top)
        return np.where(both & self.far[np.ix_(self.symbol[a], self.symbol[b])], np.minimum(top, CAP), top)

    def alike(self, u: int, v: int) -> float:
        """The likeness of two of them, ``u`` being the first."""
        return pair_alike(self.names[u], self.symbols[u], self.names[v], self.symbols[v])

    def likeness(self, some: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """``alike`` of ``some``, the row's one first, where ``wanted``. Each two names and each two symbols are compared once."""
        blank = self.blank[some]
        both = wanted & ~blank[:, None] & ~blank
        symbols = self._ratios(self.symbol[some], both, self.kinds)
        capped = both & (symbols < SYMBOLS_DIFFER)
        name, x = np.unique(self.name[some], return_inverse=True)
        shared = self._shared(name, name)[np.ix_(x, x)]
        compared = wanted & (shared < 1) & ~(capped & (shared >= CAP))
        names = np.maximum(shared, self._ratios(self.name[some], compared, self.own))
        return np.where(capped, np.minimum(names, CAP), np.where(both & (symbols == 1), np.minimum(1.0, names + BONUS), names))

    @staticmethod
    def _ratios(of: np.ndarray, wanted: np.ndarray, texts: list[str]) -> np.ndarray:
        """Ratios of the texts with the numbers ``of`` where they are wanted, else 0."""
        at = np.flatnonzero(wanted)
        pairs, which = np.unique(of[at // len(of)] * len(texts) + of[at % len(of)], return_inverse=True)
        out = np.zeros(wanted.size)
        out[at] = np.array([ratio(texts[p // len(texts)], texts[p % len(texts)]) for p in pairs.tolist()])[which] if len(pairs) else 0.0
        return out.reshape(wanted.shape)


def classes(names: list[str], symbols: list[str]) -> tuple[np.ndarray, Labels]:
    """The number of each row's pair of name and symbol, in order of first rows, and these pairs."""
    places: dict[tuple[str, str], int] = {}
    of = np.array([places.setdefault(pair, len(places)) for pair in zip(names, symbols, strict=True)], np.int64)
    return of, Labels([n for n, _ in places], [s for _, s in places])


@pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """``ratio`` of two columns; the blocks of all pairs of a batch are found side by side."""
    return pd.Series(ratios(a.fillna("").tolist(), b.fillna("").tolist()))


def fmt2(x: Column | str) -> Column:
    """Two decimals of a number, half to even on the exact binary value; only for text sinks.

    A hundred times the number is rounded, and the exact rest of that product (from the number's upper and lower half, of 26
    bits each) decides where the rounded one is halfway. Numbers of 2**45 and more have few decimals and are left to Spark.
    """
    c = (F.col(x) if isinstance(x, str) else x).cast("double")
    size, times = F.abs(c), 100.0 * F.abs(c)
    upper = size * F.lit(134217729.0) - (size * F.lit(134217729.0) - size)
    rest = (upper * 100.0 - times) + (size - upper) * 100.0
    whole = F.floor(times)
    over = (times - whole) - 0.5
    up = (over > 0) | ((over == 0) & ((rest > 0) | ((rest == 0) & (whole % 2 == 1))))
    # a product rounded up to a whole number stands just below it, which rounds to the same
    cents = whole + up.cast("bigint")
    text = F.concat(F.when(c.cast("string").startswith("-"), "-").otherwise(""), F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    return F.when(c.isNull() | F.isnan(c), F.lit(None).cast("string")).when(size < float(1 << 45), text).otherwise(F.format_string("%.2f", c))


def few(scored: DataFrame) -> DataFrame:
    """Scored pairs, written; where a count tells that they are few they are broadcast, so that what asks for them isn't shuffled."""
    scored = written(scored)
    return F.broadcast(scored) if scored.count() <= BROADCAST_PAIRS else scored


def name_similarity(pairs: DataFrame, a: str, b: str, out: str = "similarity") -> DataFrame:
    """Adds the likeness of two normalised name columns; each distinct pair is compared once."""
    distinct = pairs.select(F.col(a).alias("_a"), F.col(b).alias("_b")).distinct()
    shared = distinct.withColumn("_j", token_jaccard(F.col("_a"), F.col("_b")))
    scored = shared.withColumn(out, F.when(F.col("_j") == 1, F.lit(1.0)).otherwise(F.greatest("_j", sequence_ratio("_a", "_b")))).drop("_j")
    return pairs.join(few(scored), F.col(a).eqNullSafe(F.col("_a")) & F.col(b).eqNullSafe(F.col("_b"))).drop("_a", "_b")


def pair_similarity(name_likeness: Column, symbol_a: Column, symbol_b: Column, symbol_likeness: Column) -> Column:
    """Bonus, cap or neither, by the symbols."""
    both = (F.coalesce(symbol_a, F.lit("")) != "") & (F.coalesce(symbol_b, F.lit("")) != "")
    moved = F.when(symbol_likeness == 1, F.least(F.lit(1.0), name_likeness + BONUS)).when(symbol_likeness < SYMBOLS_DIFFER, F.least(name_likeness, F.lit(CAP))).otherwise(name_likeness)
    return F.when(both, moved).otherwise(name_likeness)


def normal_hits(hits: DataFrame) -> DataFrame:
    """gene_id, hit_idx, normalised name and lower-case symbol."""
    return hits.select("gene_id", "hit_idx", normalize_name(F.col("name")).alias("name"), F.lower("symbol").alias("symbol"))


def tiled(rows: DataFrame, place: str, tile: int = TILE) -> DataFrame:
    """Each row once for every tile of its gene's pairs that it is in: ``tile_i`` and ``tile_j``, the lower first, and ``own``.

    A gene's rows are cut into stretches of ``tile`` places; a tile holds two of them, so that a gene of very many rows is
    many groups of bounded size.
    """
    own = (F.col(place) / tile).cast("int")
    counted = rows.withColumn("own", own).withColumn("_last", F.max(own).over(Window.partitionBy("gene_id")))
    return counted.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_last")))).withColumns({"tile_i": F.least("own", "_o"), "tile_j": F.greatest("own", "_o")}).drop("_last", "_o")


def within_gene_pairs(hits: DataFrame, tile: int = TILE) -> DataFrame:
    """Pairs of one gene's hits, the lower index first: gene_id, i, j, names and symbols of both. Hot genes are joined in tiles."""
    rows = tiled(normal_hits(hits), "hit_idx", tile)
    a = rows.filter("own = tile_i").drop("own").withColumnsRenamed({"hit_idx": "i", "name": "name_i", "symbol": "symbol_i"})
    b = rows.filter("own = tile_j").drop("own").withColumnsRenamed({"hit_idx": "j", "name": "name_j", "symbol": "symbol_j"})
    return a.join(b, ["gene_id", "tile_i", "tile_j"]).filter("i < j").drop("tile_i", "tile_j")


def similar_pairs(hits: DataFrame, threshold: float, tile: int = TILE) -> DataFrame:
    """gene_id, i, j, similarity of the pairs of a gene's hits that reach ``threshold``.

    Equal hits are compared once, and only those whose bounds from characters and words can reach the threshold. A tile is
    one task's group, so that its size doesn't grow with the gene.
    """

    def pairs(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.sort_by("hit_idx")
        at, own = rows.column("hit_idx").to_numpy(), rows.column("own").to_numpy()
        of, labels = classes([n or "" for n in rows.column("name").to_pylist()], [s or "" for s in rows.column("symbol").to_pylist()])
        every = np.arange(len(labels.names))
        near = labels.bounds(every, every) >= threshold - NEAR
        ones, others, found = [], [], []
        known: dict[tuple[int, int], float] = {}
        for r in range(len(at)):
            later = np.flatnonzero(near[of[r]][of[r + 1 :]] & ((own[r + 1 :] == key[2].as_py()) & (own[r] == key[1].as_py()))) + r + 1
            for s in later.tolist():
                pair = (int(of[r]), int(of[s]))
                if pair not in known:
                    known[pair] = labels.alike(*pair)
                if known[pair] >= threshold - NEAR:
                    ones.append(r)
                    others.append(s)
                    found.append(known[pair])
        gene = pa.array([key[0].as_py()] * len(ones), table.schema.field("gene_id").type)
        return pa.table([gene, pa.array(at[ones], pa.int64()), pa.array(at[others], pa.int64()), pa.array(found, pa.float64())], names=["gene_id", "i", "j", "similarity"])

    rows = tiled(normal_hits(hits), "hit_idx", tile)
    kind = rows.schema["gene_id"].dataType.simpleString()
    return rows.groupBy("gene_id", "tile_i", "tile_j").applyInArrow(pairs, f"gene_id {kind}, i bigint, j bigint, similarity double")


def similarity_pairs(hits: DataFrame) -> DataFrame:
    """gene_id, i, j and the likeness of both hits, with names and symbols compared once for each distinct pair."""
    pairs = name_similarity(within_gene_pairs(hits), "name_i", "name_j", "name_likeness")
    symbols = pairs.filter("symbol_i <> '' and symbol_j <> ''").select(F.col("symbol_i").alias("_a"), F.col("symbol_j").alias("_b")).distinct()
    symbols = symbols.withColumn("symbol_likeness", sequence_ratio("_a", "_b"))
    joined = pairs.join(few(symbols), (F.col("symbol_i") == F.col("_a")) & (F.col("symbol_j") == F.col("_b")), "left")
    return joined.select("gene_id", "i", "j", pair_similarity(F.col("name_likeness"), F.col("symbol_i"), F.col("symbol_j"), F.col("symbol_likeness")).alias("similarity"))
