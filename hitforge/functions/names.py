"""Column expressions on titles, names, symbols, subject ids, headers and attributes."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word of a name, alike in Java and in other engines' regular expressions.
TOKEN = r"[\p{L}\p{N}_]+"


def bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """f(c) with c worked out once, however often f mentions it, in whatever place the optimizer puts the result."""
    return F.get(F.transform(F.array(c), f), 0)


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def cut_before(c: Column, marker: str) -> Column:
    """The text before the first marker, or all of it."""
    return F.substring_index(c, marker, 1)


def strip_trailing_brackets(c: Column) -> Column:
    """If the text ends in ``]``, cuts it at the first ``[``."""
    return F.regexp_replace(c, r"(?s)\s*\[[^\n]*?\]\s*$", "")


def strip_evidence_tags(c: Column) -> Column:
    """Without GN=, PE=, SV= and {ECO:} tags; texts without any sign of one aren't searched for them."""

    def stripped(x: Column) -> Column:
        return reduce(lambda t, tag: F.regexp_replace(t, tag, ""), (r"\s*GN=\S+", r"\s*PE=\d+", r"\s*SV=\d+", r"\s*\{ECO:[^}]+\}"), x)

    return bound(c, lambda x: F.when(F.contains(x, F.lit("=")) | F.contains(x, F.lit("{ECO:")), stripped(x)).otherwise(x))


def name_from_title(title: Column, subject_id: Column) -> Column:
    """The description in a title; the subject id where there is no title."""
    description = strip(strip_evidence_tags(strip_trailing_brackets(cut_before(title, " OS="))))
    return F.when(F.coalesce(title, F.lit("")) == "", subject_id).otherwise(description)


def symbol_from_title(title: Column) -> Column:
    """What follows the first GN=, or an empty text."""
    return F.regexp_extract(F.coalesce(title, F.lit("")), r"GN=(\S+)", 1)


def hit_source(subject_id: Column) -> Column:
    """sp, tr or other, by the subject id's prefix."""
    return F.when(subject_id.startswith("sp|"), "sp").when(subject_id.startswith("tr|"), "tr").otherwise("other")


def collapse_spaces(c: Column) -> Column:
    """A trailing comma goes, runs of white space become one space, ends are trimmed."""
    return strip(F.regexp_replace(F.regexp_replace(c, r"(?U),\s*$", ""), r"(?U)\s+", " "))


def strip_name(name: Column, patterns: Sequence[str]) -> Column:
    """Applies strip patterns in order and tidies the rest; null if nothing is left."""
    stripped = reduce(lambda c, p: F.regexp_replace(c, f"(?iU){p}", ""), patterns, name)
    return bound(collapse_spaces(stripped), lambda tidy: F.when(tidy != "", tidy))


def bad_exact(name: Column, values: Sequence[str]) -> Column:
    """Whether a name is one of the short rules."""
    return F.lower(strip(name)).isin([v.lower() for v in values]) if values else F.lit(False)


def bad_substring(name: Column, values: Sequence[str]) -> Column:
    """Whether a name contains one of the long rules."""
    if not values:
        return F.lit(False)
    return F.lower(name).rlike("|".join(f"\\Q{v.lower()}\\E" for v in trimmed(values))) if all("\\E" not in v for v in values) else reduce(lambda a, b: a | b, [F.contains(F.lower(name), F.lit(v.lower())) for v in values])


def trimmed(values: Sequence[str]) -> list[str]:
    """The values without those that contain another one."""
    lower = sorted({v.lower() for v in values}, key=lambda v: (len(v), v))
    return [v for i, v in enumerate(lower) if not any(w in v for w in lower[:i])]


#: What makes a pattern mean something else inside an alternation: references to groups, names of groups, comments.
APART = re.compile(r"\\[1-9k]|\(\?<[A-Za-z]|\(\?[a-zA-Z]*x|\\Q")


def bad_regex(name: Column, patterns: Sequence[str]) -> Column:
    """Whether a pattern is found in a name, whatever the case: one alternation of all patterns that can be part of one."""
    together = [p for p in dict.fromkeys(patterns) if not APART.search(p)]
    joined = [f"(?iU)(?:{')|(?:'.join(together)})"] if together else []
    joined += [f"(?iU){p}" for p in patterns if APART.search(p)]
    return reduce(lambda a, b: a | b, [name.rlike(p) for p in joined], F.lit(False))


def normalize_name(name: Column) -> Column:
    """Lower case, one space between words; null becomes empty."""
    return F.coalesce(strip(F.regexp_replace(F.lower(name), r"(?U)\s+", " ")), F.lit(""))


def strip_db_prefix(name: Column) -> Column:
    """Without a leading ``sp|accession|entry``, if text remains."""
    return F.regexp_replace(name, r"^(?:sp|tr)\|[A-Za-z0-9]+\|[A-Za-z0-9_]+\s+(?=[^\n]+$)", "")


def lower_ci_equals(a: Column, b: Column) -> Column:
    """Equality without case."""
    return F.lower(a) == F.lower(b)


def tokens(c: Column) -> Column:
    """The distinct words of a text."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(f"({TOKEN})"), F.lit(1)))


def token_jaccard(a: Column, b: Column) -> Column:
    """Shared words over all words of two texts; 0 if either has none."""
    x, y = tokens(a), tokens(b)
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))).otherwise(0.0)


def extract_accessions(subject_id: Column) -> Column:
    """Candidate keys in order: the whole id, the second part, the third up to ``_``, and NCBI-like ids with and without version."""
    parts = F.split(subject_id, r"\|", -1)
    none = F.array().cast("array<string>")
    versioned = F.regexp_extract_all(subject_id, F.lit(r"([A-Z]{2}_[0-9]+\.?[0-9]*)"), F.lit(1))
    pairs = F.flatten(F.transform(versioned, lambda m: F.array(m, F.substring_index(m, ".", 1))))
    second = F.when(F.size(parts) >= 2, F.array(F.get(parts, 1))).otherwise(none)
    third = F.when(F.size(parts) >= 3, F.array(F.substring_index(F.get(parts, 2), "_", 1))).otherwise(none)
    return F.concat(F.array(subject_id), second, third, pairs)


def split_terms(c: Column) -> Column:
    """The trimmed GO: ids of a list parted by ``;`` or ``,``."""
    return F.filter(F.transform(F.split(c, "[;,]"), lambda x: strip(x)), lambda x: x.startswith("GO:"))


def header_tag(header: Column, tag: str) -> Column:
    """What follows ``tag`` in the first field after the id that begins with it; null if none does."""
    fields = F.slice(F.split(strip(header), r"(?U)\s+"), 2, 1 << 30)
    return F.get(F.transform(F.filter(fields, lambda f: f.startswith(tag)), lambda f: F.substr(f, F.lit(len(tag) + 1))), 0)


def clean_header(header: Column) -> Column:
    """Without Name= and product= fields; a product goes on to the next key."""
    c = F.regexp_replace(header, r"(?U)\bName=\S+\s*", "")
    c = F.regexp_replace(c, r"(?U)\bproduct=[^\n]*?(?=\s+\w+=|$)", "")
    return strip(F.regexp_replace(c, "  +", " "))


def parse_attributes(c: Column) -> Column:
    """``key=value;`` pairs as array of (k, v): each key once, where it first stands, with its last value."""
    pairs = F.filter(F.transform(F.split(c, ";"), lambda a: strip(a)), lambda a: F.contains(a, F.lit("=")))
    kv = F.transform(pairs, lambda a: F.struct(F.substring_index(a, "=", 1).alias("k"), F.substr(a, F.instr(a, "=") + 1).alias("v")))
    keys = F.array_distinct(F.transform(kv, lambda p: p["k"]))
    return F.transform(keys, lambda k: F.struct(k.alias("k"), F.element_at(F.filter(kv, lambda p: p["k"] == k), -1)["v"].alias("v")))


def attribute(parsed: Column, key: str) -> Column:
    """The value of a key in parsed attributes, or null."""
    return F.get(F.transform(F.filter(parsed, lambda p: p["k"] == key), lambda p: p["v"]), 0)


def first_attr(c: Column, key: str) -> Column:
    """The value behind the first ``key=`` anywhere in the attributes; null if there is none."""
    found = F.regexp_extract(c, f"{key}=([^;]+)", 1)
    return F.when(found != "", found)


def percent(n: Column, of: Column) -> Column:
    """100 n / of with one decimal; null for nothing."""
    return F.round(100 * n / F.when(of != 0, of), 1)


def taxa_of(c: Column) -> Column:
    """All taxon numbers of a field, as text."""
    return F.regexp_extract_all(c, F.lit("taxon:([0-9]+)"), F.lit(1))


def replace_spaces(c: Column) -> Column:
    """Spaces as underscores."""
    return F.replace(c, F.lit(" "), F.lit("_"))
