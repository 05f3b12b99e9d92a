"""Filter rules as data: read on the driver (a small file by nature), compiled to column expressions."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitforge.functions.names import bad_exact, bad_regex, bad_substring, bound, strip_name

#: Plain rules of up to this many characters must be the whole name; longer ones may stand anywhere in it.
EXACT = 6


@dataclass(frozen=True)
class RuleSet:
    """Strip patterns in order, exact names, substrings, patterns for names, patterns for symbols."""

    strip: tuple[str, ...] = ()
    exact: tuple[str, ...] = ()
    substring: tuple[str, ...] = ()
    regex: tuple[str, ...] = ()
    symbol: tuple[str, ...] = ()

    def clean(self, name: Column) -> Column:
        return strip_name(name, self.strip)

    def is_bad_name(self, name: Column) -> Column:
        """Empty, or hit by an exact, substring or pattern rule."""
        return bound(name, lambda n: F.coalesce((n == "") | bad_exact(n, self.exact) | bad_substring(n, self.substring) | bad_regex(n, self.regex), F.lit(True)))

    def is_bad_symbol(self, symbol: Column) -> Column:
        return F.coalesce((symbol == "") | bad_regex(symbol, self.symbol), F.lit(True))

    def valid_symbol(self, symbol: Column) -> Column:
        """The symbol, or an empty text where it is bad."""
        return bound(symbol, lambda s: F.when(self.is_bad_symbol(s), "").otherwise(s))

    def table(self, spark: SparkSession) -> DataFrame:
        """(kind, rule) rows."""
        rows = [(kind, rule) for kind in ("strip", "exact", "substring", "regex", "symbol") for rule in getattr(self, kind)]
        return spark.createDataFrame(rows, "kind string, rule string")


#: A small general set; users supply what fits their databases.
DEFAULT = RuleSet(
    strip=(r"^(?:predicted|putative|probable)[:\s]+", r"\s*\(fragment\)", r",?\s*isoform\s+\w+$"),
    exact=("orf", "none", "n/a"),
    substring=("uncharacterized protein", "hypothetical protein", "whole genome"),
    regex=(r"^unknown\b", r"^\d+$"),
    symbol=(r"^loc\d+$", r"^\d+$"),
)


def valid_patterns(spark: SparkSession, patterns: list[str]) -> list[bool]:
    """Which patterns Spark's regular expressions accept: they are compiled by the JVM's own pattern class, without a job."""
    from pyspark.errors import IllegalArgumentException  # which a syntax error of a pattern is

    compiler, good = spark.sparkContext._jvm.java.util.regex.Pattern, []
    for pattern in patterns:
        try:
            compiler.compile(f"(?iU){pattern}")
            good.append(True)
        except IllegalArgumentException:
            warnings.warn(f"rule skipped, not a regular expression: {pattern}", stacklevel=3)
            good.append(False)
    return good


def parse_rules(spark: SparkSession, lines: list[str]) -> RuleSet:
    """``strip_regex:``, ``symbol_regex:`` and ``regex:`` lines, plain lines by length; ``#`` and blank lines are skipped."""
    found: dict[str, list[str]] = {k: [] for k in ("strip", "exact", "substring", "regex", "symbol")}
    for line in (x.strip() for x in lines):
        if not line or line.startswith("#"):
            continue
        for prefix, kind in (("strip_regex:", "strip"), ("symbol_regex:", "symbol"), ("regex:", "regex")):
            if line.startswith(prefix):
                found[kind].append(line[len(prefix) :].strip())
                break
        else:
            found["exact" if len(line) <= EXACT else "substring"].append(line.lower())
    kinds = ("strip", "regex", "symbol")
    good = iter(valid_patterns(spark, [p for k in kinds for p in found[k]]))
    return RuleSet(**{k: tuple(p for p in v if k not in kinds or next(good)) for k, v in ((k, found[k]) for k in (*kinds, "exact", "substring"))})


def read_rules(spark: SparkSession, path: str) -> RuleSet:
    """Reads a rule file through Spark, so that any store works; the file is small by nature."""
    rows = spark.read.text(path, wholetext=True).collect()
    return parse_rules(spark, [line for row in rows for line in row.value.splitlines()])
