"""URL filters (operator 10), with DataFrame functions only.

Rules of host and path decide first, the longest that fits. Other urls get the verdict of a logistic regression on
hashed character n-grams of host and path, which is trained from a small labelled table of urls: hashing is done by
Spark, the descent over some hundred rows by the driver, and the weights go back as one constant array.

Edge cases: a null url, or one without ``://``, has an empty host and path and is left to the model, whose score is then
that of no n-grams. Ties in the length of rules can't occur, as two rules of one length that fit one url are equal; a
score that equals the threshold blocks. Very long urls are read whole. Repeated rows give repeated rows; an empty table
gives an empty table. Other columns of the input, whatever their names, are not carried along.
"""

from __future__ import annotations

import math
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values: (verdict, host, path).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Hash buckets of n-grams, and the lengths of the n-grams.
BUCKETS, LENGTHS = 4096, (1, 2, 3, 4)
#: Rows of a labelled table that training reads at most, in order of a hash; the table is small by contract.
MOST_LABELLED = 2000

# Words of unwanted and of wanted sites, syllables of wanted sites with invented names, and what stands around
# the names of both kinds alike.
UNWANTED = (
    "casino", "poker", "jackpot", "roulette", "betting", "bets", "pills", "viagra", "payday", "loans", "escort", "adult", "porn", "xxx", "webcam", "warez", "keygen", "crack", "phishing", "malware", "replica", "clickbait",
    "ads", "track", "popup", "spam", "farm", "cheap", "free", "win", "bonus", "hot", "buy", "deals",
)
WANTED = (
    "library", "museum", "school", "college", "weather", "recipes", "travel", "garden", "science", "history", "news", "theatre", "hospital", "council", "nature", "music", "sports", "research", "health", "journal", "archive", "astronomy",
    "north", "river", "city", "open", "letters", "notes", "field", "stone", "bridge", "harbour", "maps", "paper",
)
SYLLABLES = ("the", "tion", "ing", "an", "er", "ou", "re", "in", "sto", "ble", "ma", "li", "ro", "ven", "ka", "du")
#: Shapes of names, in which a and b are words, s and t a few syllables and n a number: an unwanted name is put together, a wanted one is mostly plain.
SHAPES = {
    1: ("{a}-{b}", "{s}-{b}", "{a}{b}{n}", "{a}-{s}{n}", "{a}-{b}-{n}", "{s}-{t}{n}", "{s}-{t}", "{a}-{b}"),
    0: ("{a}", "{s}", "{a}{b}", "{s}", "{a}", "{a}-{b}", "{s}", "{a}", "{s}", "{s}{n}", "{s}{t}", "{a}{b}", "{s}"),
}
PREFIXES = ("", "www.", "m.", "blog.")
ENDINGS = (".org", ".net", ".info", ".example.org", ".example.com", ".example.net")
PATHS = ("/", "/en/1204", "/de/77/", "/article/intro.html", "/news/today?id=3", "/fr/310#top", "/es/45.html")
#: Sites of each kind.
SITES = 600


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label, name, words): 1 for urls to block. Names go through words and shapes by a rule; what surrounds them goes round evenly, so that it tells nothing."""
    rows = []
    for label, words in ((1, UNWANTED), (0, WANTED)):
        for i, (one, two) in zip(range(SITES), permutations(words, 2), strict=False):
            shape = SHAPES[label][(i + i // len(words)) % len(SHAPES[label])]
            made, more = ("".join(SYLLABLES[(i * k + i // k) % len(SYLLABLES)] for k in steps[: 2 + i % 2]) for steps in ((3, 7, 5), (11, 9, 13)))
            name = shape.format(a=one, b=two, s=made, t=more, n=7 * i % 100)
            own = [w for key, w in (("{a}", one), ("{b}", two), ("{s}", made), ("{t}", more)) if key in shape]
            rows.append((f"http://{PREFIXES[i % 4]}{name}{ENDINGS[i // 4 % 6]}{PATHS[i % 7]}", label, name, own))
    values = ", ".join(f"('{u}', {y}, '{n}', array({', '.join(map(repr, own))}))" for u, y, n, own in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(url, label, name, words)")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case, and path; empty where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _grams(host: Column, path: Column) -> Column:
    """Buckets of the n-grams of host and path, each with a mark at its ends; those of one are told from those of the other.

    The short ones tell how names are put together, by hyphens and digits, which holds for words that training hasn't seen.
    """

    def of_length(text: Column, kind: str, n: int) -> Column:
        # matches of no width, one at each character, so that a long url is read once
        grams = F.when(F.length(text) < n, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)))
        return F.transform(grams, lambda g: F.pmod(F.xxhash64(F.concat(F.lit(kind), g)), F.lit(BUCKETS)).cast("int"))

    ends = [(F.concat(F.lit("^"), host, F.lit("|")), "h:"), (F.concat(F.lit("|"), path, F.lit("$")), "p:")]
    return F.array_distinct(F.concat(*[of_length(text, kind, n) for text, kind in ends for n in LENGTHS]))


def train(labelled: DataFrame, url: str = "url", label: str = "label", rounds: int = 30, rate: float = 0.5, decay: float = 1e-4, most: int = MOST_LABELLED) -> tuple[float, list[float]]:
    """Bias and weights by stochastic descent on at most ``most`` rows; zeros where there are none."""
    host, path = host_and_path(F.col(url))
    rows = labelled.filter(F.col(label).isNotNull()).select(_grams(host, path).alias("g"), F.col(label).cast("int").alias("y"), F.xxhash64(url).alias("h")).orderBy("h", "y").limit(most).collect()
    bias, weights = 0.0, [0.0] * BUCKETS
    for i in range(rounds):
        step = rate / (1 + 0.1 * i)
        for grams, y, _ in rows:
            z = bias + sum(weights[g] for g in grams) / math.sqrt(len(grams))
            slope = 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - y
            bias -= step * slope * 0.1
            part = step / math.sqrt(len(grams))
            for g in grams:
                weights[g] -= part * (slope + decay * weights[g])
    return bias, [round(w, 6) for w in weights]


def filter_urls(pages: DataFrame, labelled: DataFrame | None = None, url: str = "url", id_col: str = "page_id", rules=RULES, threshold: float = 0.5) -> DataFrame:
    """id_col, host, path, rule, verdict, and score: the model's probability that the url is unwanted."""
    bias, weights = train(labelled if labelled is not None else labelled_urls(pages.sparkSession))
    table = F.split(F.lit(",".join(f"{w:.6f}" for w in weights)), ",").cast("array<double>")
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, of, start in sorted(rules, key=lambda r: len(r[1] + r[2])):  # longer ones come later and stand outside
        fits = ((F.col("host") == of) | F.col("host").endswith("." + of)) & F.col("path").startswith(start)
        rule, verdict = F.when(fits, F.lit(of + start)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("ruled"), _grams(F.col("host"), F.col("path")).alias("grams"))
    sums = F.aggregate("grams", F.lit(0.0), lambda s, g: s + F.get(table, g))
    score = 1 / (1 + F.exp(-(F.lit(bias) + sums / F.sqrt(F.size("grams")))))
    rows = rows.select(id_col, "host", "path", "rule", "ruled", score.alias("score"))
    return rows.select(id_col, "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"), "score")
