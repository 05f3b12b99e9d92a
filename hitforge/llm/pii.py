"""Personal data by a semi-Markov conditional random field (operator 4).

Candidate segments are all stretches between token boundaries of bounded length around digits and at-signs, each with
every kind that it could be: several starts, ends and kinds compete for the same characters. A segment is scored as a
whole, by its kind together with its groups, separators, check sum, what stands around it and whether it cuts a longer
run. Dynamic programming over segment ends chooses the best set of segments that don't overlap, boundaries and kinds
together; a segment has MOST_CHARS characters and MOST_GROUPS groups at most. What plain base rules find is always among
the results; the field adds spans that overlap none of those: national phone numbers, spelled-out addresses, bank
accounts, cards in other groupings.

All weights are fitted by maximum likelihood on labelled spans: entities and look-alikes are rendered by a seeded
generator into stretches of at most TRAIN_DOCS documents, chosen by a hash; base rules' matches are labels too.

Edge cases: a null text is empty. Base spans of different kinds may overlap each other, as each kind is matched alone.
Sets of segments of equal score: the one whose last segment ends first. Texts are matched in time linear in their length
and may have any; each batch has a bounded size or one text. Repeated rows give repeated rows; an empty table gives an
empty table. Other columns, whatever their names, are not carried along.
"""

from __future__ import annotations

import functools
import hashlib
import math
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitforge.llm.sampling import hashed_sample
from hitforge.llm.text_batches import bound_batches, pieces
from hitforge.storage import written

TRAIN_DOCS = 1200
#: Longest segment in characters and in groups of digits, and the length of a training stretch.
MOST_CHARS, MOST_GROUPS, STRETCH = 80, 9, 160
KINDS = ("email", "ip", "card", "phone")

# Base patterns, of the same matches as the plain ones, without needless starts inside a run.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# An at-sign as written or spelled, what may follow it, and runs of groups of digits.
AT = re.compile(r"@|[(\[]\x20?(?:at|AT)\x20?[)\]]")
FIRST, LABEL = re.compile(r"\x20?[A-Za-z0-9-]+"), re.compile(r"[A-Za-z0-9-]+")
DOT = re.compile(r"\.|\x20?[(\[]\x20?(?:dot|DOT)\x20?[)\]]\x20?|\x20dot\x20")
NUMBERS = re.compile(r"(?:[A-Z]{2}(?=[0-9]{2}))?[0-9](?:[().\x20/_:-]{0,2}(?:[0-9]|[A-Z](?=[A-Z]*[0-9])))+")
GROUP = re.compile(r"[0-9A-Z]+")
# Words that announce a kind.
CUES = {
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell"), "email": ("mail", "contact", "write", "reach"), "card": ("card", "visa", "credit", "payment"),
    "iban": ("iban", "account", "konto", "bank"), "ssn": ("ssn", "social security", "insurance"), "ip": ("ip", "address", "host", "server"),
}


def luhn(digits: str) -> bool:
    """Whether the check digit fits."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def _digits(span: str) -> str:
    return "".join(c for c in span if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base rules' matches: leftmost, non-overlapping in each kind, failing ones dropped; by kind, then start."""
    found = []
    if "@" in text:
        last = 0
        for m in DOMAIN.finditer(text):
            at = start = m.start()
            while start > last and text[start - 1] in LOCAL_CHARS:
                start -= 1
            if start < at:
                found.append(("email", start, m.end()))
                last = m.end()
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def _iban_ok(compact: str) -> bool:
    return 15 <= len(compact) <= 34 and compact.isalnum() and compact.isupper() and int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


Segment = tuple[str, int, int, dict[str, float]]


def _beside(c: str) -> str:
    """The class of a character beside a segment."""
    return "edge" if not c else "space" if c.isspace() else "word" if c.isalnum() else c if c in ".-_+%@/:#" else "mark"


def _features(kind: str, told: list[str], left: str) -> dict[str, float]:
    """Indicators of one segment, each together with the kind; cues in the words before it."""
    x = {kind: 1.0}
    for name in told:
        x[f"{kind} {name}"] = 1.0
    for other, words in CUES.items():
        if any(w in left for w in words):
            x[f"{kind} cue" if other == kind else f"{kind} other cue"] = 1.0
    return x


def _number_kinds(groups: list[str], gaps: list[str], digits: int) -> list[str]:
    """Kinds that groups of digits can be by their number of digits and groups."""
    n, compact = len(groups), "".join(groups)
    if digits < len(compact):
        return ["iban"] if re.match("[A-Z]{2}[0-9]{2}", compact) and 15 <= len(compact) <= 34 else []
    kinds = []
    if n == 4 and all(g == "." for g in gaps) and max(map(len, groups)) <= 3:
        kinds.append("ip")
    if 7 <= digits <= 15 and n <= 6:
        kinds.append("phone")
    if 13 <= digits <= 19 and n <= 6:
        kinds.append("card")
    if digits == 9 and n == 3:
        kinds.append("ssn")
    return kinds


def _number_segments(text: str, begin: int, end: int) -> Iterator[Segment]:
    """Segments of one run of groups: every start and end among the groups, with and without a sign before it."""
    spans = [m.span() for m in GROUP.finditer(text, begin, end)]
    groups = [text[a:b] for a, b in spans]
    sizes = [sum(c.isdigit() for c in g) for g in groups]
    gaps = [text[u[1] : v[0]] for u, v in zip(spans, spans[1:], strict=False)]
    for i, (a, _) in enumerate(spans):
        starts, digits = [a], 0
        if a and text[a - 1] == "(" and ")" in text[a : a + 8]:
            starts.append(a - 1)
        if starts[-1] and text[starts[-1] - 1] == "+":
            starts.append(starts[-1] - 1)
        left = text[max(0, a - 32) : a].lower()
        for j in range(i, min(len(spans), i + MOST_GROUPS)):
            b, digits = spans[j][1], digits + sizes[j]
            if digits > 34 or b - a > MOST_CHARS:
                break
            own = groups[i : j + 1]
            for kind in _number_kinds(own, gaps[i:j], digits):
                compact = "".join(own)
                valid = {
                    "ip": all(int(g) <= 255 for g in own) if kind == "ip" else True, "card": luhn(compact) if kind == "card" else True, "iban": _iban_ok(compact) if kind == "iban" else True,
                    "ssn": own[0] not in ("000", "666") and own[0][0] != "9", "phone": True,
                }[kind]
                shape = "-".join(str(len(g)) for g in own) if len(own) <= 5 else "many"
                told = ["valid" if valid else "invalid", f"shape {shape}", f"gaps {''.join(sorted(set(gaps[i:j])))}", f"digits {digits}"]
                told.append(f"after {_beside(text[b : b + 1])}" if j + 1 == len(spans) else f"cut before {gaps[j]}")
                for s in starts:
                    before = f"before {_beside(text[s - 1 : s])}" if i == 0 or s < a else f"cut after {gaps[i - 1]}"
                    sign = text[s:a]
                    yield kind, s, b, _features(kind, [*told, before, f"sign {sign}"], left)


def _mail_segments(text: str, at: re.Match) -> Iterator[Segment]:
    """Segments around one at-sign: starts among the tokens before it, ends after each label of what follows."""
    spelled, stop = at.group() != "@", at.start()
    while stop and spelled and text[stop - 1] == " " and stop > at.start() - 1:
        stop -= 1
    begin = stop
    while begin and stop - begin < 64 and text[begin - 1] in LOCAL_CHARS:
        begin -= 1
    starts = [i for i in range(begin, stop) if text[i].isalnum() and (i == begin or not text[i - 1].isalnum())]
    if begin < stop and begin not in starts:
        starts.insert(0, begin)
    ends, label = [], FIRST.match(text, at.end())
    dots, words = 0, spelled
    while label and len(ends) < 6:
        ends.append((label.end(), dots, words, label.group().strip()))
        dot = DOT.match(text, label.end())
        if not dot:
            break
        dots, words = dots + 1, words or dot.group() != "."
        label = LABEL.match(text, dot.end())
    for a in [*starts[:1], *starts[-7:]] if len(starts) > 8 else starts:
        left = text[max(0, a - 32) : a].lower()
        before = f"before {_beside(text[a - 1 : a])}" if a == begin else "cut local"
        for b, dots, words, last in ends:
            if b - a <= MOST_CHARS:
                more = "more" if DOT.match(text, b) and LABEL.match(text, DOT.match(text, b).end()) else _beside(text[b : b + 1])
                told = [before, f"after {more}", f"dots {min(dots, 3)}", "spelled" if words else "plain", "ending" if last.isalpha() and 2 <= len(last) <= 10 else "no ending"]
                yield "email", a, b, _features("email", told, left)


def candidates(text: str) -> list[Segment]:
    """Segments (kind, start, end, features of the whole segment) in order of their ends."""
    made: dict[tuple[str, int, int], dict[str, float]] = {}
    for m in NUMBERS.finditer(text):
        if m.end() - m.start() >= 7:
            made.update(((k, a, b), x) for k, a, b, x in _number_segments(text, *m.span()))
    if "@" in text or "(" in text or "[" in text:
        for m in AT.finditer(text):
            made.update(((k, a, b), x) for k, a, b, x in _mail_segments(text, m))
    return sorted(((k, a, b, x) for (k, a, b), x in made.items()), key=lambda c: (c[2], c[1], c[0]))


def _score(weights: dict[str, float], x: dict[str, float]) -> float:
    return sum(weights.get(k, 0.0) * v for k, v in x.items())


def decode(segments: list, weights: dict[str, float]) -> list[tuple[str, int, int]]:
    """The best set of segments that don't overlap; a gap scores 0. Segments come sorted by end."""
    ends, best, chosen = [0], [0.0], [None]
    for kind, a, b, x in segments:
        before = bisect_right(ends, a) - 1
        total = best[before] + _score(weights, x)
        if total > best[-1]:
            ends.append(b)
            best.append(total)
            chosen.append((before, (kind, a, b)))
    out, at = [], len(best) - 1
    while at > 0:
        before, segment = chosen[at]
        out.append(segment)
        at = before
    return out[::-1]


def _expected(segments: list, weights: dict[str, float]) -> list[float]:
    """The probability of each segment under the field, by forward and backward sums over ends and starts."""
    n = len(segments)
    points = sorted({0} | {p for _, a, b, _ in segments for p in (a, b)})
    place = {p: i for i, p in enumerate(points)}
    scores = [_score(weights, x) for *_, x in segments]
    add = lambda u, v: max(u, v) + math.log1p(math.exp(-abs(u - v)))
    ahead, behind = [0.0] * len(points), [0.0] * len(points)
    into, out = [[] for _ in points], [[] for _ in points]
    for i, (_, a, b, _) in enumerate(segments):
        into[place[b]].append(i)
        out[place[a]].append(i)
    for p in range(1, len(points)):
        ahead[p] = ahead[p - 1]
        for i in into[p]:
            ahead[p] = add(ahead[p], ahead[place[segments[i][1]]] + scores[i])
    for p in range(len(points) - 2, -1, -1):
        behind[p] = behind[p + 1]
        for i in out[p]:
            behind[p] = add(behind[p], behind[place[segments[i][2]]] + scores[i])
    return [math.exp(min(0.0, ahead[place[segments[i][1]]] + scores[i] + behind[place[segments[i][2]]] - ahead[-1])) for i in range(n)]


Sample = tuple[list[Segment], set[tuple[str, int, int]]]


def fit(samples: list[Sample], rounds: int = 60, rate: float = 0.3, decay: float = 1e-4) -> dict[str, float]:
    """Weights of greatest likelihood of the labelled segments, by gradient steps scaled for each weight."""
    samples = [s for s in samples if s[0]]
    weights = {k: 0.0 for segments, _ in samples for *_, x in segments for k in x}
    squares = dict.fromkeys(weights, 1e-6)
    for _ in range(rounds):
        slope = {k: -decay * len(samples) * w for k, w in weights.items()}
        for segments, gold in samples:
            for (kind, a, b, x), p in zip(segments, _expected(segments, weights), strict=True):
                off = ((kind, a, b) in gold) - p
                if abs(off) > 1e-4:
                    for k, v in x.items():
                        slope[k] += off * v
        for k, g in slope.items():
            squares[k] += g * g
            weights[k] += rate * g / math.sqrt(squares[k])
    return weights


#: Stretches for rendering where there are no documents.
PLAIN = ("we met on the way home and wrote the matter down for later, as the others had asked", "nothing of this was known when the report came out. It was read by many people", "die Sache wurde am Abend besprochen und dann vergessen, wie so vieles in dem Jahr")


def rendered(stretches: list[str], seed: int = 5) -> list[tuple[str, set[tuple[str, int, int]]]]:
    """Texts with labelled spans: in each stretch an entity or a look-alike, with its cue or without, at a word's end."""
    dice, out = random.Random(seed), []
    number = lambda n: "".join(dice.choice("0123456789") for _ in range(n))
    code = lambda n: "".join(dice.choice("ABCDEFGHJKLMNPQRSTUVWXYZ0123456789") for _ in range(n))
    word = lambda: "".join(dice.choice("abcdefghiklmnoprstuvw") for _ in range(dice.randint(3, 9)))

    def card() -> str:
        body = dice.choice("3456") + number(dice.choice([14, 14, 14, 13]))
        return next(body + c for c in "0123456789" if luhn(body + c))

    def grouped(compact: str, joint: str) -> str:
        return joint.join([compact[:4], compact[4:10], compact[10:]] if len(compact) == 15 else [compact[i : i + 4] for i in range(0, len(compact), 4)])

    def iban() -> str:
        country, body = dice.choice(["DE", "FR", "ES", "IT", "NL", "AT"]), number(dice.choice([16, 18, 20, 23]))
        rest = int("".join(str(int(c, 36)) for c in body + country + "00"))
        compact = f"{country}{98 - rest % 97:02d}{body}"
        return dice.choice([compact, grouped(compact, " ")]) if len(compact) != 15 else compact

    def mail() -> str:
        local, host, ending = dice.choice([word(), f"{word()}.{word()}", f"{word()}{number(2)}"]), dice.choice([word(), f"{word()}.{word()}", f"{word()}-{word()}"]), dice.choice(["com", "org", "net", "info", "de", "es"])
        at = dice.choice(["@", "@", " (at) ", "(at)", " [at] ", "[at]"])
        return f"{local}{at}{host}{'.' if at == '@' else dice.choice([' dot ', '.', ' [dot] ', '(dot)'])}{ending}"

    def phone() -> str:
        area, one, two = dice.choice("23456789") + number(2), number(3), number(4)
        joint = dice.choice("-. ")
        return dice.choice([f"({area}) {one}-{two}", f"{area}{joint}{one}{joint}{two}", f"+{dice.choice(['1', '44', '49'])} {area} {one} {two}", f"+1-{area}-{one}-{two}", f"0{number(2)} {number(7)}", f"0{number(3)}/{number(6)}"])

    entities = {
        "phone": phone, "email": mail, "iban": iban, "ip": lambda: ".".join(str(dice.randint(0, 255)) for _ in range(4)),
        "card": lambda: grouped(card(), dice.choice([" ", "-", "", ".", "_", "/"])), "ssn": lambda: f"{dice.choice('1234578')}{number(2)}-{number(2)}-{number(4)}",
    }
    alike = (
        lambda: f"{dice.randint(1900, 2030)}-{dice.randint(10, 12)}-{dice.randint(10, 28)}", lambda: f"{dice.randint(1, 28)}.{dice.randint(1, 12)}.{dice.randint(1900, 2030)}", lambda: f"{dice.randint(1, 9)}.{number(2)}.{number(1)}",
        lambda: f"{number(4)}-{number(4)}-{number(4)}-{number(4)}", lambda: number(dice.randint(7, 26)), lambda: f"{dice.randint(10, 99)} {number(3)} {number(3)} {number(3)}", lambda: f"{dice.randint(10, 23)}:{number(2)}:{number(2)} {dice.randint(1900, 2030)}",
        lambda: f"{number(2)}.{number(4)} {number(2)}.{number(4)}", lambda: f"978-{number(1)}-{number(2)}-{number(6)}-{number(1)}", lambda: f"{dice.choice(['000', '666', '912'])}-{number(2)}-{number(4)}", lambda: f"{dice.randint(256, 999)}.{number(2)}.{number(2)}.{number(1)}",
        lambda: f"{dice.randint(1900, 2029)}-{dice.randint(1900, 2029)} {dice.randint(1, 99)}", lambda: f"{word()} (at) {word()}", lambda: f"{word()}@{word()}", lambda: f"no. {number(3)}.{number(3)}.{number(4)}", lambda: f"{number(3)}-{number(4)}",
        lambda: code(20), lambda: code(12), lambda: f"{dice.choice(['DE', 'FR', 'XQ'])}{number(dice.randint(14, 24))}",
    )
    needs_cue = ("ssn",)
    for stretch in stretches:
        words = stretch.split(" ")
        at = dice.randint(0, len(words))
        kind = dice.choice([*entities, *entities, None, None, None, None, None])
        said, cue = (entities[kind]() if kind else dice.choice(alike)()), ""
        if kind and (dice.random() < 0.5 or kind in needs_cue or said[:1] == "0"):
            cue = dice.choice(CUES[kind]) + dice.choice([" ", ": ", " is ", " no. "])
        before = " ".join(words[:at])
        before = (before + dice.choice([" ", " ", " (", ", "]) if before else "") + cue
        text = before + said + dice.choice([" ", " ", ". ", ", ", ") "]) + " ".join(words[at:])
        gold = {(kind, len(before), len(before) + len(said))} if kind else set()
        for other in base_spans(text):
            if all(other[2] <= a or b <= other[1] for _, a, b in gold):
                gold.add(other)
        out.append((text, gold))
    return out


def samples_of(stretches: list[str], seed: int = 5) -> list[Sample]:
    """Segments and labels of rendered stretches; labels that no segment has are left out."""
    out = []
    for text, gold in rendered(stretches, seed):
        segments = candidates(text)
        out.append((segments, gold & {c[:3] for c in segments}))
    return out


@functools.cache
def plain_weights() -> dict[str, float]:
    """Weights from rendering into PLAIN alone."""
    return fit(samples_of(list(PLAIN) * 250))


def train(docs: DataFrame, text: str = "text", most: int = TRAIN_DOCS) -> dict[str, float]:
    """Weights from stretches of at most ``most`` different texts, each rendered into once."""
    keys = written(docs.filter(F.length(text) > STRETCH).select(F.xxhash64(F.col(text)).alias("h")).distinct())
    chosen = F.broadcast(hashed_sample(keys, "h", most))
    # a place in the text by its hash
    at = F.pmod(F.col("h"), F.greatest(F.length("t") - STRETCH, F.lit(1))).cast("int") + 1
    rows = docs.filter(F.length(text) > STRETCH).select(F.xxhash64(F.col(text)).alias("h"), F.col(text).cast("string").alias("t")).join(chosen, "h", "left_semi")
    got = rows.select("h", F.substr("t", at, F.lit(STRETCH)).alias("s")).dropDuplicates(["h"]).orderBy("h").collect()
    return fit(samples_of([r.s for r in got] * max(1, most // (2 * len(got))))) if got else plain_weights()


def find_personal_data(docs: DataFrame, weights: dict[str, float], text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id_col and ``entities``: array of (kind, start, end, base) in code points, by start, then kind, then end."""
    bound_batches(docs.sparkSession)
    source = docs.select(F.col(id_col), F.col(text).cast("string").alias("_text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor = re.compile(r"[0-9@]|[(\[](?:at|AT)[)\]]")
        for part, _ in pieces(parts, "_text"):
            rows = []
            for t in part.column(1).to_pylist():
                if not t or not anchor.search(t):
                    rows.append([])
                    continue
                spans = dict.fromkeys(base_spans(t), True)
                held, reach = sorted((a, b) for _, a, b in spans), []
                for _, b in held:  # the furthest end so far
                    reach.append(max(b, reach[-1]) if reach else b)
                for kind_, a, b in decode(candidates(t), weights):
                    before = bisect_left(held, (b, 0))
                    if not before or reach[before - 1] <= a:
                        spans[kind_, a, b] = False
                rows.append([{"kind": k, "start": a, "end": b, "base": spans[k, a, b]} for k, a, b in sorted(spans, key=lambda s: (s[1], s[0], s[2]))])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, kind)], names=[id_col, "entities"])

    return source.mapInArrow(batches, f"`{id_col}` {source.schema[id_col].dataType.simpleString()}, entities array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a digest of the base spans by kind and start, and all spans as text in that order."""
    ranks = [*KINDS, "iban", "ssn"]
    rank = lambda e: F.array_position(F.array(*map(F.lit, ranks)), e["kind"])
    ordered = F.array_sort(F.transform("entities", lambda e: F.struct(rank(e).alias("rank"), e["start"].alias("start"), e["end"].alias("end"), e["kind"].alias("kind"), e["base"].alias("base"))))
    rows = found.select(id_col, ordered.alias("e"))

    def said(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("e", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint").alias(f"n_{kind}")

    return rows.select(id_col, *map(count, KINDS), F.sha2(said(F.filter("e", lambda s: s["base"])), 256).alias("base_sha256"), said(F.col("e")).alias("spans"))


def digest_of(text: str) -> str:
    """The base digest of one text, for comparison."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in sorted(base_spans(text), key=lambda s: (KINDS.index(s[0]), s[1]))).encode()).hexdigest()
