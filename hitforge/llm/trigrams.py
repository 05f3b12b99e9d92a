"""Boolean trigram queries from regular expressions.

A query is a set of alternatives; an alternative is a set of trigrams that must all occur in a text (in lower case) for
the expression to match there by that alternative. A query with an empty alternative says nothing: such a rule needs a
full scan. Queries are necessary conditions only; a match is always verified on the text.
"""

from __future__ import annotations

from itertools import product

Query = frozenset[frozenset[str]]
#: No trigram is mandatory.
ANY: Query = frozenset([frozenset()])
#: Strings and alternatives beyond which a set is given up, which only makes a query weaker.
MOST = 64


def _absorbed(query: set[frozenset[str]]) -> Query:
    """Without alternatives that ask for more than another one does."""
    return frozenset(a for a in query if not any(b < a for b in query))


def _both(a: Query, b: Query) -> Query:
    joined = {x | y for x, y in product(a, b)}
    return _absorbed(joined) if len(joined) <= MOST else min(a, b, key=len)


def _either(queries: list[Query]) -> Query:
    joined = set().union(*queries)
    return _absorbed(joined) if len(joined) <= MOST else ANY


def _of_strings(strings: set[str]) -> Query:
    return _either([frozenset([frozenset(s[i : i + 3] for i in range(len(s) - 2))]) for s in strings]) if strings else ANY


#: All strings that a part of an expression can match, in lower case, or None if they are many; and its query.
Part = tuple[set[str] | None, Query]
#: What a part matches of which nothing is known.
UNKNOWN: Part = (None, ANY)


def _joined(parts: list[Part]) -> Part:
    """Parts behind each other."""
    run, query, exact = {""}, ANY, True
    for strings, own in parts:
        if strings is not None and len(strings) * len(run) <= MOST:
            run = {a + b for a, b in product(run, strings)}
            continue
        query, run, exact = _both(_both(query, _of_strings(run)), own), {""}, False
        if strings is not None:
            run = strings
    return (run, _of_strings(run)) if exact else (None, _both(query, _of_strings(run)))


class _Expression:
    """Reads the syntax that rules are written in: literals, escapes, classes, groups, alternatives, repeats, ^ and $."""

    def __init__(self, pattern: str):
        self.pattern, self.at = pattern, 0

    def ahead(self, n: int = 1) -> str:
        return self.pattern[self.at : self.at + n]

    def take(self, n: int = 1) -> str:
        taken, self.at = self.ahead(n), self.at + n
        return taken

    def alternatives(self) -> Part:
        branches = [self.branch()]
        while self.ahead() == "|":
            self.take()
            branches.append(self.branch())
        if len(branches) == 1:
            return branches[0]
        strings = set().union(*(s for s, _ in branches)) if all(s is not None for s, _ in branches) else None
        return strings, _either([q for _, q in branches])

    def branch(self) -> Part:
        parts = []
        while self.ahead() not in ("", "|", ")"):
            parts.append(self.repeated(self.atom()))
        return _joined(parts)

    def atom(self) -> Part:
        c = self.take()
        if c == "(":
            if self.ahead(2) == "?:":
                self.take(2)
            elif self.ahead() == "?":
                raise ValueError(f"group not supported in {self.pattern}")
            inside = self.alternatives()
            if self.take() != ")":
                raise ValueError(f"open group in {self.pattern}")
            return inside
        if c == "[":
            return self.char_class(), ANY
        if c in "^$":
            return {""}, ANY
        if c == ".":
            return UNKNOWN
        if c == "\\":
            one = self.escape()
            return ({one.lower()}, ANY) if one else UNKNOWN
        return {c.lower()}, ANY

    def escape(self) -> str:
        """The character that an escape stands for; empty for a class of characters."""
        c = self.take()
        if c == "x":
            return chr(int(self.take(2), 16))
        if c in "dDwWsS":
            return ""
        if c.isalnum() or not c:
            raise ValueError(f"escape not supported in {self.pattern}")
        return c

    def char_class(self) -> set[str] | None:
        """The characters of a class, if they are few."""
        many, found, first = self.ahead() == "^", set(), True
        if many:
            self.take()
        while first or self.ahead() != "]":
            first, low = False, self.take()
            if not low:
                raise ValueError(f"open class in {self.pattern}")
            low = self.escape() if low == "\\" else low
            if self.ahead() == "-" and self.ahead(2) != "-]":
                self.take()
                high = self.take()
                high = self.escape() if high == "\\" else high
                many = many or ord(high) - ord(low) >= 8
                found |= set() if many else {chr(i).lower() for i in range(ord(low), ord(high) + 1)}
            else:
                many = many or not low
                found.add(low.lower())
        self.take()
        return None if many or len(found) > 8 else found

    def repeated(self, part: Part) -> Part:
        bounds = {"*": (0, None), "+": (1, None), "?": (0, 1)}.get(self.ahead())
        if bounds:
            self.take()
        elif self.ahead() == "{":
            end = self.pattern.index("}", self.at)
            low, comma, high = self.pattern[self.at + 1 : end].partition(",")
            self.at = end + 1
            bounds = int(low), (int(high) if high else None) if comma else int(low)
        else:
            return part
        if self.ahead() in ("?", "+"):
            self.take()
        (least, most), (strings, query) = bounds, part
        if strings is not None and least == most and least <= 8 and len(strings) ** least <= MOST:
            return {"".join(p) for p in product(strings, repeat=least)}, ANY
        if strings is not None and (least, most) == (0, 1):
            return strings | {""}, ANY
        return None, query if least else ANY


def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query of a regular expression."""
    expression = _Expression(pattern)
    query = expression.alternatives()[1]
    if expression.ahead():
        raise ValueError(f"closed group that isn't open in {pattern}")
    return query


# Fixed value: letters by how often English has them.
FREQUENT = "etaoinshrdlcumwfgypbvkjxqz"


def thinned(queries: list[Query]) -> list[Query]:
    """Weaker queries that ask for fewer different trigrams: one or two rare ones of each alternative, shared ones first.

    They stay necessary conditions, so that an index need only hold these trigrams.
    """
    rare = lambda gram: (sum(FREQUENT.find(c) if c in FREQUENT else 13 for c in gram), gram)
    chosen: set[str] = set()
    for grams in sorted((g for q in queries for g in q), key=lambda g: (len(g), sorted(g))):
        if not grams & chosen:
            chosen |= set(sorted(grams, key=rare)[-2 if len(grams) > 2 else -1 :])
    return [_absorbed({g & chosen for g in q}) for q in queries]
