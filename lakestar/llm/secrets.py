"""Secrets in texts, by a trigram index over the documents and exact patterns behind it.

Each rule's pattern is turned into a Boolean query of trigrams that every match must hold: literal
parts are multiplied out over alternatives, options and small classes, and each run of literals asks
for its trigrams. The index holds, for each trigram of any query, which documents have it (in lower
case). It is stored by document, one bit per trigram in a few 64-bit words: intersecting postings is
then a bitwise AND beside the text, so neither postings nor texts are shuffled, whatever a trigram's
share of the documents. Candidates are verified by the pattern. A rule whose pattern has no mandatory
trigram scans every document.

All of it is built-in expressions.

Defined results: a null or empty text has no spans. Rows are judged one by one, so repeated rows have
equal results. Spans of different kinds may overlap. Other columns of the input are kept unless their
names are taken.
"""

from __future__ import annotations

import re._constants as C
import re._parser as parser
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.llm.spans import SPAN, ordered, spans


@dataclass(frozen=True)
class Rule:
    """`group` of a match has `least` characters at least, else the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base kinds, as they are listed.
BASE = [
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
]
#: Kinds that the method adds.
MORE = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN\x20[A-Z\x20]{0,20}PRIVATE\x20KEY-----"),
]

#: Literal strings that a part of a pattern may stand for, at most; beyond that it says nothing.
WIDEST = 64

#: A query: all of these clauses hold; of a clause one set of trigrams is wholly there.
Query = frozenset[frozenset[frozenset[str]]]


def trigram_query(pattern: str) -> Query:
    """The clauses of trigrams, in lower case, that every match of `pattern` satisfies."""
    return frozenset(_sequence(parser.parse(pattern)))


def _sequence(nodes: Iterable) -> set:
    clauses: set = set()
    exact = {""}

    def flush() -> None:
        nonlocal exact
        sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in exact}
        if frozenset() not in sets:
            clauses.add(frozenset(sets))
        exact = {""}

    for node in nodes:
        strings = _strings(node)
        if strings is not None and len(strings) * len(exact) <= WIDEST:
            exact = {a + b for a, b in product(exact, strings)}
            continue
        flush()
        if strings is not None:
            exact = strings
        else:
            clauses |= _inside(node)
    flush()
    return clauses


def _strings(node) -> set[str] | None:
    """All strings that a part matches, in lower case, if they are few."""
    kind, value = node
    if kind is C.LITERAL:
        return {chr(value).lower()}
    if kind is C.IN:
        found = set()
        for what, x in value:
            if what is C.LITERAL:
                found.add(chr(x).lower())
            elif what is C.RANGE and x[1] - x[0] < WIDEST:
                found |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return found if len(found) <= 8 else None
    if kind is C.SUBPATTERN:
        return _product(value[-1])
    if kind is C.BRANCH:
        options = [_product(x) for x in value[1]]
        return set().union(*options) if all(x is not None for x in options) else None
    if kind is C.MAX_REPEAT and value[1] <= 3:
        once = _product(value[2])
        if once is None:
            return None
        found = {"".join(p) for n in range(value[0], value[1] + 1) for p in product(once, repeat=n)}
        return found if len(found) <= WIDEST else None
    return None


def _product(nodes: Iterable) -> set[str] | None:
    found = {""}
    for node in nodes:
        strings = _strings(node)
        if strings is None or len(strings) * len(found) > WIDEST:
            return None
        found = {a + b for a, b in product(found, strings)}
    return found


def _inside(node) -> set:
    """Clauses of a part that is not a few strings: what every repetition or every option holds."""
    kind, value = node
    if kind is C.SUBPATTERN:
        return _sequence(value[-1])
    if kind is C.MAX_REPEAT and value[0] > 0:
        return _sequence(value[2])
    return set()


class TrigramIndex:
    """The trigrams that the queries of some rules ask for, and their bits."""

    BITS = 62

    def __init__(self, rules: list[Rule]):
        self.queries = {r.kind: trigram_query(r.pattern) for r in rules}
        self.trigrams = sorted({t for q in self.queries.values() for clause in q for s in clause for t in s})

    def postings(self, text: Column) -> Column:
        """One bit per trigram, set if the text has it: an array of 64-bit words."""
        lower = F.lower(text)
        words = []
        for at in range(0, max(1, len(self.trigrams)), self.BITS):
            bits = F.lit(0).cast("long")
            for i, trigram in enumerate(self.trigrams[at : at + self.BITS]):
                bits = bits + F.when(F.contains(lower, F.lit(trigram)), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
            words.append(bits)
        return F.array(*words)

    def candidate(self, postings: Column, kind: str) -> Column:
        """Whether the intersected postings of a rule hold a document; true if it has no trigrams."""

        def all_of(trigrams: frozenset[str]) -> Column:
            need: dict[int, int] = {}
            for t in trigrams:
                word, bit = divmod(self.trigrams.index(t), self.BITS)
                need[word] = need.get(word, 0) | 1 << bit
            held = F.lit(True)
            for word, bits in need.items():
                held = held & (postings[word].bitwiseAND(F.lit(bits)) == F.lit(bits))
            return held

        every = F.lit(True)
        for clause in self.queries[kind]:
            some = F.lit(False)
            for trigrams in clause:
                some = some | all_of(trigrams)
            every = every & some
        return every


def _found(text: Column, rule: Rule) -> Column:
    pattern = rule.pattern
    if rule.kind == "hex":  # runs are whole either way; shorter ones need not be listed
        pattern = rf"[0-9a-f]{{{rule.least},}}+"
    keep = (lambda value, part: F.length(part) >= rule.least) if rule.least else None
    return spans(text, rule.kind, pattern, keep, rule.group)


def find_secrets(docs: DataFrame, text: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """`docs` with `spans`: kind, start, end and value of each secret, by start, then kind as listed."""
    rules = [*BASE, *MORE] if rules is None else rules
    index = TrigramIndex(rules)
    others = [c for c in docs.columns if c.lower() != "spans"]
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*others, body.alias("_text"), index.postings(body).alias("_postings"))
    found = [
        F.when(index.candidate(F.col("_postings"), r.kind), _found(F.col("_text"), r)).otherwise(F.array().cast(SPAN))
        for r in rules
    ]
    return rows.select(*others, ordered(F.concat(*found), [r.kind for r in rules]).alias("spans"))
