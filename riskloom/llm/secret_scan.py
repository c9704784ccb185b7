"""Secret scan: one minimal automaton for all rules, one pass over the bytes of every text.

The rules are compiled to a single deterministic automaton (subset construction, then minimisation) whose transition
array the tasks receive.  One pass over a text tells where each rule's matches end; from such a place the rule's own
automata read back to where the match begins, not beyond the last one, and on to where the longest ends.
The work grows with the length of a text, however many secrets are in it.

* A null or empty text has no spans.
* Spans count code points, the end is exclusive; they are sorted by start, then by the order of the rules.
* Matches of one rule never overlap; spans of different rules may.
* Repeated rows and rows without id are scanned like any other row; a text of any length is read whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.llm.automata import Dfa, Expression, matches


@dataclass(frozen=True)
class Rule:
    """What a secret looks like.  ``least`` characters must follow the longest beginning that ``head`` matches."""

    kind: str
    expression: str
    least: int = 0
    head: str = ""


KEYWORDS = "password|passwd|secret|token|api_?key"


def either_case(text: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in text)


_ASSIGN = rf"({either_case(KEYWORDS)})[\"']?\x20*[:=]\x20*[\"']?"
# A run of hexadecimal digits is never split, so runs too short to pass may be left to the automaton.
BASE = (
    Rule("assign", rf"{_ASSIGN}[A-Za-z0-9+/_.=-]+", 8, _ASSIGN),
    Rule("access", "AKIA[A-Z0-9]+", 16),
    Rule("hex", "[0-9a-f]{8,}", 32),
)
#: Well-known public token shapes beside the base rules.
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", 24),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", "AIza[0-9A-Za-z_-]+", 39),
    Rule("stripe", "[rs]k_(live|test)_[0-9A-Za-z]+", 20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    Rule("private_key", "-----BEGIN( [A-Z]+)* PRIVATE KEY-----"),
)
RULES = BASE + MORE
SPANS = "array<struct<kind:string,start:long,end:long>>"


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.own = [Expression(r.expression) for r in rules]
        self.all = Dfa([x.tree for x in self.own], True)
        self.heads = [Expression(r.head) if r.head else None for r in rules]

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(rule number, first byte, end) of every secret, sorted by start, then rule."""
        found = []
        for n, begin, end in matches(self.all, self.own, data):
            own = self.heads[n]
            head = own.longest(data[begin:end].translate(own.forward.classes), 0, end - begin) if own else 0
            if end - begin - head >= self.rules[n].least:
                found.append((begin, n, end))
        return [(n, begin, end) for begin, n, end in sorted(found)]


@lru_cache(maxsize=8)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def in_code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if not spans or data.isascii():
        return spans
    before = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
    return [(n, int(before[a]), int(before[b])) for n, a, b in spans]


def secret_spans(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans of all secrets of a text column, as an array of (kind, start, end)."""
    return F.pandas_udf(_spans_of(scanner(rules)), SPANS)(F.coalesce(text, F.lit("")).cast("binary"))


def _spans_of(compiled: Scanner):
    kinds = [r.kind for r in compiled.rules]

    def spans(texts: pd.Series) -> pd.Series:
        out = []
        for x in texts:
            data = bytes(x)
            out.append([{"kind": kinds[n], "start": a, "end": b} for n, a, b in in_code_points(data, compiled.spans(data))])
        return pd.Series(out, dtype=object)

    return spans


def redacted(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The text with every secret replaced by ``<kind>``; overlapping spans become one, named after the first.

    A null text stays null; a text without secrets stays as it is.
    """
    compiled = scanner(rules)
    kinds = [r.kind for r in rules]

    def clean(texts: pd.Series) -> pd.Series:
        out = []
        for x in texts:
            data = None if x is None else bytes(x)
            spans = compiled.spans(data) if data else []
            if spans:
                parts, at, last = [], 0, -1
                for n, a, b in spans:
                    if a >= last:
                        parts += [data[at:a], f"<{kinds[n]}>".encode()]
                    last = max(last, b)
                    at = last
                data = b"".join([*parts, data[at:]])
            out.append(None if data is None else data.decode())
        return pd.Series(out, dtype=object)

    return F.pandas_udf(clean, "string")(text.cast("binary"))
