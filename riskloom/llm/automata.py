"""Finite automata over bytes: small regular expressions, subset construction, minimisation, matching.

The expressions know characters, escapes, ``[...]`` classes, groups, ``|`` and the repeats ``? * + {m} {m,} {m,n}``.
"""

from __future__ import annotations

import re

import numpy as np

ALL = (1 << 256) - 1


class _Reader:
    """Expression text to a tree: ("set", bits), ("seq", [..]), ("alt", [..]) or ("rep", node, least, most)."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def next(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def alternatives(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.at += 1
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("alt", options)

    def sequence(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated(self.atom()))
        return ("seq", parts)

    def repeated(self, node):
        sign = self.peek()
        if sign and sign in "?*+":
            self.at += 1
            return ("rep", node, int(sign == "+"), 1 if sign == "?" else None)
        if found := re.compile(r"\{(\d+)(,?)(\d*)\}").match(self.text, self.at):
            self.at = found.end()
            least = int(found[1])
            return ("rep", node, least, int(found[3]) if found[3] else None if found[2] else least)
        return node

    def byte(self) -> int:
        c = self.next()
        if c == "\\":
            c = self.next()
            if c == "x":
                self.at += 2
                return int(self.text[self.at - 2 : self.at], 16)
        return ord(c)

    def atom(self):
        if self.peek() == "(":
            self.at += 1
            node = self.alternatives()
            assert self.next() == ")", self.text
            return node
        if self.peek() != "[":
            return ("set", 1 << self.byte())
        self.at += 1
        negated = self.peek() == "^"
        self.at += negated
        bits = 0
        while self.peek() != "]":
            low = self.byte()
            high = low
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                high = self.byte()
            for b in range(low, high + 1):
                bits |= 1 << b
        self.at += 1
        return ("set", ALL & ~bits if negated else bits)


def tree(expression: str):
    reader = _Reader(expression)
    node = reader.alternatives()
    assert reader.at == len(expression), f"cannot read {expression}"
    return node


def reversed_tree(node):
    kind = node[0]
    if kind == "seq":
        return ("seq", [reversed_tree(x) for x in reversed(node[1])])
    if kind == "alt":
        return ("alt", [reversed_tree(x) for x in node[1]])
    if kind == "rep":
        return ("rep", reversed_tree(node[1]), *node[2:])
    return node


class _Nfa:
    def __init__(self):
        self.free: list[list[int]] = []
        self.moves: list[list[tuple[int, int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def add(self, node, begin: int) -> int:
        """Build what the node matches from ``begin`` on; gives the state where it ends."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.moves[begin].append((node[1], end))
            return end
        if kind == "seq":
            for part in node[1]:
                begin = self.add(part, begin)
            return begin
        if kind == "alt":
            end = self.state()
            for option in node[1]:
                own = self.state()
                self.free[begin].append(own)
                self.free[self.add(option, own)].append(end)
            return end
        _, inner, least, most = node
        for _ in range(least):
            begin = self.add(inner, begin)
        if most is None:
            loop, end = self.state(), self.state()
            self.free[begin] += [loop]
            self.free[loop] += [end]
            self.free[self.add(inner, loop)].append(loop)
            return end
        end = self.state()
        for _ in range(most - least):
            self.free[begin].append(end)
            begin = self.add(inner, begin)
        self.free[begin].append(end)
        return end

    def closed(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


class Dfa:
    """Minimal deterministic automaton of several expressions.

    ``table[state + byte class]`` is the next state, states being multiples of the number of classes.  Accepting states
    come last: a state accepts if it is at least ``hot``.  ``accept[state]`` has a bit for every expression that it
    accepts.  A search automaton takes a match to begin anywhere, an anchored one only at the first byte.
    """

    def __init__(self, trees: list, search: bool):
        nfa = _Nfa()
        begins = [nfa.state() for _ in trees]
        finals = {nfa.add(t, b): i for i, (t, b) in enumerate(zip(trees, begins))}
        sets = {bits for row in nfa.moves for bits, _ in row}
        kinds: dict[tuple, int] = {}
        classes = [kinds.setdefault(tuple(s >> b & 1 for s in sets), len(kinds)) for b in range(256)]
        sample = [classes.index(c) for c in range(len(kinds))]
        start = nfa.closed(begins)
        number, rows, todo = {start: 0}, [], [start]
        for now in todo:
            row = []
            for b in sample:
                to = {t for s in now for bits, t in nfa.moves[s] if bits >> b & 1}
                to = nfa.closed(to) | start if search else nfa.closed(to)
                if to not in number:
                    number[to] = len(number)
                    todo.append(to)
                row.append(number[to])
            rows.append(row)
        accept = [sum(1 << i for f, i in finals.items() if f in s) for s in todo]
        self.classes = bytes(classes)
        self._minimise(np.array(rows), accept)

    def _minimise(self, rows: np.ndarray, accept: list[int]) -> None:
        """Merge states until those of a block agree on acceptance and on the blocks they lead to."""
        block = np.unique(np.array(accept), return_inverse=True)[1].reshape(-1)
        while True:
            signature = np.column_stack([block, block[rows]])
            finer = np.unique(signature, axis=0, return_inverse=True)[1].reshape(-1)
            if finer.max() == block.max():
                break
            block = finer
        first = {int(b): i for i, b in reversed(list(enumerate(block)))}
        order = sorted(first, key=lambda b: (accept[first[b]] != 0, first[b]))
        place = {b: i for i, b in enumerate(order)}
        width = rows.shape[1]
        self.size, self.start = len(order), place[int(block[0])] * width
        self.table = [place[int(block[t])] * width for b in order for t in rows[first[b]]]
        self.accept = {place[b] * width: accept[first[b]] for b in order if accept[first[b]]}
        self.ending = {s: tuple(i for i in range(bits.bit_length()) if bits >> i & 1) for s, bits in self.accept.items()}
        self.hot = min(self.accept, default=len(self.table))
        self.dead = {s for s in range(0, len(self.table), width) if s not in self.accept and set(self.table[s : s + width]) == {s}}
        self.width = width


class Expression:
    """Leftmost-longest matching of one expression by automata that read backwards and forwards."""

    def __init__(self, expression: str):
        self.tree = node = tree(expression)
        self.forward, self.backward = Dfa([node], False), Dfa([reversed_tree(node)], False)
        self._check(expression)

    def _check(self, expression: str) -> None:
        """The first place where a match ends must belong to the match that begins first."""
        d = self.forward
        steps = [d.table[s : s + d.width] for s in range(0, len(d.table), d.width)]
        row = {s: steps[s // d.width] for s in range(0, len(d.table), d.width)}
        live, todo = set(), [d.start]
        while todo:
            for s in row[todo.pop()]:
                if s not in live and s not in d.dead:
                    live.add(s)
                    if s not in d.accept:
                        todo.append(s)
        pairs = {(p, d.start) for p in live if p not in d.accept}
        todo = list(pairs)
        while todo:
            p, q = todo.pop()
            for a, b in zip(row[p], row[q]):
                if a in d.dead or b in d.dead or a in d.accept or (a, b) in pairs:
                    continue
                if b in d.accept:
                    raise ValueError(f"a match of {expression} can end inside an earlier, longer one")
                pairs.add((a, b))
                todo.append((a, b))

    def longest(self, codes: bytes, begin: int, end: int) -> int:
        """Where the longest match from ``begin`` ends; -1 if there is none.  ``codes`` are the text's classes."""
        d = self.forward
        s, last = d.start, begin if d.start >= d.hot else -1
        for i in range(begin, end):
            s = d.table[s + codes[i]]
            if s >= d.hot:
                last = i + 1
            elif s in d.dead:
                break
        return last

    def leftmost(self, rear: bytes, last: int, least: int) -> int:
        """Where the longest match that ends with byte ``last`` and begins at ``least`` or later begins; -1 if there is none."""
        d = self.backward
        s, begin = d.start, -1
        for j in range(last, least - 1, -1):
            s = d.table[s + rear[j]]
            if s >= d.hot:
                begin = j
            elif s in d.dead:
                break
        return begin

    def matches(self, data: bytes) -> list[tuple[int, int]]:
        """Leftmost-longest matches that do not overlap."""
        return [(begin, end) for _, begin, end in matches(Dfa([self.tree], True), [self], data)]


def matches(together: Dfa, expressions: list[Expression], data: bytes) -> list[tuple[int, int, int]]:
    """(expression, begin, end) of the leftmost-longest matches of every expression, in one pass over the text.

    ``together`` searches for all expressions at once and tells where one may end.  Only there its own automata look at
    the text again: backwards for the beginning, not before the end of its last match, and forwards for the end.  Each
    byte of a match is thus read a fixed number of times.
    """
    out, done = [], [0] * len(expressions)
    coded: dict[int, tuple[bytes, bytes]] = {}
    table, hot, ending = together.table, together.hot, together.ending
    s = together.start
    for i, c in enumerate(data.translate(together.classes)):
        s = table[s + c]
        if s >= hot:
            for n in ending[s]:
                if i >= done[n]:
                    own = expressions[n]
                    if n not in coded:
                        coded[n] = data.translate(own.backward.classes), data.translate(own.forward.classes)
                    rear, codes = coded[n]
                    begin = own.leftmost(rear, i, done[n])
                    if begin >= 0:
                        done[n] = own.longest(codes, begin, len(data))
                        out.append((n, begin, done[n]))
    return out
