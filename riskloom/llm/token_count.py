"""Token counts of a byte-level BPE vocabulary by finite transducers, without running a tokenizer.

Two deterministic machines follow each other.

*Splitter.*  Eight states read the class of every character (letter, digit, space, ...) and tell where pieces begin.
Texts are cut into chunks; every chunk's map from entry state to exit state is found for all chunks at once, the maps
are composed by a parallel prefix scan, and a second pass with the known entry states marks the pieces.

*Counter.*  Reads the bytes of a piece.  Its state holds all that later bytes can depend on: the longest ending that
begins some token, and for each place inside that ending the last token of the canonical tokenization up to there and
how many tokens came before.  Transitions carry the change of the token count.  Of the tokens that can end at a byte just one
extends the tokenization at its own beginning, and a pair of tokens may stand together exactly if merging its bytes
gives that pair again.  States are built when first reached and kept per worker, up to a bound; beyond it the machine
starts anew, which costs time and changes no count.

* A null or empty text has no tokens and no bytes.
* Strings of added special tokens count as one token each, as the library does by default.
* Repeated rows and rows without id are counted like any other; a text of any length is read whole.
"""

from __future__ import annotations

import json
import unicodedata
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import SLICE_CHARS, slices

# Classes of characters as the splitter sees them.
LETTER, DIGIT, OTHER, QUOTE, SHORT1, SHORT2, LAST_SPACE, LAST_BLANK, BLANK, CUT = range(10)
# States: between pieces; in letters, digits, others; after a leading space; in blanks; one or two letters to go.
NONE, IN_LETTERS, IN_DIGITS, IN_OTHERS, AFTER_SPACE, IN_BLANKS, ONE_LEFT, TWO_LEFT = range(8)
STATES, CHUNK = 8, 128
#: Counter states and pieces that a worker keeps before it starts anew.
STATE_BOUND, PIECE_BOUND = 150_000, 400_000
#: White space as the splitting rule of the vocabulary sees it (fixed values).
BLANKS = (0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

#: Letters and digits of Unicode 16 that older tables of Python lack (fixed values).
LATE_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
LATE_DIGITS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
)


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a piece begins here" for every class and state, flat."""
    to = np.zeros((10, STATES), np.uint8)
    begins = np.ones((10, STATES), bool)
    fresh = {LETTER: IN_LETTERS, DIGIT: IN_DIGITS, OTHER: IN_OTHERS, QUOTE: IN_OTHERS, SHORT1: ONE_LEFT, SHORT2: TWO_LEFT, LAST_SPACE: AFTER_SPACE, LAST_BLANK: NONE, BLANK: IN_BLANKS, CUT: NONE}
    plain = {LETTER: IN_LETTERS, DIGIT: IN_DIGITS, OTHER: IN_OTHERS, QUOTE: IN_OTHERS, SHORT1: IN_OTHERS, SHORT2: IN_OTHERS}
    for c in range(10):
        to[c] = fresh[c]
        going = plain.get(c, IN_BLANKS if c == BLANK else None)
        if going is not None:
            to[c, going], begins[c, going] = going, False
        if c in plain:
            to[c, AFTER_SPACE], begins[c, AFTER_SPACE] = plain[c], False
            to[c, ONE_LEFT], begins[c, ONE_LEFT] = NONE, False
            to[c, TWO_LEFT], begins[c, TWO_LEFT] = ONE_LEFT, False
    begins[CUT] = True
    return to.reshape(-1), begins.reshape(-1)


def character_classes() -> np.ndarray:
    """Letter, digit, blank or other for every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LN":
            out[c] = LETTER if kind == "L" else DIGIT
    for ranges, number in ((LATE_LETTERS, LETTER), (LATE_DIGITS, DIGIT)):
        for first, last in ranges:
            out[first : last + 1] = number
    out[list(BLANKS)] = BLANK
    return out


def symbols(codes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The splitter's input; code point 0x110000 marks the end of a text or a special token."""
    cut = codes == 0x110000
    sym = classes[np.where(cut, 0, codes)]
    sym[cut] = CUT
    after = np.append(sym[1:], CUT)
    blank = sym == BLANK
    last = blank & (after != BLANK) & (after != CUT)
    sym[last] = np.where(codes[last] == 0x20, LAST_SPACE, LAST_BLANK)
    quote = np.flatnonzero(codes == 0x27)
    if len(quote):
        padded = np.concatenate([codes, [0x110000, 0x110000]])
        one, two = padded[quote + 1], padded[quote + 2]
        short1 = np.isin(one, [ord(c) for c in "stmd"])
        short2 = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            short2 |= (one == ord(a)) & (two == ord(b))
        sym[quote] = np.where(short1, SHORT1, np.where(short2, SHORT2, QUOTE))
    return sym


def piece_starts(sym: np.ndarray, to: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each symbol: chunk maps, their prefix scan, then the chunks with known entry states."""
    n = len(sym)
    chunks = -(-n // CHUNK)
    grid = np.full(chunks * CHUNK, CUT, np.uint8)
    grid[:n] = sym
    grid = np.ascontiguousarray(grid.reshape(chunks, CHUNK).T).astype(np.intp) * STATES
    maps = np.tile(np.arange(STATES, dtype=np.intp), (chunks, 1))
    for row in grid:
        maps = to[row[:, None] + maps]
    reach = 1
    while reach < chunks:
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), axis=1)
        reach *= 2
    state = np.concatenate(([NONE], maps[:-1, NONE])).astype(np.intp)
    marks = np.empty((CHUNK, chunks), bool)
    for t, row in enumerate(grid):
        at = row + state
        marks[t] = begins[at]
        state = to[at].astype(np.intp)
    return marks.T.reshape(-1)[:n]


NEVER = 1 << 30
ZERO = 128  # a place's value holds its token and its count less the newest one, shifted to be positive


class Counter:
    """The counting transducer, built as far as the pieces ask for it.

    ``merges`` has the rank of every pair of neighbours that merges, as bytes.  A *node* is the longest ending of what
    was read that begins a token; its *live* lengths are those of its endings that begin a token too (0 included), so
    later tokens begin at these distances from the end.  A *state* is a node and a value for each live length.
    """

    def __init__(self, merges: dict[tuple[bytes, bytes], int]):
        self.merges = merges
        self.parts = {a + b: (a, b) for (a, b) in merges}
        self.text = [b"", *(bytes((b,)) for b in range(256)), *self.parts]
        self.token = {t: i for i, t in enumerate(self.text) if t}
        self.begins = {t[:k] for t in self.token for k in range(len(t) + 1)}
        self.edges: tuple[dict, dict] = ({}, {})
        self.reset()

    def reset(self) -> None:
        self.nodes, self.node = [b""], {b"": 0}
        self.live = [(0,)]
        self.turns: dict[int, tuple] = {}
        self.states = [(0, (ZERO,))]
        self.number = {self.states[0]: 0}
        self.steps: dict[int, tuple[int, int]] = {}
        self.pairs: dict[int, bool] = {}

    def edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """What stands at the left (0) or right (1) end of a token while it is merged, each with the rank that ends it."""
        known = self.edges[side].get(token)
        if known is None:
            chain = [token]
            while chain[-1] in self.parts:
                chain.append(self.parts[chain[-1]][side])
            chain.reverse()
            known = self.edges[side][token] = [(t, self.merges[self.parts[u]]) for t, u in zip(chain, chain[1:])] + [(token, NEVER)]
        return known

    def may_follow(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border of two tokens while each of them is merged."""
        known = not left or self.pairs.get(left << 20 | right)
        if known is None:
            ends, heads = self.edge(self.text[left], 1), self.edge(self.text[right], 0)
            i = j = 0
            while True:
                (x, before), (y, after) = ends[i], heads[j]
                rank = self.merges.get((x, y), NEVER)
                if rank < before and rank <= after:  # of equal ranks the one further left goes first
                    known = False
                    break
                if before == after == NEVER:
                    known = True
                    break
                if before <= after:
                    i += 1
                else:
                    j += 1
            self.pairs[left << 20 | right] = known
        return known

    def turn(self, node: int, byte: int) -> tuple:
        """Next node, the tokens that may end here with the place before each, and the places that stay live."""
        ending = self.nodes[node] + bytes((byte,))
        while ending not in self.begins:
            ending = ending[1:]
        to = self.node.get(ending)
        if to is None:
            to = self.node[ending] = len(self.nodes)
            self.nodes.append(ending)
            self.live.append(tuple(n for n in range(len(ending), 0, -1) if ending[-n:] in self.begins) + (0,))
        place = {n: i for i, n in enumerate(self.live[node])}
        ends = [(place[n - 1], self.token[ending[-n:]]) for n in range(len(ending), 0, -1) if ending[-n:] in self.token]
        out = self.turns[node << 8 | byte] = (to, ends, [place[n - 1] for n in self.live[to] if n])
        return out

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """Next state and the change of the token count."""
        node, values = self.states[state]
        to, ends, stay = self.turns.get(node << 8 | byte) or self.turn(node, byte)
        for at, token in ends:
            if self.may_follow(values[at] >> 8, token):
                break
        newest = (values[at] & 255) - ZERO + 1
        new = (to, (*[values[i] - newest for i in stay], token << 8 | ZERO))
        number = self.number.get(new)
        if number is None:
            number = self.number[new] = len(self.states)
            self.states.append(new)
        out = self.steps[state << 8 | byte] = (number, newest)
        return out

    def count(self, piece: bytes) -> int:
        if len(self.states) > STATE_BOUND or len(self.pairs) > 4 * STATE_BOUND:
            self.reset()
        state = total = 0
        steps = self.steps
        for byte in piece:
            state, more = steps.get(state << 8 | byte) or self.step(state, byte)
            total += more
        return total


class Pieces(dict):
    """Token counts of pieces met before; when there are too many, the first quarter stays, as frequent pieces come early."""

    def __init__(self, counter: Counter):
        self.counter = counter

    def __missing__(self, piece: str) -> int:
        if len(self) > PIECE_BOUND:
            for old in list(islice(self, PIECE_BOUND // 4, None)):
                del self[old]
        n = self.counter.count(piece.encode())
        self[piece] = n
        return n


def byte_of() -> dict[str, int]:
    """The vocabulary writes every byte as a printable character: itself if it is printable, else one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> dict:
    """Merge ranks and special strings of a vocabulary file.  Its size does not depend on the data."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    byte = byte_of()
    raw = lambda s: bytes(byte[c] for c in s)
    merges = {}
    for i, pair in enumerate(file["model"]["merges"]):
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        merges.setdefault((raw(left), raw(right)), i)
    return {"merges": merges, "special": [t["content"] for t in file["added_tokens"]]}


def counted(texts: list[str], special: list[str], classes: np.ndarray, to: np.ndarray, begins: np.ndarray, pieces: dict) -> list[int]:
    """Tokens of each text."""
    parts, owner, extra = [], [], [0] * len(texts)
    for i, x in enumerate(texts):
        own = [x]
        for s in special:
            if s in x:
                own = [y for part in own for y in part.split(s)]
        extra[i] = len(own) - 1
        parts += own
        owner += [i] * len(own)
    joined = "\0".join(parts)
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).copy()
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes + 1) - 1
    codes[ends[:-1]] = 0x110000
    starts = np.flatnonzero(piece_starts(symbols(codes, classes), to, begins))
    stops = np.append(starts[1:], len(codes))
    real = codes[starts] != 0x110000
    starts, stops = starts[real], stops[real]
    counts = np.fromiter((pieces[joined[a:b]] for a, b in zip(starts.tolist(), stops.tolist())), np.int64, len(starts))
    which = np.array(owner)[np.searchsorted(ends, starts)]
    total = np.bincount(which, counts, minlength=len(texts)).astype(np.int64) + np.array(extra)
    return total.tolist()


def token_count(spark: SparkSession, text: Column, path: str) -> Column:
    """Tokens of a text column by the vocabulary file at ``path``, which only the driver reads."""
    # Plain data, so that workers need no class of this package to read it; "kept" lives as long as the worker.
    shared = spark.sparkContext.broadcast(read_vocabulary(path) | {"classes": character_classes(), "kept": {}})

    def count(texts: pd.Series) -> pd.Series:
        v = shared.value
        if "pieces" not in v["kept"]:
            v["kept"]["pieces"] = Pieces(Counter(v["merges"]))
        to, begins = splitter()
        values = ["" if x is None else x for x in texts]
        out: list[int] = []
        for a, b in slices(values, SLICE_CHARS):
            out += counted(values[a:b], v["special"], v["classes"], to, begins, v["kept"]["pieces"])
        return pd.Series(out, dtype="int64")

    return F.pandas_udf(count, "long")(F.coalesce(text, F.lit("")))
