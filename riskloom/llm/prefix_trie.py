"""The trie of the common beginnings of conversations, from ternary search trees.

A node is a distinct sequence of first turns; its members are the conversations that begin with it.  The work is split so
that no task holds a whole conversation, all conversations that share a turn, or all copies of one:

1. turns are reduced to a digest of role and text and a number of words, and numbered within their conversation by ranges
   (a conversation may lie in several; only the numbers of rows of such conversations in each range are summed);
2. conversations are cut into bands of ``BAND`` turns; a band begins at the node where the one before ended, and is a trie of
   its own.  Nearly all conversations have one band.  Equal sequences of a band are counted once;
3. the sequences are sorted into ranges.  A shard is the next sequences of a range, with about ``SHARD_TURNS`` turns: its
   turns are dictionary-encoded, and the codes go into a ternary search tree, the middle sequence first, then those of the
   halves, which keeps the tree balanced as they are sorted.  An iterative walk lists the nodes, and going back
   through the list adds up members, leaves and savings;
4. only nodes on the path of a shard's first or last sequence can be in other shards too.  Their parts add up, as each shard
   knows the sequences next to it: it counts a node once only if the sequence before does not pass it, and a leaf only if the
   sequence after does not go on.  What the ranges did not know of each other is corrected from their first
   and last sequences, one row for each common turn;
5. bands are done from the last to the first: the totals of a band's trie go to the sequence that it continues.

* Null role and text are empty.  Turns of a conversation that share a number are ordered by their digest; null comes first.
* Rows without ``conv_id`` belong to no conversation and are left out.
* Repeated rows are repeated turns.  An empty table has no nodes, not even a root.
* Turns are equal if the 128-bit digests of role and text are.
* There are as many rounds as bands; a conversation of a million turns takes some 250.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import WORD
from riskloom.session import computed

#: Conversations of one family share the beginning of its first one; at most this many turns of it, less one.
FAMILY, HEADS = 20, 4
#: Turns of a band, and of a shard.
BAND, SHARD_TURNS = 4096, 100_000
#: Ids that are joined to one text before they are hashed one after another.
CHUNK = 4096
_KEY = 16
NOBODY = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- turns


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, nth, key, words) of every turn, numbered from 0 in its conversation, and (conv, n) of all conversations."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    words = F.regexp_count(text, F.lit(WORD)).cast("long")
    turns = computed(conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv"), "turn", digest.alias("key"), words.alias("words"), F.rand(0).alias("spread")))
    order = ["conv", F.asc_nulls_first("turn"), "key"]  # equal rows may be told apart by ``spread``, so that ranges can be cut there
    ranged = turns.repartitionByRange(*order, "spread").sortWithinPartitions(*order)

    def count(batches: Iterator[pa.RecordBatch]):
        part, conv, nth = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            out = []
            for x in batch.column("conv").to_pylist():
                nth = nth + 1 if x == conv else 0
                conv = x
                out.append(nth)
            columns = [batch.column("conv"), pa.array(out, pa.int64()), batch.column("key"), batch.column("words"), pa.array([part] * len(out), pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["conv", "nth", "key", "words", "part"])

    ranked = computed(ranged.mapInArrow(count, "conv long, nth long, key binary, words long, part int"))
    convs = computed(ranked.groupBy("conv").agg(F.count("*").alias("n"), F.min("part").alias("low"), F.max("part").alias("high")))
    # A range has one conversation at most that goes on from the range before, so these tables have two rows a range.
    several = convs.where("low < high").select("conv")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranked.join(F.broadcast(several), "conv").groupBy("conv", "part").agg(F.count("*").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    offsets = computed(offsets.select("conv", "part", "offset"))
    nth = F.col("nth") + F.coalesce("offset", F.lit(0))
    return ranked.join(F.broadcast(offsets), ["conv", "part"], "left").select("conv", nth.alias("nth"), "key", "words"), convs.select("conv", "n")


def rebuilt(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """(conv, pos, key, words, length) of the turns of rebuilt conversations, and (conv, length) of all of them.

    A conversation c takes its first h turns from conversation c - c % ``family``, where h is the checksum of c modulo
    ``heads``, and the rest from its own turns after the first h.
    """
    turns, convs = numbered(conversations)
    first = turns.where((F.col("conv") % family == 0) & (F.col("nth") < heads - 1)).groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("nth", "key", "words"))).alias("shared"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    own = convs.withColumns({"h": h, "head": F.col("conv") - F.col("conv") % family}).join(first.withColumnRenamed("conv", "head"), "head", "left")
    taken = F.coalesce(F.slice("shared", F.lit(1), F.col("h").cast("int")), F.array().cast(first.schema["shared"].dataType))
    own = own.withColumn("taken", taken).withColumn("length", F.size("taken") + F.greatest(F.lit(0), F.col("n") - F.col("h")))
    own = computed(own.select("conv", "h", "taken", F.col("length").cast("long").alias("length")))
    copied = own.select("conv", F.posexplode("taken").alias("pos", "x"), "length").select("conv", F.col("pos").cast("long").alias("pos"), "x.key", "x.words", "length")
    rest = turns.join(own.select("conv", "h", F.size("taken").alias("k"), "length"), "conv").where("nth >= h")
    rest = rest.select("conv", (F.col("nth") - F.col("h") + F.col("k")).alias("pos"), "key", "words", "length")
    return copied.union(rest), own.select("conv", "length")


# ---------------------------------------------------------------- one shard


class TernaryTree:
    """A ternary search tree over sequences of numbers; every node stands for the sequence that leads to it."""

    def __init__(self):
        self.symbol: list[int] = []
        self.low: list[int] = []
        self.same: list[int] = []
        self.high: list[int] = []

    def _node(self, symbol: int) -> int:
        self.symbol.append(symbol)
        for links in (self.low, self.same, self.high):
            links.append(-1)
        return len(self.symbol) - 1

    def insert(self, word: list[int]) -> int:
        """The node of the word's last symbol."""
        links, at, node = None, 0, -1  # the link that leads to the next node: the root, or links[at]
        for x in word:
            node = (0 if self.symbol else -1) if links is None else links[at]
            while node >= 0 and self.symbol[node] != x:
                links, at = (self.low if x < self.symbol[node] else self.high), node
                node = links[at]
            if node < 0:
                node = self._node(x)
                if links is not None:
                    links[at] = node
            links, at = self.same, node
        return node

    def insert_sorted(self, words: list[list[int]]) -> list[int]:
        """Insert sorted words, middle ones first."""
        ends, open_ = [-1] * len(words), [(0, len(words))]
        while open_:
            begin, end = open_.pop()
            if begin < end:
                middle = (begin + end) // 2
                ends[middle] = self.insert(words[middle])
                open_ += [(begin, middle), (middle + 1, end)]
        return ends

    def walk(self) -> Iterator[tuple[int, int, int]]:
        """(node, node of the sequence without its last symbol or -1, symbols before the last); a parent comes first."""
        open_ = [(0, -1, 0)] if self.symbol else []
        while open_:
            node, parent, depth = open_.pop()
            yield node, parent, depth
            for links in (self.low, self.high):
                if links[node] >= 0:
                    open_.append((links[node], parent, depth))
            if self.same[node] >= 0:
                open_.append((self.same[node], node, depth + 1))


def _common(a: tuple | None, b: tuple | None) -> int:
    """Symbols that two sequences share at the beginning, the root included."""
    if a is None or b is None or a[0] != b[0]:
        return 0
    n, most = 0, min(len(a[1]), len(b[1]))
    while n < most and a[1][n : n + _KEY] == b[1][n : n + _KEY]:
        n += _KEY
    return 1 + n // _KEY


_NODE = "id binary, depth long, parent binary, conv long, parent_conv long, members long, children long, leaves long, saved long, digest string, shared boolean"
_EDGE = "part int, last boolean, root binary, blob binary, words array<long>"
_NODE_TYPES = [pa.binary(), pa.int64(), pa.binary(), *[pa.int64()] * 6, pa.string(), pa.bool_()]
_EDGE_TYPES = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
_NAMES = [x.strip().split()[0] for x in f"{_NODE}, {_EDGE}".split(",")]


def shard_nodes(rows: list[tuple], before: tuple | None, after: tuple | None) -> list[tuple]:
    """The nodes of sorted sequences between the sequences next to them.

    A row is (root, blob, words, n, conv, root_conv, digest, children, leaves, saved), the last three of what
    continues the sequence, or None.
    """
    keys = [[x[0], *(x[1][i : i + _KEY] for i in range(0, len(x[1]), _KEY))] for x in rows]
    names = sorted({k for ks in keys for k in ks})
    code = {k: i for i, k in enumerate(names)}
    words = [[code[k] for k in ks] for ks in keys]
    tree = TernaryTree()
    ends = tree.insert_sorted(words)
    size = len(tree.symbol)
    parent, depth, ids, order = [-1] * size, [0] * size, [b""] * size, []
    hashers: dict[int, object] = {}
    for node, up, d in tree.walk():
        parent[node], depth[node] = up, d
        order.append(node)
        if up < 0:
            hashers[node] = hashlib.md5(names[tree.symbol[node]])
            ids[node] = names[tree.symbol[node]]
        else:
            hashers[node] = own = hashers[up].copy()
            own.update(names[tree.symbol[node]])
            ids[node] = own.digest()
    members, children, leaves, saved, weight = ([0] * size for _ in range(5))
    conv: list[int | None] = [None] * size
    digest: list[str | None] = [None] * size
    for i, (end, row) in enumerate(zip(ends, rows)):
        members[end], conv[end], digest[end] = row[3], row[4], row[6]
        if row[8] is not None:
            children[end], leaves[end], saved[end] = row[7:10]
        elif tree.same[end] < 0 and not (i == len(rows) - 1 and _common(row, after) == len(words[i])):
            leaves[end] = 1
        # Words of the nodes on the way that no sequence before passed.
        node, old = end, _common(row, rows[i - 1]) if i else 0
        while node >= 0 and depth[node] >= old:
            weight[node] = row[2][depth[node] - 1] if depth[node] else 0
            node = parent[node]
    shared = [False] * size
    paths: list[list[int]] = [[], []]
    for path, node in zip(paths, (ends[0], ends[-1])):
        while node >= 0:
            shared[node] = True
            path.append(node)
            node = parent[node]
    # Nodes that the sequence before the shard passes are not counted again.
    known = set(paths[0][::-1][: _common(before, rows[0])])
    for node in reversed(order):
        fresh = node not in known
        saved[node] += (members[node] - fresh) * weight[node]
        up = parent[node]
        if up >= 0:
            members[up] += members[node]
            leaves[up] += leaves[node]
            saved[up] += saved[node]
            children[up] += fresh
            conv[up] = conv[node] if conv[up] is None else min(conv[up], conv[node])
    for end, row in zip(ends, rows):
        if row[5] is not None:  # members of a band's root are those of the band before
            node = end
            while parent[node] >= 0:
                node = parent[node]
            conv[node] = row[5]
    out = []
    for node in order:
        up = parent[node]
        above = (ids[up], None if shared[up] else conv[up]) if up >= 0 else (None, None)
        out.append((ids[node], depth[node], above[0], conv[node], above[1], members[node], children[node], leaves[node], saved[node], digest[node], shared[node]))
    return out


def _nodes(shard_turns: int):
    def batch(rows: list[tuple], types: list, other: list, first: bool) -> pa.RecordBatch:
        columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)]
        empty = [pa.nulls(len(rows), t) for t in other]
        return pa.RecordBatch.from_arrays(columns + empty if first else empty + columns, names=_NAMES)

    def run(batches: Iterator[pa.RecordBatch]):
        part, rows, turns, before, opening, last = TaskContext.get().partitionId(), [], 0, None, None, None
        every = (tuple(x) for b in batches for x in zip(*(c.to_pylist() for c in b.columns)))
        for row in every:
            opening = opening or row
            if rows and turns + len(row[2]) > shard_turns:
                yield batch(shard_nodes(rows, before, row), _NODE_TYPES, _EDGE_TYPES, True)
                rows, turns, before = [], 0, last
            rows.append(row)
            turns += len(row[2]) + 1
            last = row
        if rows:
            yield batch(shard_nodes(rows, before, None), _NODE_TYPES, _EDGE_TYPES, True)
            yield batch([(part, False, *opening[:3]), (part, True, *last[:3])], _EDGE_TYPES, _NODE_TYPES, False)

    return run


def _corrections(batches):
    """What two ranges counted twice, from the last sequence of one and the first of the next."""
    for b in batches:
        out = []
        for last_root, last_blob, root, blob, words in zip(*(b.column(c).to_pylist() for c in ("last_root", "last_blob", "root", "blob", "words"))):
            common = _common((last_root, last_blob), (root, blob))
            leaf = common == 1 + len(last_blob) // _KEY
            total = sum(words[: common - 1]) if common else 0
            own = hashlib.md5(root)
            for d in range(common):
                if d:
                    own.update(blob[(d - 1) * _KEY : d * _KEY])
                # Savings of this node and of those on the common path below it.
                out.append((own.digest() if d else root, -int(d < common - 1), -int(leaf), total))
                total -= words[d - 1] if d else 0
        columns = list(zip(*out)) or [[], [], [], []]
        types = [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=["id", "children", "leaves", "saved"])


# ---------------------------------------------------------------- all shards


def _digests(ends: DataFrame) -> DataFrame:
    """(id, digest): hash of the ascending ids (conv) that belong to each id, joined by commas; no task holds them all."""

    def chunks(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            out: list[list] = []
            for name, conv in zip(batch.column("id").to_pylist(), batch.column("conv").to_pylist()):
                if not out or out[-1][0] != name or len(out[-1][2]) >= CHUNK:
                    out.append([name, conv, []])
                out[-1][2].append(str(conv))
            columns = [[x[0] for x in out], [x[1] for x in out], [",".join(x[2]) for x in out]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.string()))], names=["id", "conv", "text"])

    def hashed(batches: Iterator[pa.RecordBatch]):
        name, state = None, None
        for batch in batches:
            out = []
            for x, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                if x == name:
                    state.update(b",")
                else:
                    if state:
                        out.append((name, state.hexdigest()))
                    name, state = x, hashlib.sha256()
                state.update(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.string())], names=["id", "digest"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([state.hexdigest()])], names=["id", "digest"])

    pieces = computed(ends.repartitionByRange("id", "conv").sortWithinPartitions("id", "conv").mapInArrow(chunks, "id binary, conv long, text string"))
    return pieces.repartition("id").sortWithinPartitions("id", "conv").select("id", "text").mapInArrow(hashed, "id binary, digest string")


def _named(root: Column, blob: Column) -> Column:
    return F.when(F.length(blob) == 0, root).otherwise(F.unhex(F.md5(F.concat(root, blob))))


def _band(rows: DataFrame, shard_turns: int) -> tuple[DataFrame, DataFrame]:
    """(nodes in one shard, merged nodes that may be in several) of one band."""
    sequences = rows.select("root", "blob", "words", "n", "conv", "root_conv", "digest", "children", "leaves", "saved")
    sequences = sequences.repartitionByRange("root", "blob").sortWithinPartitions("root", "blob")
    found = computed(sequences.mapInArrow(_nodes(shard_turns), f"{_NODE}, {_EDGE}"))
    # Two rows for each range.
    edges = found.where("part IS NOT NULL").groupBy("part").agg(
        *[F.max(F.when(F.col("last") == side, F.struct("root", "blob", "words"))).alias(name) for name, side in (("first", False), ("last", True))]
    )
    by_part = Window.orderBy("part")
    pairs = edges.select(F.lag("last").over(by_part).alias("before"), "first").where("before IS NOT NULL")
    pairs = pairs.select(F.col("before.root").alias("last_root"), F.col("before.blob").alias("last_blob"), "first.root", "first.blob", "first.words")
    more = pairs.mapInArrow(_corrections, "id binary, children long, leaves long, saved long")
    shared = found.where("shared").select("id", "depth", "parent", "conv", "members", "children", "leaves", "saved", "digest").unionByName(more, allowMissingColumns=True)
    merged = shared.groupBy("id").agg(
        *[F.max(c).alias(c) for c in ("depth", "parent", "digest")], F.min("conv").alias("conv"), *[F.sum(c).alias(c) for c in ("members", "children", "leaves", "saved")]
    )
    return found.where("NOT shared"), computed(merged)


def trie(turns: DataFrame, convs: DataFrame, band: int = BAND, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All nodes of conversations given by (conv, pos, key, words, length) and (conv, length).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).
    """
    most = convs.agg(F.max("length").alias("n")).first()["n"]
    pieces = turns.groupBy("conv", F.floor(F.col("pos") / band).cast("int").alias("band")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "key", "words"))).alias("xs"), F.first("length").alias("length")
    )
    pieces = pieces.select("conv", "band", "length", F.unhex(F.array_join(F.transform("xs", lambda x: F.hex(x.key)), "")).alias("blob"), F.col("xs.words").alias("words"))
    silent = convs.where("length = 0").select("conv", F.lit(0).alias("band"), "length", F.unhex(F.lit("")).alias("blob"), F.array().cast("array<bigint>").alias("words"))
    pieces = pieces.unionByName(silent)
    if (most or 0) > band:
        pieces = computed(pieces)
    bands: list[DataFrame] = []
    above = None
    for b in range(max(1, -(-(most or 0) // band))):
        own = pieces.where(F.col("band") == b)
        if above is None:
            own = own.withColumns({"root": F.unhex(F.lit("")), "root_conv": F.lit(None).cast("long")})
        else:
            own = own.join(above, "conv")
        ends = F.col("length") <= (b + 1) * band
        own = computed(own.select("conv", "root", "root_conv", "blob", "words", "length", ends.alias("ends"), _named(F.col("root"), F.col("blob")).alias("id")))
        # Copies of a sequence are summed before they are shuffled.
        single = own.groupBy("id").agg(
            *[F.first(c).alias(c) for c in ("root", "root_conv", "blob", "words")],
            F.count("*").alias("n"), F.min("conv").alias("conv"), F.count_if("ends").alias("n_ends"), F.min(F.when(F.col("ends"), F.col("conv"))).alias("one"),
        )
        single = computed(single)
        many = own.where("ends").select("id", "conv").join(single.where("n_ends > 1").select("id"), "id", "left_semi")
        digest = F.when(F.col("n_ends") == 1, F.sha2(F.col("one").cast("string").cast("binary"), 256)).otherwise(F.col("digest"))
        bands.append(single.join(_digests(many), "id", "left").withColumn("digest", digest))
        above = own.where("NOT ends").select("conv", "id").join(single.select("id", F.col("conv").alias("root_conv")), "id").withColumnRenamed("id", "root")
    parts, below = [], None
    for b in reversed(range(len(bands))):
        if below is None:
            rows = bands[b].withColumns({c: F.lit(None).cast("long") for c in ("children", "leaves", "saved")})
        else:
            rows = bands[b].join(below, "id", "left")
        alone, merged = _band(rows, shard_turns)
        # Trees of later bands may lie in one shard whole; their roots, too, are on its edge or known from there.
        roots = alone.where("depth = 0").select("id", "children", "leaves", "saved").union(merged.where("depth = 0").select("id", "children", "leaves", "saved"))
        below = computed(roots) if b else None
        parents = merged.select(F.col("id").alias("parent"), F.col("conv").alias("shared_conv"))
        both = alone.drop("shared", "part", "last", "root", "blob", "words").unionByName(merged.withColumn("parent_conv", F.lit(None).cast("long")))
        both = both.where(F.col("depth") > 0) if b else both
        both = both.join(parents, "parent", "left").withColumn("parent_conv", F.coalesce("parent_conv", "shared_conv"))
        parts.append(both.withColumn("depth", F.col("depth") + b * band))
    every = parts[0]
    for more in parts[1:]:
        every = every.unionByName(more)
    return every.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), F.col("members").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("digest", F.lit(NOBODY)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS, band: int = BAND, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of the trie of rebuilt conversations (see ``rebuilt``)."""
    turns, convs = rebuilt(conversations, family, heads)
    return trie(turns, convs, band, shard_turns)
