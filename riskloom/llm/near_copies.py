"""Near copies by order MinHash, verified by banded alignment of words.

A text's k-mers are its runs of k words, labelled by how often the run stood before.  Each hash order picks the two smallest
labelled k-mers of a text and hashes them in text order, so texts that hold the k-mers in another order differ.  The
orders (``KINDS``) pick runs of three words, as few longer ones survive where every fifth word is changed; texts of up to
``SHORT`` words also have orders of runs of two, as a changed word leaves them few longer ones.
Texts that share a sketch are candidates; sketches that stand in one text only are dropped first.

Two texts are *linked* if their words differ by at most a fifth of the longer one's (edit similarity 0.8 or more).  Classes are
the components of the links between candidates.  Groups are never paired out:

1. each candidate is aligned with one text: of the shortest texts of its sketches that with which it shares most.  The links
   give components, so a group of near copies costs an alignment for each member; this is done again with
   texts of the largest components that it shares a sketch with;
2. only sketches that stand in several components can hold an open link.  Their texts are compared within tasks, by counts of
   words in about as many bins as a text has words: the sum of the bins in which one text has more is at most the number
   of edits.  Only pairs that this bound leaves are written, once each, and aligned.  Sketches with the same texts are one group.
   A text with a sketch of more than ``BLOCK`` texts, as a passage in common makes them, is compared by words instead: an
   exact prefix filter in which that passage is no key.  Words are labelled by occurrence and ordered from the rarest, by
   counts in a table of fixed size; linked texts of which the longer has n words have all but n / 5 in common, so
   that they share one of their first n / 5 + 1.  Texts that share such a word are a group.  Words that stand in one
   such text only are not even written, and a word of more than ``BLOCK`` texts is compared block by block.

So every candidate pair is either aligned, or in one component already, or too different in words to be linked.

* Equal texts are one node from the start; a null text equals the empty one.  Texts without words are alike only if equal.
* A text of fewer than k words is a single k-mer.
* ``class_id`` is the smallest id of the class, NULL only if no member has an id; rows are told apart by id and text.
* Texts are read whole.
* A text is in one group for each of its open sketches, or for each of the words that begin it.  Only a word that is among the
  rarest of a text and still stands in more than ``BLOCK`` of these texts puts it into several.
"""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.align import banded_distance
from riskloom.llm.common import FILTER_BITS, Words, gram_hashes, id_filter, in_bits, joined_small, mixed, slices, slot_bits
from riskloom.llm.components import components
from riskloom.session import computed, remove, shared_folder

SIMILARITY = 0.8
#: Words of a run, runs that an order picks, and the number of orders; the last kind is for short texts alone.
KINDS = ((3, 2, 56), (2, 2, 24))
SKETCHES = sum(orders for _, _, orders in KINDS)
#: Words of a short text.
SHORT = 24
#: Texts that are compared with one another in one task.
BLOCK = 2048
#: Bins of a long text, and counts that are compared at a time.
MOST_BINS, AT_ONCE = 1 << 13, 1 << 22
#: Words counted together, and rows of the table of counts that are summed at a time.
COUNTED, COUNT_ROWS = 1 << 23, 1 << 16
#: Texts whose sketches and pairs one task handles; the tables of these are narrow, and more files than needed cost disk.
TASK_ROWS = 20_000
#: Rounds in which open texts are aligned with one text of their sketch's largest component, before the rest is compared.
STAR_ROUNDS = 2
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _labelled(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Occurrence-labelled k-mers of all texts in text order, and where each text's begin (one more at the end)."""
    grams = gram_hashes(words.hash, k)
    count = np.maximum(words.count - k + 1, (words.count > 0).astype(np.int64))
    first = np.concatenate(([0], np.cumsum(count)))
    owner = np.repeat(np.arange(len(count)), count)
    inside = np.arange(first[-1]) - first[owner]
    at = words.first[owner] + inside
    short = words.count[owner] < k
    value = np.zeros(len(at), np.uint64)
    value[~short] = grams[at[~short]]
    for i in np.flatnonzero(short):
        own = words.hash[words.first[owner[i]] : words.first[owner[i] + 1]]
        value[i] = gram_hashes(own, len(own))[0] + np.uint64(len(own))
    order = np.lexsort((np.arange(len(value)), value, owner))
    sorted_value, sorted_owner = value[order], owner[order]
    fresh = np.append(True, (sorted_value[1:] != sorted_value[:-1]) | (sorted_owner[1:] != sorted_owner[:-1])) if len(order) else np.zeros(0, bool)
    run = np.flatnonzero(fresh)[np.cumsum(fresh) - 1] if len(order) else np.zeros(0, np.int64)
    nth = np.empty(len(value), np.uint64)
    nth[order] = np.arange(len(order)) - run
    return mixed(value + nth * np.uint64(0x9E3779B97F4A7C15)), first


def _picked(words: Words, k: int, least: int, seeds: range) -> np.ndarray:
    """Sketches of each text: for each seed a hash of the ``least`` smallest k-mers in text order."""
    label, first = _labelled(words, k)
    out = np.zeros((len(words.count), len(seeds)), np.uint64)
    full = np.flatnonzero(words.count > 0)
    if not len(full):
        return out
    begin, size = first[full], np.diff(first)[full]
    for n_seed, seed in enumerate(seeds):
        turn = mixed(np.array([2 * seed + 1, 2 * seed + 2], np.uint64))
        rank = (label ^ turn[0]) * (turn[1] | np.uint64(1))
        picked = np.empty((least, len(full)), np.int64)
        for n in range(least):
            low = np.minimum.reduceat(rank, begin)
            hit = np.flatnonzero(rank == np.repeat(low, size))
            if len(hit) != len(full):  # texts with fewer k-mers than asked for have used them up
                owner = np.repeat(np.arange(len(full)), size)[hit]
                hit = hit[np.searchsorted(owner, np.arange(len(full)))]
            picked[n] = np.where(low == _NONE, len(label), hit)
            rank[hit] = _NONE
        picked.sort(axis=0)
        value = np.zeros(len(full), np.uint64)
        for place in picked:
            value = value * np.uint64(0xA0761D6478BD642F) + np.append(label, np.uint64(1))[place]
        out[full, n_seed] = mixed(value ^ turn[0])  # sketches of different orders never agree
    return out


def sketches(texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(words of each text, sketches of each text); texts without words have sketches of no meaning."""
    words = Words(texts)
    short = np.flatnonzero(words.count <= SHORT)
    values, begin = [], 0
    for k, least, orders in KINDS[:-1]:
        values.append(_picked(words, k, least, range(begin, begin + orders)))
        begin += orders
    every = list(np.concatenate(values, axis=1))
    k, least, _ = KINDS[-1]
    for i, more in zip(short, _picked(Words([texts[i] for i in short]), k, least, range(begin, SKETCHES))):
        every[i] = np.append(every[i], more)
    return words.count, every


def _sketched(batches):
    for batch in batches:
        texts = [x.as_py() for x in batch.column("text")]
        for a, b in slices(texts):
            count, values = sketches(texts[a:b])
            flat = pa.array(np.concatenate(values).view(np.int64))
            ends = np.cumsum([0, *map(len, values)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
            rows = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("node"), pa.array(count.astype(np.int64)), lists], names=["id", "node", "n_words", "sketches"])


def most_edits(n: int) -> int:
    """Edits that texts of which the longer has n words may differ by."""
    return int((1 - SIMILARITY) * n + 1e-9)


def linked(x: list, y: list) -> bool:
    most = most_edits(max(len(x), len(y)))
    a, b = Counter(x), Counter(y)
    return (a - b).total() <= most and (b - a).total() <= most and banded_distance(x, y, most) is not None


def _linked(batches):
    for batch in batches:
        close = [linked(a.as_py().split(), b.as_py().split()) for a, b in zip(batch.column("text_a"), batch.column("text_b"))]
        yield batch.filter(pa.array(close, pa.bool_())).select(["a", "b"])


def _word_counts(batches):
    """How many texts hold each labelled word, counted together by hash: rows of one byte for each count, up to 255."""
    total = np.zeros(COUNTED, np.uint8)
    for batch in batches:
        texts = [x.as_py() for x in batch.column("text")]
        for a, b in slices(texts):
            label, _ = _labelled(Words(texts[a:b]), 1)
            bins, n = np.unique((label % np.uint64(COUNTED)).astype(np.int64), return_counts=True)
            total[bins] = np.minimum(total[bins] + n, 255)
    held = [i for i in range(0, COUNTED, COUNT_ROWS) if total[i : i + COUNT_ROWS].any()]
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array([total[i : i + COUNT_ROWS].tobytes() for i in held], pa.binary())], names=["at", "counts"])


def _summed(group: pa.Table) -> pa.Table:
    total = np.zeros(COUNT_ROWS, np.int64)
    for x in group.column("counts"):
        total += np.frombuffer(x.as_py(), np.uint8)
    return pa.table({"at": group.column("at").slice(0, 1), "counts": [np.minimum(total, 255).astype(np.uint8).tobytes()]})


def _beginnings(shared):
    """Rows (word, nid, n_words, label) of the labelled words that begin a text, rarest first, without those that no other such text has."""

    def run(batches):
        often = shared.value
        for batch in batches:
            texts = [x.as_py() for x in batch.column("text")]
            for a, b in slices(texts):
                label, first = _labelled(Words(texts[a:b]), 1)
                count = often[(label % np.uint64(COUNTED)).astype(np.int64)]
                size = np.diff(first)
                owner = np.repeat(np.arange(b - a), size)
                order = np.lexsort((label, count, owner))
                most = np.array([most_edits(int(n)) + 1 for n in size])
                nth = np.arange(len(label)) - np.repeat(first[:-1], size)
                kept = order[(nth < np.repeat(most, size)) & (count[order] > 1)]
                about = [batch.column(c).take(pa.array(owner[kept] + a)) for c in ("nid", "n_words", "label")]
                yield pa.RecordBatch.from_arrays([pa.array(label[kept].view(np.int64)), *about], names=["word", "nid", "n_words", "label"])

    return run


def _bins(n: int) -> int:
    return min(1 << max(5, (n - 1).bit_length()), MOST_BINS)


def _binned(batches):
    """Words of each text counted in bins; more than 255 in a bin count as 255, which keeps the bound a bound."""
    for batch in batches:
        texts = [x.as_py() for x in batch.column("text")]
        out = []
        for a, b in slices(texts):
            words = Words(texts[a:b])
            for i in range(b - a):
                own = words.hash[words.first[i] : words.first[i + 1]]
                size = _bins(len(own))
                out.append(np.minimum(np.bincount((own & np.uint64(size - 1)).astype(np.int64), minlength=size), 255).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("nid"), pa.array(out, pa.binary())], names=["nid", "bins"])


def _open_pairs(group: pa.Table) -> pa.Table:
    """Pairs of a group, or of two blocks of it, of different components that may be linked by their counts of words.

    A pair is left to the smallest token (sketch or word) that both texts are compared by, so that it is written once.
    """
    order = np.argsort(group.column("n_words").to_numpy(), kind="stable")
    words, node, label = (group.column(c).to_numpy()[order] for c in ("n_words", "nid", "label"))
    left, right = (group.column(c).to_numpy(zero_copy_only=False)[order] for c in ("left", "right"))
    token = group.column("token")[0].as_py()
    held = group.column("tokens").to_pylist()
    before = [frozenset(x for x in held[i] if x < token) for i in order]
    raw = group.column("bins").to_pylist()
    bins = [np.frombuffer(raw[i], np.uint8) for i in order]
    size = np.array([len(x) for x in bins])
    # Texts from here on are too long for a link with the i-th.
    until = np.searchsorted(SIMILARITY * words - 1e-9, words, side="right")
    a, b = [], []
    for c in np.unique(size):
        own = np.flatnonzero((size == c) | (size == 2 * c))  # a longer text's bins are folded
        counts = np.stack([bins[j] if size[j] == c else np.minimum(bins[j].reshape(2, c).sum(axis=0, dtype=np.int16), 255) for j in own]).astype(np.int16)
        for at in np.flatnonzero(size[own] == c):
            i = own[at]
            end = np.searchsorted(own, until[i])
            span = own[at + 1 : end]
            other = np.flatnonzero((label[span] != label[i]) & ((left[i] & right[span]) | (right[i] & left[span])))
            for few in np.array_split(other, 1 + len(other) * c // AT_ONCE):
                gap = counts[at + 1 + few] - counts[at]
                most = np.floor((1 - SIMILARITY) * words[span[few]] + 1e-9)
                more = np.where(gap > 0, gap, 0).sum(axis=1)
                near = (more <= most) & (more - gap.sum(axis=1) <= most)
                for j in span[few[near]].tolist():
                    if before[i].isdisjoint(before[j]):
                        a.append(min(node[i], node[j]))
                        b.append(max(node[i], node[j]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _shared_only(shared):
    """(nid, n_words, own): the sketches of a text that may stand in other texts."""

    def run(batches):
        for batch in batches:
            held = batch.column("sketches")
            flat = held.flatten().to_numpy()
            kept = in_bits(shared.value, flat)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(held.offsets.to_numpy()))
            ends = np.concatenate(([0], np.cumsum(np.bincount(owner, kept, batch.num_rows)))).astype(np.int32)
            own = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[kept]))
            yield pa.RecordBatch.from_arrays([batch.column("nid"), batch.column("n_words"), own], names=["nid", "n_words", "own"])

    return run


def _step() -> Column:
    """The length in steps of which one is the most that two linked texts may differ by."""
    return F.log(F.col("n_words")) / F.log(F.lit(1 / SIMILARITY))


def _close(a: Column | str, b: Column | str) -> Column:
    """Whether two numbers of words are near enough for a link."""
    return F.least(a, b) >= SIMILARITY * F.greatest(a, b) - 1e-9


def _ends() -> list[Column]:
    return [F.min("n_words").alias("shortest"), F.max("n_words").alias("longest")]


def _may_link() -> Column:
    """Whether a group, with its ``_ends``, may hold an open link: it is of several components, and two texts alone are of near length."""
    return (F.col("one") != F.col("other")) & ((F.col("n") > 2) | _close("shortest", "longest"))


class NearCopies:
    """Classes of near copies of a table.  Different texts are numbered (``nid``)."""

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text"):
        body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
        self.spark = docs.sparkSession
        self.docs = docs.select(F.col(f"`{key}`").alias("id"), F.unhex(F.md5(body)).alias("node"), body.alias("text"))
        id_type = self.docs.schema["id"].dataType.simpleString()
        self.rows = computed(self.docs.mapInArrow(_sketched, f"id {id_type}, node binary, n_words long, sketches array<long>"))
        self.tasks = 1 + self.rows.count() // TASK_ROWS
        one = F.min(F.struct(F.isnull("id").alias("no"), "id")).alias("one")
        first = [F.first(c).alias(c) for c in ("n_words", "sketches")]
        nodes = self._few(self.rows).groupBy("node").agg(*first, one, F.min("id").alias("id"), F.count("*").alias("n"))
        self.nodes = computed(self._few(nodes).withColumn("nid", F.monotonically_increasing_id()))

    def _few(self, df: DataFrame) -> DataFrame:
        """A narrow table in as many partitions as the number of texts asks for."""
        return df.coalesce(self.tasks)

    def _candidates(self) -> DataFrame:
        """(bucket, nid, n_words): the sketches that a text shares with others, and a few more."""
        nodes = self.nodes.where("n_words > 0").select("nid", "n_words", "sketches")
        shared = nodes.select(F.explode("sketches").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        bits = slot_bits(shared.select(F.pmod("bucket", F.lit(1 << FILTER_BITS)).alias("slot")))
        sent = self.spark.sparkContext.broadcast(bits)
        own = nodes.mapInArrow(_shared_only(sent), "nid long, n_words long, own array<long>")
        found = computed(self._few(own.select(F.explode("own").alias("bucket"), "nid", "n_words")))
        sent.unpersist()  # every executor has a copy of it on disk
        return found

    def _texts(self, nids: DataFrame) -> DataFrame:
        """(nid, text) of some texts, each from one row, written."""
        wanted = self.nodes.select(F.col("node").alias("_node"), F.col("one.id").alias("_id"), "nid").where(id_filter(nids, ["nid"]))
        chosen = computed(self._few(wanted))
        same = (F.col("node") == F.col("_node")) & F.col("id").eqNullSafe(F.col("_id"))
        maybe = self.docs.where(id_filter(chosen.select(F.col("_node").alias("node")), ["node"]))
        self.folder = f"{shared_folder(self.spark)}/near-{uuid.uuid4().hex}"
        found = joined_small(maybe, chosen, same, "inner").select("nid", "text")
        if not self.rows.groupBy("id", "node").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            found = found.dropDuplicates(["nid"])  # rows that share id and text
        found.write.parquet(self.folder, compression="zstd")
        return self.spark.read.parquet(self.folder)

    def _aligned(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        # Only texts that a pair may name are moved.
        left, right = (
            texts.where(id_filter(pairs.select(F.col(side).alias("nid")), ["nid"])).withColumnsRenamed({"nid": side, "text": f"text_{side}"}) for side in "ab"
        )
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
        return computed(both.mapInArrow(_linked, "a long, b long"))

    def _first_star(self, each: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(pairs, met): a pair for each text, as ``_star`` gives it, and all texts that meet another one of near length in a bucket.

        Any two lengths near enough for a link are in one of two wide bands together; a band's centre is its shortest text.
        """
        members = self._few(each).withColumn("band", F.explode(F.array(F.floor(_step() / 2), -1 - F.floor((_step() + 1) / 2))))
        low = members.groupBy("bucket", "band").agg(F.min(F.struct("n_words", "nid")).alias("low"), F.count("*").alias("n")).where("n > 1")
        star = members.join(low, ["bucket", "band"])
        near = _close("n_words", "low.n_words") & (F.col("nid") != F.col("low.nid"))
        votes = computed(self._few(star.groupBy("nid", F.col("low.nid").alias("centre")).agg(F.count_if(near).alias("votes"))))
        return self._best(votes.where("votes > 0")), computed(self._few(votes.select("nid").distinct()))

    def _best(self, votes: DataFrame) -> DataFrame:
        best = self._few(self._few(votes).groupBy("nid").agg(F.max(F.struct("votes", "centre")).alias("best")))
        pairs = best.select(F.least("best.centre", "nid").alias("a"), F.greatest("best.centre", "nid").alias("b"))
        return computed(self._few(pairs.distinct()))

    def _star(self, placed: DataFrame, order: Column) -> DataFrame:
        """A pair for each text outside the largest component of a bucket: with the first text of that component in a band of
        near lengths, of all such centres that which it meets in most of its buckets and bands.

        In a narrow band any two lengths are near enough; texts that meet in none are left to the comparison of groups.
        """
        # Both kinds of bands are two half steps long, so centres are found from the first texts of each half step.
        half = F.floor(2 * _step())
        first = F.min(F.struct(order.alias("order"), "nid", "n_words")).alias("low")
        cells = self._few(self._few(placed).groupBy("bucket", "label", half.alias("half")).agg(F.count("*").alias("n"), first))
        main = cells.groupBy("bucket", "label").agg(F.sum("n").alias("n")).groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("main"), F.count("*").alias("parts"))
        main = main.where("parts > 1 AND main.n > 1").select("bucket", F.col("main.label").alias("main"))
        kinds = F.array(F.floor(F.col("half") / 2), -1 - F.floor((F.col("half") + 1) / 2))
        low = cells.join(main, "bucket").where("label = main").select("bucket", "main", "low", F.explode(kinds).alias("band"))
        low = low.groupBy("bucket", "main", "band").agg(F.min("low").alias("low"))
        # A bucket has a centre for each of its bands at most, of which there are two for each step in length.
        low = self._few(low.groupBy("bucket", "main").agg(F.map_from_entries(F.collect_list(F.struct("band", "low"))).alias("lows")))
        star = placed.join(low, "bucket").where("label <> main").withColumn("half", half)
        centres = F.filter(F.transform(kinds, lambda band: F.try_element_at("lows", band)), lambda c: c.isNotNull() & _close("n_words", c["n_words"]))
        met = star.select("nid", F.explode(F.transform(centres, lambda c: c["nid"])).alias("centre"))
        return self._best(met.groupBy("nid", "centre").agg(F.count("*").alias("votes")))

    def _placed(self, members: DataFrame, links: DataFrame) -> DataFrame:
        return computed(self._few(members.join(components(links).withColumnRenamed("node", "nid"), "nid", "left").withColumn("label", F.coalesce("label", "nid"))))

    def _by_words(self, nodes: DataFrame, texts: DataFrame) -> DataFrame:
        """Groups (key, token, nid, n_words, label, left, right) of ``nodes`` (nid, n_words, label) that share a word that begins them."""
        own = texts.where(id_filter(nodes, ["nid"]))
        often = np.zeros(COUNTED, np.uint8)
        # A byte for each count, of fixed number.
        for row in own.mapInArrow(_word_counts, "at long, counts binary").groupBy("at").applyInArrow(_summed, "at long, counts binary").collect():
            often[row["at"] : row["at"] + COUNT_ROWS] = np.frombuffer(row["counts"], np.uint8)
        sent = self.spark.sparkContext.broadcast(often)
        words = computed(own.join(nodes, "nid").mapInArrow(_beginnings(sent), "word long, nid long, n_words long, label long"))
        sent.unpersist()
        met = words.groupBy("word").agg(F.min("label").alias("one"), F.max("label").alias("other"), F.count("*").alias("n"), *_ends())
        met = met.where(_may_link()).select("word", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
        block = F.pmod(F.xxhash64("nid"), F.col("blocks")).cast("int")
        each_pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, block).alias("i"), F.greatest(k, block).alias("j")))
        blocks = words.join(met, "word").select("word", "nid", "n_words", "label", block.alias("block"), F.explode(each_pair).alias("pair"))
        sides = [(F.col("block") == F.col("pair.i")).alias("left"), (F.col("block") == F.col("pair.j")).alias("right")]
        return blocks.select(F.xxhash64("word", "pair.i", "pair.j").alias("key"), F.col("word").alias("token"), "nid", "n_words", "label", *sides)

    def _groups(self, placed: DataFrame, texts: DataFrame) -> DataFrame | None:
        """Groups (key, token, nid, n_words, label, left, right) whose texts are to be compared; None if no link can be open.

        A pair of texts that have a token in common is compared in one of that token's groups.
        """
        same = [F.sum(F.xxhash64("nid").cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64("nid", F.lit(1))).alias("xor")]
        several = placed.groupBy("bucket").agg(F.min("label").alias("one"), F.max("label").alias("other"), F.count("*").alias("n"), *_ends(), *same).where(_may_link())
        # Buckets with the same texts are one group.
        several = computed(self._few(several.groupBy("n", "sum", "xor").agg(F.min("bucket").alias("bucket")).select("bucket", "n")))
        if several.isEmpty():
            return None
        members = computed(self._few(placed.join(several, "bucket").select("bucket", "nid", "n_words", "label", "n")))
        both = [F.lit(True).alias("left"), F.lit(True).alias("right")]
        groups = members.where(F.col("n") <= BLOCK).select(F.col("bucket").alias("key"), F.col("bucket").alias("token"), "nid", "n_words", "label", *both)
        large = computed(self._few(members.where(F.col("n") > BLOCK).select("nid", "n_words", "label").distinct()))
        return groups if large.isEmpty() else groups.union(self._by_words(large, texts))

    def links(self) -> DataFrame:
        """Verified links (a, b) between texts, enough to join all that candidates link."""
        each = self._candidates()
        tried, met = self._first_star(each)
        each = computed(self._few(each.where(id_filter(met, ["nid"]))))
        texts = self._texts(met)
        links = self._aligned(tried, texts)
        placed = self._placed(each, links)
        for n in range(STAR_ROUNDS):
            again = computed(self._few(self._star(placed, F.xxhash64("nid", F.lit(n))).join(self._few(tried), ["a", "b"], "left_anti")))
            found = self._aligned(again, texts)
            if found.isEmpty():
                break
            tried, links = tried.union(again), links.union(found)
            placed = self._placed(each, links)
        groups = self._groups(placed, texts)
        if groups is not None:
            groups = computed(groups)
            about = texts.where(id_filter(groups, ["nid"])).mapInArrow(_binned, "nid long, bins binary")
            about = about.join(groups.groupBy("nid").agg(F.collect_set("token").alias("tokens")), "nid")
            compared = groups.join(about, "nid").groupBy("key").applyInArrow(_open_pairs, "a long, b long")
            more = computed(self._few(self._few(compared.distinct()).join(self._few(tried), ["a", "b"], "left_anti")))
            links = links.union(self._aligned(more, texts))
        remove(self.spark, self.folder)
        return links

    def classes(self) -> DataFrame:
        """id, node, class_id, class_size and ``first`` (the row of the class to keep) of every row."""
        label = components(self.links()).withColumnRenamed("node", "nid")
        nodes = self._few(self.nodes).select("nid", "node", "id", "n")
        named = computed(self._few(nodes.join(label, "nid", "left").withColumn("label", F.coalesce("label", "nid"))))
        whole = named.groupBy("label").agg(
            F.min("id").alias("class_id"), F.sum("n").alias("class_size"), F.min(F.struct(F.isnull("id").alias("no"), "id", "node")).alias("first")
        )
        of_node = named.select("node", "label").join(self._few(whole), "label").select("node", "class_id", "class_size", "first")
        rows = self._few(self.rows).select("id", "node").join(self._few(of_node), "node")
        first = (F.col("node") == F.col("first.node")) & F.col("id").eqNullSafe(F.col("first.id"))
        return rows.select("id", "node", "class_id", "class_size", first.alias("first"))


def without_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, unchanged: that with the smallest id (rows without id come last).

    Rows that share id and text stay once.
    """
    classes = computed(NearCopies(docs, key, text).classes())
    rows = classes.groupBy("id", "node").agg(F.first("first").alias("first"), F.count("*").alias("n"))
    gone = computed(rows.where(~F.col("first")).select(F.col("id").alias("__near_id"), F.col("node").alias("__near_node")))
    again = computed(rows.where(F.col("first") & (F.col("n") > 1)).select(F.col("id").alias("__near_id"), F.col("node").alias("__near_node")))
    node = F.unhex(F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")))
    same = F.col(f"`{key}`").eqNullSafe(F.col("__near_id")) & (node == F.col("__near_node"))
    kept = joined_small(docs, gone, same, "left_anti")
    if again.isEmpty():
        return kept
    once = joined_small(kept, again, same, "left_semi").dropDuplicates([key, text])
    return joined_small(kept, again, same, "left_anti").unionByName(once)
