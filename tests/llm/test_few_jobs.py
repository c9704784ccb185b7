"""Helpers that stay cheap where a cluster has many shuffle partitions, and what workers remember."""

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from riskloom.llm import common, near_copies, token_count, token_files
from riskloom.llm.common import FILTER_BITS, in_bits, slot_bits
from riskloom.llm.components import components


def _jobs(spark, what, name):
    """The result of ``what`` and how many jobs it took where nothing puts small partitions together."""
    changed = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    spark.sparkContext.setJobGroup(name, name)
    try:
        return what(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)


def test_filter_takes_few_jobs(spark):
    slots = [7 * i % (1 << FILTER_BITS) for i in range(0, 30_000_000, 99_991)]
    bits, jobs = _jobs(spark, lambda: slot_bits(spark.createDataFrame([(x,) for x in slots], "slot long").repartition(8)), "filter-bits")
    assert jobs < 10
    assert in_bits(bits, np.array(slots)).all() and np.bitwise_count(bits).sum() == len(set(slots))


def test_small_graph_takes_few_jobs(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(500)] + [(1000, 1001), (3, 3)], "a long, b long").repartition(8)
    got, jobs = _jobs(spark, lambda: dict(map(tuple, components(links).collect())), "small-graph")
    assert got == {i: 0 for i in range(501)} | {1000: 1000, 1001: 1000}
    assert jobs < 15


def test_graph_of_several_tasks(spark, monkeypatch):
    monkeypatch.setattr("riskloom.llm.components.TASK_LINKS", 20)
    links = spark.createDataFrame([(i, i + 1) for i in range(100)], "a long, b long").repartition(8)
    assert dict(map(tuple, components(links).collect())) == {i: 0 for i in range(101)}


def test_frequent_pieces_stay(monkeypatch):
    monkeypatch.setattr(token_count, "PIECE_BOUND", 8)
    pieces = token_count.Pieces(token_count.Counter({(b"a", b"b"): 0}))
    assert [pieces["ab" * i] for i in range(1, 30)] == list(range(1, 30))
    assert "ab" in pieces and len(pieces) <= 9


def test_stops_and_known_pieces():
    old, r = re.compile(rb"(?<=[a-z0-9])([.,]+)(?=[ \t\n\r\x0b\x0c]|$)"), random.Random(5)
    for _ in range(3000):
        text = bytes(r.choices(b"ab9.,. \n-\xc3", k=r.randint(0, 12)))
        assert token_files._STOP.sub(rb" \g<0>", text) == old.sub(rb" \1", text)
    asked = []
    known = token_files._Known(lambda x: asked.append(x) or x.encode())
    long = b"x" * (token_files.LONGEST + 1)
    assert [known[x] for x in (b"a", long, b"a", long)] == [b"a", long, b"a", long]
    assert asked == ["a", long.decode(), long.decode()] and set(known) == {b"a"}


def test_filter_of_few_ids_is_small(spark):
    slots = [7 * i % (1 << FILTER_BITS) for i in range(0, 30_000_000, 99_991)]
    bits = common.folded(slot_bits(spark.createDataFrame([(x,) for x in slots], "slot long")))
    assert in_bits(bits, np.array(slots)).all() and len(bits) < 8 * len(set(slots)) * common.BITS_EACH // 4
    others = np.random.default_rng(1).integers(0, 1 << FILTER_BITS, 100_000)
    assert in_bits(bits, others).mean() < 2 / common.BITS_EACH
    wanted = spark.range(0, 3000, 3)
    kept = {x.id for x in spark.range(-3000, 6000).where(common.id_filter(wanted, ["id"])).collect()}
    assert kept >= set(range(0, 3000, 3)) and len(kept) < 1500


def test_star_takes_centres_of_near_length(spark):
    """Texts outside a bucket's largest component are paired with its texts of near length; its own texts make no rows."""
    rows = [(1, 10, 100, 10), (1, 11, 101, 10), (1, 12, 300, 10), (1, 20, 102, 20), (1, 21, 299, 21), (1, 22, 1000, 22), (2, 10, 100, 10), (2, 20, 102, 20)]
    placed = spark.createDataFrame(rows, "bucket long, nid long, n_words long, label long")
    own = near_copies.NearCopies(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    got = {(x.a, x.b) for x in own._star(placed, F.col("nid")).collect()}
    assert got == {(10, 20), (12, 21)}


def test_a_pair_of_several_groups_is_written_once():
    """Texts that share two sketches and a word meet in three groups."""
    bins = [np.bincount(np.arange(32) % m, minlength=32).astype(np.uint8).tobytes() for m in (32, 31, 30)]
    tokens = [[5, 7, -2], [7, 5, -2], [7, 9]]

    def group(key, of):
        columns = {"key": [key] * len(of), "token": [key] * len(of), "nid": of, "n_words": [32] * len(of), "label": of, "left": [True] * len(of), "right": [True] * len(of)}
        return near_copies._open_pairs(pa.table(columns | {"bins": [bins[i] for i in of], "tokens": [tokens[i] for i in of]}))

    found = [x for key, of in ((5, [0, 1]), (7, [2, 1, 0]), (-2, [0, 1])) for x in zip(*group(key, of).to_pydict().values())]
    assert sorted(found) == [(0, 1), (0, 2), (1, 2)]


def test_two_texts_of_far_lengths_are_no_group(spark):
    """A group of two texts that differ too much in length for a link is not written."""
    own = near_copies.NearCopies(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    rows = [(1, 10, 100, 10), (1, 11, 126, 11), (2, 20, 100, 20), (2, 21, 125, 21), (3, 30, 50, 30), (3, 31, 100, 31), (3, 32, 101, 32)]
    placed = spark.createDataFrame(rows, "bucket long, nid long, n_words long, label long")
    assert {x.nid for x in own._groups(placed, None).collect()} == {20, 21, 30, 31, 32}
    assert own._groups(placed.where("bucket = 1"), None) is None
