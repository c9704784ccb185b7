"""Token ids of documents in binary files, with a minimal perfect hash index from keys to places.

``write`` makes a folder of

* shards ``shard-<n>.ids``: the raw ids of consecutive documents in ascending order of their keys, little-endian and 2 or 4
  bytes each (by the size of the vocabulary), then the place of each document's first id (64 bits each), then a footer;
* buckets ``bucket-<n>.idx``: each holds a minimal perfect hash function of some ``BUCKET_KEYS`` keys (by the checksum of
  the key), and for each of its slots a 64-bit fingerprint of the key, the shard and the number of its first document
  there, and how many documents have that key.

The function is a cascade of bit arrays: a key sets a bit in the first array in which it meets no other key, and its slot is
the number of bits set before that one.  An access reads one bit in a few arrays, a slot, and the ids themselves, whatever
the number of documents.  Keys that are not in the files are told by the fingerprint (a false one passes with
probability 2 ** -64).

Shards are cut at keys found in a bounded sample, which shifts work between tasks but no row; rows that share a key are
spread by their text and a random number.  Files are written under a name of their own and moved when whole, so a task
that runs twice leaves the same file.  ``pyarrow`` opens the folder, which may be local, or in any store it knows.

* A null text is the empty one: only the end id.  A null key is a key, and comes first.  Rows that share a key
  are kept one after another, in an order that the texts decide.
* An empty table has no shards.
* A task holds one shard's rows in Spark's sort, and of its file what is not yet written; texts are encoded one by one.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import BATCH_ROWS, mixed
from riskloom.session import computed, shared_folder, tune

#: Bytes of text for a shard; and the most shards, which then grow instead.
SHARD_BYTES, MOST_SHARDS = 32 << 20, 10_000
#: Rows sampled for each cut between shards, and at most.
SAMPLE_ROWS, MOST_SAMPLED = 100, 100_000
BUCKET_KEYS = 100_000
#: Pieces of text whose ids a worker remembers, and the longest one.
REMEMBERED, LONGEST = 1_000_000, 64
_CODES = {"<u2": "H", "<u4": "I"}  # of the machine's byte order, which is the files'
#: Full stops and commas that end a word.
_STOP = re.compile(rb"[.,](?<=[a-z0-9][.,])[.,]*(?=[ \t\n\r\x0b\x0c]|$)")
_FOOTER, _MAGIC = "<8sIIQQ", b"tokids01"
_LEVELS, _LEAST_BITS = 48, 64


# ---------------------------------------------------------------- encoding


class _Known(dict):
    """Ids of pieces met before; a long piece is not kept."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.encode(piece.decode())
        if len(piece) <= LONGEST:
            self[piece] = ids
        return ids


class Encoder:
    """The ids of a text, as the library gives them, and an end id.

    Vocabularies that drop white space and case (``splits`` tells) have no token and no rule across white space, nor across
    the end of a word before a full stop or comma.  The ids of a text are then those of such pieces in lower case, which
    are remembered.  Texts for other vocabularies are encoded whole.  Special strings in a text are found as it stands.
    """

    def __init__(self, path: str, end: int | None = None):
        with open(path, encoding="utf-8") as f:
            self.source = f.read()
        self._load()
        size = max(self.tokenizer.get_vocab_size(), (end or 0) + 1)
        self.kind = "<u2" if size <= 1 << 16 else "<u4"
        self.end = b"" if end is None else np.array([end], self.kind).tobytes()
        self.added = [x.content.lower().encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.splits = self._drops_space()

    def _load(self):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(self.source)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.known = _Known(self._whole)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("tokenizer", "known")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._load()

    def _whole(self, text: str) -> bytes:
        return array(_CODES[self.kind], self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _drops_space(self) -> bool:
        white = all(self._whole(f"a{x}b{x}") == self._whole("a") + self._whole("b") for x in " \t\n\r\x0b\x0c") and not self._whole(" \n")
        stops = all(self._whole(f"{x}.,") == self._whole(x) + self._whole(".,") for x in ("a", "9"))
        return white and stops and self._whole("ABC") == self._whole("abc")

    def _pieces(self, text: bytes) -> list[bytes]:
        low = text.lower()  # ASCII letters only
        if any(x in low for x in self.added):
            return text.split()
        return _STOP.sub(rb" \g<0>", low).split()

    def __call__(self, text: bytes) -> bytes:
        if not self.splits:
            return self._whole(text.decode()) + self.end
        pieces = self._pieces(text)
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, pieces)) + self.end


# ---------------------------------------------------------------- minimal perfect hash


def _lanes(hashes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(hashes), "<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _spot(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mixed(a ^ mixed(b + np.uint64(level))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Slots 0 .. n - 1 of n keys, given as two 64-bit lanes of a digest."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        left, sizes, words = np.arange(len(a)), [], []
        for level in range(_LEVELS):
            if not len(left):
                break
            size = max(_LEAST_BITS, -(-len(left) // 64) * 64)
            spot = _spot(a[left], b[left], level, size)
            count = np.bincount(spot, minlength=size)
            words.append(np.packbits(count == 1, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[count[spot] > 1]
        if len(left):
            raise ValueError("keys with equal digests")
        return cls(sizes, np.concatenate(words) if words else np.zeros(0, "<u8"))

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of each key; of keys that were not there when it was built, any slot or -1."""
        out, left, first = np.full(len(a), -1, np.int64), np.arange(len(a)), 0
        for level, size in enumerate(self.sizes):
            spot = _spot(a[left], b[left], level, size)
            word, bit = first + (spot >> 6), (spot & 63).astype(np.uint64)
            held = self.words[word]
            here = held >> bit & np.uint64(1) == 1
            under = np.bitwise_count(held & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[here]] = self.before[word[here]] + under[here]
            left = left[~here]
            first += size >> 6
        return out

    def dump(self) -> bytes:
        return struct.pack(f"<I{len(self.sizes)}Q", len(self.sizes), *self.sizes) + self.words.astype("<u8").tobytes()

    @classmethod
    def load(cls, raw: bytes) -> tuple[PerfectHash, int]:
        n = struct.unpack_from("<I", raw)[0]
        sizes = list(struct.unpack_from(f"<{n}Q", raw, 4))
        begin, words = 4 + 8 * n, sum(sizes) >> 6
        return cls(sizes, np.frombuffer(raw, "<u8", words, begin)), begin + 8 * words


_SLOT = np.dtype([("mark", "<u8"), ("shard", "<u4"), ("first", "<u8"), ("docs", "<u8")])


def _mark(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a * np.uint64(3) + b)


def _bucket_file(a: np.ndarray, b: np.ndarray, shard, first, docs) -> bytes:
    index = PerfectHash.build(a, b)
    slots = np.zeros(len(a), _SLOT)
    slots[index.slots(a, b)] = np.rec.fromarrays([_mark(a, b), shard, first, docs], dtype=_SLOT)
    return index.dump() + slots.tobytes()


def _found(raw: bytes, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of the keys are there, their slots' contents)."""
    index, begin = PerfectHash.load(raw)
    slots = np.frombuffer(raw, _SLOT, offset=begin)
    at = index.slots(a, b)
    there = (at >= 0) & (slots["mark"][at] == _mark(a, b)) if len(slots) else np.zeros(len(a), bool)
    return there, slots[at[there]]


# ---------------------------------------------------------------- files


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _moved(folder: str, name: str, pieces) -> None:
    """Write a file under a name of its own, then give it its name."""
    store, root = _opened(folder)
    own = f"{root}/_{uuid.uuid4().hex}"
    with store.open_output_stream(own) as f:
        for x in pieces:
            f.write(x)
    store.move(own, f"{root}/{name}")


def shard_name(n: int) -> str:
    return f"shard-{n:06d}.ids"


def bucket_name(n: int) -> str:
    return f"bucket-{n:07d}.idx"


def _written(folder: str, kind: str):
    """Write the shards of a task's sorted rows; a row (hash, shard, first, docs, ids) for each run of one key."""

    def run(batches: Iterator[pa.RecordBatch]):
        width = np.dtype(kind).itemsize
        out: list[tuple] = []
        rows = ((s.as_py(), h.as_py(), p.as_py()) for x in batches for s, h, p in zip(x.column("shard"), x.column("hash"), x.column("payload")))
        row = next(rows, None)
        while row is not None:
            shard, starts = row[0], []

            def payloads():
                nonlocal row
                total = 0
                while row is not None and row[0] == shard:
                    if out and out[-1][:2] == (row[1], shard):
                        out[-1] = (*out[-1][:3], out[-1][3] + 1, out[-1][4] + len(row[2]) // width)
                    else:
                        out.append((row[1], shard, len(starts), 1, len(row[2]) // width))
                    starts.append(total)
                    total += len(row[2]) // width
                    yield row[2]
                    row = next(rows, None)
                yield np.array([*starts, total], "<u8").tobytes()
                yield struct.pack(_FOOTER, _MAGIC, width, shard, len(starts), total)

            _moved(folder, shard_name(shard), payloads())
            columns = list(zip(*out))
            types = [pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["hash", "shard", "first", "docs", "ids"])
            out = []

    return run


def _hash(key: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.concat(F.lit("="), F.col(f"`{key}`").cast("string")), F.lit("")).cast("binary")))


class TokenFiles:
    """A written folder: ``starts`` and ``docs`` are the ids and documents before each shard (one more at the end)."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int, kind: str, shards: list[tuple[int, int, int]]):
        self.spark, self.folder, self.buckets, self.kind = spark, folder, buckets, kind
        self.shards = [n for n, _, _ in shards]
        self.docs = np.cumsum([0, *(d for _, d, _ in shards)])
        self.starts = np.cumsum([0, *(i for _, _, i in shards)])

    # ------------------------------------------------ writing

    @classmethod
    def write(cls, docs: DataFrame, encoder: Encoder, key: str = "doc_id", text: str = "text", folder: str | None = None, shard_bytes: int = SHARD_BYTES) -> TokenFiles:
        spark = tune(docs.sparkSession)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        folder = folder or f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
        store, root = _opened(folder)
        store.create_dir(root, recursive=True)
        body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
        rows = docs.select(F.col(f"`{key}`").alias("key"), _hash(key).alias("hash"), body.alias("text"))
        rows = rows.select("key", "hash", F.xxhash64("text").alias("order"), F.rand(0).alias("spread"), "text")
        cuts = cls._cuts(rows.select("key", "order", "spread", F.octet_length("text").alias("size")), shard_bytes)
        shared = spark.sparkContext.broadcast(encoder)

        def encoded(batches: Iterator[pa.RecordBatch]):
            ids = shared.value
            for batch in batches:
                places = zip(*(batch.column(c).to_pylist() for c in ("key", "order", "spread")))
                shard = [bisect_right(cuts, (k is not None, k, o, s)) for k, o, s in places]
                payload = pa.array([ids(x.as_py()) for x in batch.column("text")], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), *batch.columns[:4], payload], names=["shard", "key", "hash", "order", "spread", "payload"])

        key_type = docs.schema[key].dataType.simpleString()
        schema = f"shard int, key {key_type}, hash binary, `order` long, spread double, payload binary"
        placed = rows.mapInArrow(encoded, schema).repartitionById(len(cuts) + 1, F.col("shard"))
        placed = placed.sortWithinPartitions("shard", F.asc_nulls_first("key"), "order", "spread").select("shard", "hash", "payload")
        runs = computed(placed.mapInArrow(_written(folder, encoder.kind), "hash binary, shard int, first long, docs long, ids long"))
        # One row for each shard, of which there are MOST_SHARDS at most.
        shards = sorted(tuple(x) for x in runs.groupBy("shard").agg(F.sum("docs"), F.sum("ids")).collect())
        # A key whose rows fill several shards has a run in each; it begins in the first of them.
        places = runs.groupBy("hash").agg(F.min(F.struct("shard", "first")).alias("at"), F.sum("docs").alias("docs"))
        buckets = 1 + runs.count() // BUCKET_KEYS
        files = cls(spark, folder, buckets, encoder.kind, shards)
        places = places.select("hash", "at.shard", "at.first", "docs", files._bucket("hash").alias("bucket"))

        def index(group: pa.Table) -> pa.Table:
            a, b = _lanes(group.column("hash").to_pylist())
            _moved(folder, bucket_name(group.column("bucket")[0].as_py()), [_bucket_file(a, b, *(group.column(c).to_numpy() for c in ("shard", "first", "docs")))])
            return pa.table({"bucket": group.column("bucket").slice(0, 1), "keys": [group.num_rows]})

        computed(places.groupBy("bucket").applyInArrow(index, "bucket int, keys long"))
        return files

    @staticmethod
    def _cuts(rows: DataFrame, shard_bytes: int) -> list[tuple]:
        """First rows of all shards but the first, so that shards have about as many bytes."""
        total = rows.agg(F.count("*").alias("n"), F.sum(F.col("size") + 64).alias("bytes")).first()
        shards = min(MOST_SHARDS, 1 + (total["bytes"] or 0) // shard_bytes)
        if shards == 1:
            return []
        share = min(1.0, SAMPLE_ROWS * shards / total["n"], MOST_SAMPLED / total["n"])
        sample = sorted((x["key"] is not None, x["key"], x["order"], x["spread"], x["size"] + 64) for x in rows.sample(share, seed=1).limit(2 * MOST_SAMPLED).collect())
        sums = np.cumsum([x[-1] for x in sample])
        at = np.searchsorted(sums, sums[-1] * np.arange(1, shards) / shards) if sample else []
        return [sample[i][:4] for i in sorted({int(i) for i in at})]

    # ------------------------------------------------ reading

    def _bucket(self, hash_: str) -> Column:
        return F.pmod(F.crc32(hash_), F.lit(self.buckets)).cast("int")

    def places(self, keys: DataFrame, key: str = "doc_id") -> DataFrame:
        """(key, shard, first, docs): where the documents of each asked key begin; keys not in the files have no row."""
        folder = self.folder
        asked = keys.select(F.col(f"`{key}`").alias("key"), _hash(key).alias("hash")).distinct().withColumn("bucket", self._bucket("hash"))

        def find(group: pa.Table) -> pa.Table:
            store, root = _opened(folder)
            name = f"{root}/{bucket_name(group.column('bucket')[0].as_py())}"
            if store.get_file_info(name).type == fs.FileType.NotFound:
                there, slots = np.zeros(group.num_rows, bool), np.zeros(0, _SLOT)
            else:
                with store.open_input_file(name) as f:
                    there, slots = _found(f.read(), *_lanes(group.column("hash").to_pylist()))
            columns = {"key": group.column("key").filter(pa.array(there))}
            return pa.table(columns | {c: pa.array(slots[c].astype(np.int64)) for c in ("shard", "first", "docs")})

        key_type = asked.schema["key"].dataType.simpleString()
        return asked.groupBy("bucket").applyInArrow(find, f"key {key_type}, shard long, first long, docs long")

    def read(self, keys: DataFrame, key: str = "doc_id") -> DataFrame:
        """(key, start, ids) of every document of the asked keys, from the files.

        ``start`` counts the ids of all documents before it; ``ids`` has 4 bytes for each id, little-endian.
        """
        folder, kind, shards, docs, starts = self.folder, self.kind, np.array(self.shards, np.int64), self.docs, self.starts

        def over_shards(batches: Iterator[pa.RecordBatch]):
            """A key's documents may go on in the next shards, from their first on."""
            for batch in batches:
                at, first, n = (batch.column(c).to_numpy() for c in ("shard", "first", "docs"))
                nth = np.searchsorted(shards, at)
                begin = docs[nth] + first
                last = np.searchsorted(docs, begin + n, "left") - 1
                parts = last - nth + 1
                row = np.repeat(np.arange(len(n)), parts)
                own = nth[row] + np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                low, high = np.maximum(begin[row], docs[own]), np.minimum(begin[row] + n[row], docs[own + 1])
                columns = [batch.column("key").take(pa.array(row)), *(pa.array(x) for x in (own, low - docs[own], high - docs[own]))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "nth", "low", "high"])

        def ids(group: pa.Table) -> pa.Table:
            nth = group.column("nth")[0].as_py()
            store, root = _opened(folder)
            width = np.dtype(kind).itemsize
            with store.open_input_file(f"{root}/{shard_name(int(shards[nth]))}") as f:
                f.seek(f.size() - struct.calcsize(_FOOTER))
                magic, own_width, _, n, total = struct.unpack(_FOOTER, f.read(struct.calcsize(_FOOTER)))
                if magic != _MAGIC or own_width != width:
                    raise ValueError("not a shard of this folder")
                f.seek(total * width)
                first = np.frombuffer(f.read(8 * (n + 1)), "<u8").astype(np.int64)
                row, start, found = [], [], []
                for i, (low, high) in enumerate(zip(group.column("low").to_pylist(), group.column("high").to_pylist())):
                    f.seek(int(first[low]) * width)
                    raw = np.frombuffer(f.read(int(first[high] - first[low]) * width), kind).astype("<u4")
                    for j in range(low, high):
                        row.append(i)
                        start.append(int(starts[nth] + first[j]))
                        found.append(raw[first[j] - first[low] : first[j + 1] - first[low]].tobytes())
            return pa.table({"key": group.column("key").take(pa.array(row, pa.int64())), "start": pa.array(start, pa.int64()), "ids": pa.array(found, pa.binary())})

        key_type = keys.schema[key].dataType.simpleString()
        parts = self.places(keys, key).mapInArrow(over_shards, f"key {key_type}, nth long, low long, high long")
        return parts.groupBy("nth").applyInArrow(ids, f"key {key_type}, start long, ids binary")

    def get(self, key) -> list[np.ndarray]:
        """The ids of the documents of one key, by three reads for each shard it stands in; no Spark job."""
        import hashlib

        digest = hashlib.md5(b"" if key is None else f"={key}".encode()).digest()
        store, root = _opened(self.folder)
        name = f"{root}/{bucket_name(zlib.crc32(digest) % self.buckets)}"
        if store.get_file_info(name).type == fs.FileType.NotFound:
            return []
        with store.open_input_file(name) as f:
            there, slots = _found(f.read(), *_lanes([digest]))
        out, width = [], np.dtype(self.kind).itemsize
        if there[0]:
            at, low, left = self.shards.index(int(slots["shard"][0])), int(slots["first"][0]), int(slots["docs"][0])
            while left:
                high = min(low + left, int(self.docs[at + 1] - self.docs[at]))
                total = int(self.starts[at + 1] - self.starts[at])
                with store.open_input_file(f"{root}/{shard_name(self.shards[at])}") as f:
                    f.seek(total * width + 8 * low)
                    first = np.frombuffer(f.read(8 * (high - low + 1)), "<u8").astype(np.int64)
                    f.seek(int(first[0]) * width)
                    raw = np.frombuffer(f.read(int(first[-1] - first[0]) * width), self.kind).astype("<u4")
                out += np.split(raw, first[1:-1] - first[0])
                left, at, low = left - (high - low), at + 1, 0
        return out
