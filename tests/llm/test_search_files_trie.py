"""Ranked search, token files and the prefix trie against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskloom.llm import prefix_trie, ranked_search
from riskloom.llm.queries import QUERIES
from riskloom.llm.token_files import Encoder, PerfectHash, TokenFiles, _bucket_file, _found, _lanes

WORDS_49K = public_tokenizers.path("word_bpe_49k.json")

# ---------------------------------------------------------------- ranked search


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def ranking(docs, items, k):
    counts = [(i, Counter(split(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    total, length = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 100 - 50 + 50 * c.total() * total // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(split(text)) if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, n + 1, None if no else i, -s) for n, (s, no, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("postings, step", [(40, 1), (2_000_000, 2), (300, 16)])
def test_ranked_search(spark, monkeypatch, postings, step):
    r = random.Random(postings)
    names = [f"t{int(r.paretovariate(0.7)) % 60}" for _ in range(4000)]
    docs = [(None if i % 37 == 0 else i // 2, " ".join(r.choices(names, k=r.randint(0, 30))) if i % 11 else None) for i in range(400)]
    docs += [(1000 + i, "same text é-1 here") for i in range(40)]
    items = [(i % 9, " ".join(r.choices(names, k=r.randint(0, 8)))) for i in range(12)] + [(None, "Same HERE é"), (77, None), (78, "nowhere")]
    monkeypatch.setattr(ranked_search, "POSTINGS", postings)
    monkeypatch.setattr(ranked_search, "STEP", step)
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", 5)
    d, b = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    got = ranked_search.search(d, b, 7).collect()
    assert sorted([(x.item, x["rank"], x.key, x.score) for x in got], key=str) == ranking(docs, items, 7)
    ranks = defaultdict(list)
    for x in got:
        ranks[x.item_row].append(x["rank"])
    assert all(sorted(x) == list(range(1, len(x) + 1)) for x in ranks.values())


def test_best_positions_stop_early():
    """The lists of an item are not read to their ends, and direct accesses move the best positions on."""
    n = 50_000
    r = np.random.default_rng(3)
    owner = np.concatenate([r.permutation(n)[: n // 2] for _ in range(4)])
    term = np.repeat(np.arange(4), n // 2)
    impact = (r.pareto(1.0, len(owner)) * 100).astype(np.int64) + 1
    lists = ranked_search.ImpactLists(owner, term, impact, n)
    total = np.bincount(owner, impact, n).astype(np.int64)
    documents, scores = lists.best(np.arange(4), 10, 0)
    assert len(documents) < n // 20
    assert (total[documents] == scores).all()
    assert sorted(scores)[-10:] == sorted(total)[-10:]


# ---------------------------------------------------------------- token files

ODD = [
    "it's <|endoftext|> here", "a<|startoftext|>b.", "<|EndOfText|>. X", "İstanbul ΣΑΣ.", "é ́x", "x\xa0y z\x85w\x1cq", "don't. 1.2,3 U.S.A., a.,.b \".x\".",
    "Café,naïve. 日本12.", "ſ. K, Å.", " ", "", None, "'s 's. o's, 'll.", "a\x00b\x1fc", "word " * 3000, "x" * 300 + ". " + "Y" * 70,
]


def test_encoder_equals_the_library():
    own, library = Encoder(WORDS_49K, 1), Tokenizer.from_file(WORDS_49K)
    assert own.splits and own.kind == "<u2"
    for text in [x for x in ODD if x is not None]:
        assert np.frombuffer(own(text.encode()), "<u2").tolist() == [*library.encode(text, add_special_tokens=False).ids, 1], text
    bytes_ = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not bytes_.splits
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode("two  words. here", add_special_tokens=False).ids
    assert np.frombuffer(bytes_(b"two  words. here"), bytes_.kind).tolist() == whole


def test_perfect_hash():
    for n in (0, 1, 2, 1000, 30_000):
        a, b = _lanes([hashlib.md5(str(i).encode()).digest() for i in range(n)])
        index = PerfectHash.build(a, b)
        assert sorted(index.slots(a, b).tolist()) == list(range(n))
        raw = _bucket_file(a, b, np.arange(n), np.arange(n) * 3, np.ones(n, np.int64))
        there, slots = _found(raw, a, b)
        assert there.all() and (slots["shard"] == np.arange(n)).all() and (slots["first"] == np.arange(n) * 3).all()
        assert len(index.dump()) < 64 + 20 * 8 + n * 0.6, "about three bits a key"
        other = _lanes([hashlib.md5(f"no {i}".encode()).digest() for i in range(100)])
        assert not _found(raw, *other)[0].any(), "told by the fingerprint"


def test_token_files(spark, tmp_path):
    r = random.Random(4)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, " ".join(r.choices("alpha beta gamma delta,".split(), k=r.randint(0, 60)))) for i in range(300)]
    rows += [(500, "one key, many texts. " * (i % 7)) for i in range(400)] + [(None, "no key"), (None, None), (7, "again")]
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    files = TokenFiles.write(docs, Encoder(WORDS_49K, 1), folder=str(tmp_path / "ids"), shard_bytes=4000)
    assert len(files.shards) > 5
    library = Tokenizer.from_file(WORDS_49K)

    def ids(text):
        return [*library.encode(text or "", add_special_tokens=False).ids, 1]

    got = [(x.key, x.start, np.frombuffer(x.ids, "<u4").tolist()) for x in files.read(docs).collect()]
    got.sort(key=lambda x: x[1])
    assert [k is not None for k, _, _ in got] == sorted(k is not None for k, _, _ in got)
    assert [k for k, _, _ in got if k is not None] == sorted(k for k, _ in rows if k is not None)
    assert [s for _, s, _ in got] == np.cumsum([0, *(len(x) for _, _, x in got)]).tolist()[:-1]
    assert sorted((str(k), x) for k, _, x in got) == sorted((str(k), ids(t)) for k, t in rows)
    by_key = defaultdict(list)
    for k, _, x in got:
        by_key[k].append(x)
    for k in (None, 0, 500, 399, 7):
        assert [x.tolist() for x in files.get(k)] == by_key[k]
    assert files.get(12345) == []
    assert files.read(spark.createDataFrame([(12345,), (7,)], "doc_id long")).count() == 2


def test_op12_reads_what_it_wrote(spark):
    small = "/root/testdata/sf0.001"
    library, start = Tokenizer.from_file(WORDS_49K), 0
    got = {x.doc_id: x for x in QUERIES["op12_token_files"](spark, small).collect()}
    for x in sorted(spark.read.parquet(f"{small}/documents.parquet").collect(), key=lambda x: x.doc_id):
        own = np.array([*library.encode(x.text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (got[x.doc_id].start, got[x.doc_id].n_tokens, got[x.doc_id].ids_crc32) == (start, len(own), zlib.crc32(own.tobytes()))
        start += len(own)


# ---------------------------------------------------------------- prefix trie


def digest(role, text):
    return hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()


def all_nodes(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, digest(role, text), len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))))
    turns = {c: [x[2:] for x in sorted(xs)] for c, xs in own.items()}
    members, ends, words = defaultdict(list), defaultdict(list), {(): 0}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        path = turns.get(c - int(math.fmod(c, 20)), [])[:h] + turns[c][h:]
        for d in range(len(path) + 1):
            node = tuple(k for k, _ in path[:d])
            members[node].append(c)
            words[node] = path[d - 1][1] if d else 0
        ends[tuple(k for k, _ in path)].append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, ms in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += (len(ms) - 1) * words[n]
    return sorted(
        (min(ms), len(n), min(members[n[:-1]]) if n else -1, len(ms), children[n], leaves[n], saved[n], hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
        for n, ms in members.items()
    )


def listed(nodes):
    return sorted((x.conv_id, x.depth, -1 if x.parent_conv_id is None else x.parent_conv_id, x.n_convs, x.n_children, x.n_leaves, x.saved_tokens, x.ends_sha256) for x in nodes.collect())


def conversations(seed):
    r = random.Random(seed)
    rows = []
    for c in range(90):
        rows += [(c, t, r.choice(["user", "user", None]), r.choice(["hi there", "what is it", "", None, "x  y\nz"])) for t in range(r.randint(1, 9))]
    rows += [(c, t, "user", f"the same {t}") for c in range(100, 140) for t in range(6)]  # copies
    rows += [(200, t, "user", "long") for t in range(50)] + [(201, t, "user", "long") for t in range(70)] + [(223, t, "user", f"long {t}") for t in range(60)]
    rows += [(5, None, "user", "no number"), (5, 1, "user", "a tie"), (5, 1, "user", "a tie"), (None, 0, "user", "nobody's"), (300, 0, "a", "only"), (-7, 0, None, None), (-7, 1, "b", "c d")]
    return rows


@pytest.mark.parametrize("seed, band, shard_turns", [(1, 4096, 100_000), (2, 4096, 7), (3, 30, 20)])
def test_prefix_trie(spark, monkeypatch, seed, band, shard_turns):
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    rows = conversations(seed)
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    assert listed(prefix_trie.prefix_trie(given, band=band, shard_turns=shard_turns)) == all_nodes(rows)


def test_one_conversation_over_many_ranges(spark):
    """Half of all rows belong to one conversation, and most of these are equal."""
    rows = [(40, min(t, 60), "user", "again") for t in range(400)] + [(c, t, "user", f"{c % 3} {t}") for c in range(100) for t in range(4)]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns, convs = prefix_trie.numbered(given)
    nth = defaultdict(list)
    for x in turns.collect():
        nth[x.conv].append(x.nth)
    assert all(sorted(x) == list(range(len(x))) for x in nth.values())
    assert {x.conv: x.n for x in convs.collect()} == {c: len(x) for c, x in nth.items()}
    assert listed(prefix_trie.prefix_trie(given, shard_turns=50)) == all_nodes(rows)


def test_ternary_tree():
    r = random.Random(2)
    words = sorted({tuple(r.randint(0, 5) for _ in range(r.randint(1, 6))) for _ in range(500)})
    tree = prefix_trie.TernaryTree()
    ends = tree.insert_sorted([list(x) for x in words])
    path = {-1: ()}
    for node, up, depth in tree.walk():
        path[node] = (*path[up], tree.symbol[node])
        assert depth == len(path[up])
    assert [path[x] for x in ends] == words
    assert len(path) - 1 == len({x[:d] for x in words for d in range(1, len(x) + 1)})


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert listed(prefix_trie.prefix_trie(none)) == []
    nobody = spark.createDataFrame([(None, 1, "user", "x")], none.schema)
    assert listed(prefix_trie.prefix_trie(nobody)) == []
