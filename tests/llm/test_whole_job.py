"""Cases in which an operator once did less than its whole job."""

import math
import random
import re
import time

import duckdb
from pyspark.sql import functions as F

from checks.compare import differences
from riskloom.llm import decontaminate, mixing, near_copies, quality_model, rules, secret_scan, toxicity
from riskloom.llm.licenses import license_scan
from riskloom.llm.near_copies import NearCopies, linked
from riskloom.llm.queries import QUERIES, SQL
from riskloom.llm.substrings import Repeats


def changed(words, places, mark):
    places = set(places)
    return [f"{mark}{i}" if i in places else w for i, w in enumerate(words)]


def test_planted_near_copies(spark):
    """Copies of 300 words by the share changed (anywhere, and evenly spread), and of few words with any one changed."""
    r = random.Random(11)
    pairs = []
    for n in range(100):
        own = [f"t{n}_{k}" for k in range(300)]
        for rate in (5, 10, 15, 20):
            pairs.append((f"{rate}%", own, changed(own, r.sample(range(300), 3 * rate), "x")))
            own = [f"{w}_" for w in own]
        pairs.append(("every fifth", own, changed(own, range(2, 300, 5), "x")))
        own = [f"s{n}_{k}" for k in range(r.randint(26, 60))]
        pairs.append(("26 to 60 words, 20%", own, changed(own, r.sample(range(len(own)), len(own) // 5), "x")))
    for n in range(5, 25):
        for at in range(n):
            own = [f"u{n}_{at}_{k}" for k in range(n)]
            pairs.append(("one of few words", own, changed(own, [at], "x")))
            pairs.append(("few words, 20%", own := [f"{w}_" for w in own], changed(own, r.sample(range(n), n // 5), "x")))
    assert all(linked(a, b) for _, a, b in pairs)
    rows = [(2 * i + side, " ".join(w)) for i, (_, *both) in enumerate(pairs) for side, w in enumerate(both)]
    got = {x.id: x.class_id for x in NearCopies(spark.createDataFrame(rows, "doc_id long, text string")).classes().collect()}
    found = {}
    for i, (kind, _, _) in enumerate(pairs):
        found.setdefault(kind, []).append(got[2 * i] == got[2 * i + 1])
    share = {kind: sum(x) / len(x) for kind, x in found.items()}
    print(share)
    assert len(set(got.values())) >= len(pairs), "different texts stay apart"
    assert share["5%"] == share["10%"] == 1 and min(share["one of few words"], share["few words, 20%"]) >= 0.99
    assert min(share["15%"], share["20%"]) >= 0.97 and min(share["26 to 60 words, 20%"], share["every fifth"]) >= 0.95, share


NOTICES = {
    1: ("Licensed under CC BY-SA (CC BY-SA 4.0)", "cc-by,cc-by-sa", 1.0),
    2: ("released under the mit license, the mit license that all of us like", "mit", 1.0),
    3: ("cc by " * 30, "cc-by", 1.0),
    4: ("under the mit " * 30, "", 0.5),
    5: ("released under the new mit license, the mit license, the mit license", "mit", 0.75),
    6: ("the mit license, the mit license, released under the mit license", "mit", 1.0),
    7: ("cc by cc by cc by cc by", "cc-by", 1.0),
    8: ("under the mit the mit the mit", "", 0.5),
    9: ("version 2 " * 5, "", 1 / 7),
    10: ("licensed under cc by nc", "cc-by,cc-by-nc", 1.0),
    11: ("Licensed under the Apache License, Version 2.0. version 2 0", "apache-2.0", 1.0),
    12: ("licensed under the old license version 2 0", "", 5 / 7),
    13: (None, "", 0.0),
}


def test_notices(spark):
    """Pairs of a notice count once, and the telling one must be there."""
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in NOTICES.items()], "doc_id long, text string")
    got = {x.doc_id: (x.labels, round(x.score, 9)) for x in license_scan(docs, ["doc_id"]).collect()}
    assert got == {i: (labels, round(score, 9)) for i, (_, labels, score) in NOTICES.items()}


def test_sql_of_notices(spark, folder):
    r = random.Random(8)
    bits = ["cc by", "cc by sa", "the mit license", "licensed under", "released under", "the apache license version 2 0", "all rights reserved", "x", "gnu lesser general public license"]
    texts = [t for t, _, _ in NOTICES.values()] + [" ".join(r.choices(bits, k=r.randint(1, 9))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    at = folder(documents=docs)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{at}/documents.parquet/*.parquet')")
    assert differences(QUERIES["op9_license_scan"](spark, at).toArrow(), con.execute(SQL["op9_license_scan"]).to_arrow_table()) == []


def best_of(run, times=3):
    out = []
    for _ in range(times):
        begin = time.perf_counter()
        run()
        out.append(time.perf_counter() - begin)
    return min(out)


def test_secrets_of_a_long_text_take_linear_time():
    """Eight times the text, with eight times the secrets, takes some eight times as long, and each is found."""
    scan = secret_scan.scanner(secret_scan.RULES)
    r = random.Random(1)
    bits = ["0123456789abcdef" * 2, "password = hunter2hunter2", "AKIA" + "A1" * 8, "token token: secret=abcdefgh", "-----BEGIN RSA PRIVATE KEY-----"]

    def text(n):
        return " ".join(r.choice(bits) for _ in range(n)).encode()

    small, large = text(1500), text(12_000)
    assert len(scan.spans(small)) >= 1500
    assert best_of(lambda: scan.spans(large)) < 16 * best_of(lambda: scan.spans(small))


def test_one_pass_equals_each_expression():
    r = random.Random(6)
    rules = secret_scan.RULES
    scan = secret_scan.scanner(rules)
    bits = ["password", "PASSWD", "api_key", "=", ":", " ", "'", '"', "AKIA", "A1B2C3D4E5F6G7H8", "0123456789abcdef", "xoxb-", "ghp_", "eyJ", ".", "abcdefgh", "-----BEGIN", " PRIVATE KEY-----", " EC", "AIza", "sk_live_", "\n", "é"]
    for _ in range(1500):
        data = "".join(r.choice(bits) for _ in range(r.randint(0, 25))).encode()
        expected = []
        for n, rule in enumerate(rules):
            for m in re.finditer(rule.expression.encode(), data):
                head = len(re.match(rule.head.encode(), m[0])[0]) if rule.head else 0
                if len(m[0]) - head >= rule.least:
                    expected.append((n, *m.span()))
        assert scan.spans(data) == sorted(expected, key=lambda x: (x[1], x[0])), data


def test_equal_rows_cost_rows_in_proportion(spark):
    """The places of a repeated document are listed once, however many rows repeat it."""
    text = " ".join(f"w{i % 150}" for i in range(400))
    for rows in (50, 400):
        docs = spark.createDataFrame([(1, text)] * rows + [(0, text), (2, "other " * 30)], "doc_id long, text string")
        repeats = Repeats(docs)
        lists = repeats.spans().groupBy(*repeats.who).agg(F.collect_set("place").alias("p")).select(F.max(F.size("p"))).first()[0]
        assert lists <= 400
        kept = {(x.id, x.n_words, x.n_removed): x["count"] for x in repeats.kept().groupBy("id", "n_words", "n_removed").count().collect()}
        assert kept[1, 400, 400] == rows and len(kept) == 3


def test_rows_without_id_are_spread(spark):
    """No range of a leaf holds many of the rows that share a missing id; equal rows are one row of a window."""
    docs = spark.createDataFrame([(None, f"text {i} of many", "en", "src1") for i in range(3000)] + [(None, "the same", "en", "src1")] * 1500, "doc_id long, text string, lang string, source string")
    got = mixing.mixed_sources(docs)
    n = got.groupBy("n_tokens").count().collect()
    total = sum(x.n_tokens * x["count"] for x in n)
    assert 0 < total <= 0.5 * (3000 * 4 + 1500 * 2)
    assert {x.n_tokens: x["count"] for x in n}[4] > 1000
    plan = got._jdf.queryExecution().toString()
    assert "rank" in plan


def test_common_passage_is_no_key(spark, monkeypatch):
    """Texts with a long passage in common and nothing else meet in few words; the rows written grow with the texts."""
    r = random.Random(3)
    passage = [f"p{k}" for k in range(120)]
    written = {}
    monkeypatch.setattr(near_copies, "BLOCK", 100)
    keep = NearCopies._groups
    for n in (300, 1200):
        texts = [" ".join(passage + [f"w{r.randint(0, 10**6)}" for _ in range(70)]) for _ in range(n)]
        texts += [" ".join(passage + [f"near{k}" if k != c else "x" for k in range(40)]) for c in range(5)]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        seen = []

        def spy(self, placed, texts, seen=seen):
            groups = keep(self, placed, texts)
            seen.append((placed.select("nid").distinct().count(), groups.count()))
            return groups

        monkeypatch.setattr(NearCopies, "_groups", spy)
        got = NearCopies(docs).classes().collect()
        assert len({x.class_id for x in got}) == n + 1
        written[n] = seen[0]
    assert written[1200][0] > 1000, "the texts are open"
    assert written[1200][1] / written[1200][0] < 2 * max(written[300][1] / written[300][0], 5)


def test_a_shared_instruction_is_one_piece(spark):
    """Items that begin alike share their first piece; a document with it names them all, one with more only its own as well."""
    r = random.Random(5)
    first = "".join(r.choice("abcdefgh") for _ in range(120))
    rest = ["".join(r.choice("ijklmnop") for _ in range(150)) for i in range(30)]
    bench = spark.createDataFrame([(i, first + x) for i, x in enumerate(rest)] + [(None, "a passage without id that is looked for all the same")], "item_id long, text string")
    blocks = list(decontaminate.piece_blocks(bench))
    held = {p: items for block in blocks for items, p in block}
    shared = [items for p, items in held.items() if len(items) > 1]
    assert shared == [list(range(30))] or all(len(x) == 30 for x in shared)
    docs = spark.createDataFrame([(1, "head " + rest[3] + " tail"), (2, "x a passage without id that is looked for all the same x"), (3, "clean text")], "doc_id long, text string")
    assert {(x.doc_id, x.item_id) for x in decontaminate.find_leaks(docs, bench, ["doc_id"]).collect()} == {(1, 3), (2, None)}
    assert [x.doc_id for x in decontaminate.without_leaks(docs, bench).collect()] == [3]


def test_leaks_by_brute_force(spark, monkeypatch):
    """Every piece that stands in a text but for a few edits, by the full table of the alignment."""
    r = random.Random(12)
    items = ["".join(r.choice("abcdefghij ") for _ in range(r.randint(60, 260))) for _ in range(12)]
    texts = []
    for _ in range(60):
        item = decontaminate.plain(r.choice(items))
        begin = r.randint(0, 30)
        part = list(item[begin : begin + r.randint(50, 260)])
        for _ in range(r.randint(0, 9)):
            at = r.randrange(len(part))
            part[at : at + 1] = r.choice([[], ["#"], [part[at], "#"]])
        texts.append("".join(r.choice("abcdefghij ") for _ in range(r.randint(0, 80))) + "".join(part) + "".join(r.choice("abcdefghij ") for _ in range(40)))

    def edits(piece, text):
        row = [0] * (len(text) + 1)
        for i, x in enumerate(piece, 1):
            new = [i]
            for j, y in enumerate(text, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return min(row)

    expected = {
        (d, i) for i, item in enumerate(items) for d, text in enumerate(texts)
        if any(edits(p, decontaminate.plain(text)) <= decontaminate.budget(len(p)) for _, p in decontaminate.pieces(item))
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert 15 < len(expected) < len(texts) * len(items) / 2
    for size in (20_000, 5):
        monkeypatch.setattr(decontaminate, "BLOCK_PIECES", size)
        assert {(x.doc_id, x.item_id) for x in decontaminate.find_leaks(docs, bench, ["doc_id"]).collect()} == expected
        assert {x.doc_id for x in decontaminate.without_leaks(docs, bench).collect()} == set(range(len(texts))) - {d for d, _ in expected}


def test_risk_of_all_rules_together(spark):
    """Over many drawn holdouts, the true share of good documents that all cutoffs of a stratum reject is seldom over the risk."""
    draws, size, risk, error = 120, 2500, 0.05, 0.05
    rows = spark.range(draws * size).select((F.col("id") % draws).cast("string").alias("_stratum"), F.rand(1).alias("u"), F.rand(2).alias("v"))

    def tail(u):
        return F.floor(-20 * F.log(1 - F.col(u)))

    drawn = rows.select(
        "_stratum", tail("u").alias("_symbols"), tail("v").alias("_dup_lines"), F.lit(1000).alias("_chars"), F.lit(1000).alias("_lines"),
        F.lit(1000).alias("_n"), F.lit(0).alias("_repeated"),
    )
    # Each draw stands for a table of its own, with one stratum.
    found = rules.cutoffs(drawn, risk, error * draws).collect()
    over = strict = 0
    for x in found:
        lost = [0.0 if c is None else math.exp(-(c + 1) / 20) for c in (x._cut_symbols, x._cut_dup_lines)]
        over += 1 - (1 - lost[0]) * (1 - lost[1]) > risk
        strict += max(lost) > 0
    assert len(found) == draws and over <= error * draws
    assert strict > draws / 2, "cutoffs are found"


def of_one_id(spark):
    """An id with 60 texts, some of them repeated, and 20 with one text each; the first half of the texts is junk."""
    good = "The words of this text are of many kinds and every one is read by those who like to read long texts about nothing much. "
    texts = [f"#{n} $$ {n} " * 3 if n < 30 else f"Text {chr(60 + n)} begins. " + good * 3 for n in range(60)]
    rows = [(1, t) for t in texts + texts[:10] * 3] + [(100 + n, f"{chr(65 + n)} " + good * 3) for n in range(20)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_toxicity_sample_is_bounded(spark):
    docs = of_one_id(spark)
    labels = spark.createDataFrame([(1, 1), (1, 1), (1, 1), *[(100 + n, 0) for n in range(20)]], "doc_id long, toxic int")
    assert toxicity._labelled(docs, labels, "toxic", 10).count() == 10
    every = toxicity._labelled(docs, labels, "toxic", 1000)
    assert every.where("_id = 1").count() == 60
    assert every.count() == every.select("_id", "_text").distinct().count()


def test_quality_sample_is_bounded(spark, monkeypatch):
    seen = {}
    fit = quality_model.fit

    def spy(row, column, value, target, *more):
        seen["target"] = target
        return fit(row, column, value, target, *more)

    monkeypatch.setattr(quality_model, "fit", spy)
    docs = of_one_id(spark).where("doc_id = 1")
    quality_model.train(docs, rows=10)
    assert len(seen["target"]) == 10
    quality_model.train(docs, rows=1000)
    assert len(seen["target"]) == 60
    assert (seen["target"] < 0.5).sum() == 30, "each text has its own votes"
