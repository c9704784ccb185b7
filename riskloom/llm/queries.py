"""The registered queries of the operators, and SQL that must give the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import secret_scan as secrets
from riskloom.llm import decontaminate, licenses, mixing, prefix_trie, quality_model, ranked_search, rules, token_count, toxicity
from riskloom.llm.near_copies import NearCopies
from riskloom.llm.substrings import Repeats
from riskloom.llm.token_files import Encoder, TokenFiles
from riskloom.llm.common import table, whole

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


# ---------------------------------------------------------------- 1: secret scan


def _spans_sql() -> str:
    """Places of matches from the pieces between them, as both cuts are leftmost and do not overlap."""
    parts = []
    for n, r in enumerate(secrets.RULES):
        pattern = r.expression.replace("'", "''")
        head = r.head.replace("'", "''")
        size = f"length(m) - length(regexp_extract(m, '^({head})', 0))" if head else "length(m)"
        parts.append(f"""
  select doc_id, kind, n, s, s + length(m) as e from (
    select doc_id, '{r.kind}' as kind, {n} as n, unnest(ms) as m, unnest(list_transform(range(1, len(ms) + 1), lambda i:
        list_sum(list_transform(ps[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda p: length(p))), 0))) as s
    from (select doc_id, regexp_extract_all(t, '{pattern}') as ms, string_split_regex(t, '{pattern}') as ps from d)
  ) where {size} >= {r.least}""")
    return " union all ".join(parts)


OP1_SQL = f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
spans as ({_spans_sql()}),
joined as (
  select doc_id, count(*) filter (n = 0) as n_assign, count(*) filter (n = 1) as n_access, count(*) filter (n = 2) as n_hex,
    string_agg(kind || ':' || cast(s as bigint) || ':' || cast(e as bigint), ',' order by s, n) filter (n < 3) as base,
    string_agg(kind || ':' || cast(s as bigint) || ':' || cast(e as bigint), ',' order by s, n) as spans
  from spans group by doc_id)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join joined using (doc_id)
"""


@query(OP1_SQL)
def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document: counts of the base kinds, a digest of their spans, and all spans."""
    found = table(spark, folder, "documents").select("doc_id", secrets.secret_spans(F.col("text")).alias("found"))
    base = [r.kind for r in secrets.BASE]

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def kinds(*wanted: str) -> Column:
        return F.filter("found", lambda s: s.kind.isin(*wanted))

    return found.select(
        "doc_id",
        *[F.size(kinds(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(listed(kinds(*base)), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


# ---------------------------------------------------------------- 2: token counts

TOKEN_LIMIT = 512


@query()
def op2_token_count(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it exceeds the context of 512 tokens."""
    docs = table(spark, folder, "documents")
    tokens = token_count.token_count(spark, F.col("text"), public_tokenizers.path("byte_bpe_50k.json"))
    counted = docs.select("doc_id", F.octet_length(whole()).cast("long").alias("n_bytes"), tokens.alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


# ---------------------------------------------------------------- 8: toxicity

REJECT = 0.7


@query()
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document, learned from two of three folds of the labels."""
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.score(spark, F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= REJECT, 1).otherwise(0))


# ---------------------------------------------------------------- 9: license scan


def _license_sql() -> str:
    rows = ", ".join(f"({n}, '{t.label}', {int(t.phrase)}, string_split('{t.text}', ' '), {[] if t.phrase else t.telling()}::int[])" for n, t in enumerate(licenses.TEMPLATES))
    near = f"list_transform(list_filter(spots, lambda x: x.here >= s.here and x.here - s.here + 1 <= {licenses.STRETCH} * pairs), lambda x: x.there)"
    slack, share = licenses.SLACK, licenses.SHARE
    return f"""
with templates(tid, label, phrase, ws, tells) as (values {rows}),
places as (select tid, i - 1 as there, ws[i] as a, ws[i + 1] as b from (select tid, ws, unnest(range(1, len(ws))) as i from templates)),
d as (select row_number() over () as rid, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
pairs as (select rid, i - 1 as here, ws[i] as a, ws[i + 1] as b from (select rid, ws, unnest(range(1, len(ws))) as i from d)),
votes as (select rid, tid, here - there as diagonal, cast(here as int) as here, cast(there as int) as there from pairs join places using (a, b)),
diagonals as (select rid, tid, diagonal, list(struct_pack(here := here, there := there)) as spots from votes group by all),
marked as (select *, case when diagonal - lag(diagonal) over w <= case phrase when 1 then 0 else {slack} end then 0 else 1 end as fresh
  from diagonals join templates using (tid) window w as (partition by rid, tid order by diagonal)),
numbered as (select *, sum(fresh) over (partition by rid, tid order by diagonal) as span from marked),
merged as (select rid, tid, label, phrase, any_value(tells) as tells, len(any_value(ws)) - 1 as pairs, flatten(list(spots)) as spots, min(diagonal) as start
  from numbered group by rid, tid, label, phrase, span),
spans as (select *, case when phrase = 1 then len(spots) / pairs else list_max(list_transform(spots, lambda s: len(list_distinct({near})))) / pairs end as share,
  case when phrase = 1 then len(spots) = pairs
  else len(list_filter(spots, lambda s: len(list_distinct({near})) / pairs >= {share} and list_has_all({near}, tells))) > 0 end as verified from merged),
found as (select rid, count(*) filter (verified and phrase = 1) as n_base, min(start) filter (verified and phrase = 1) as first_word,
  max(start) filter (verified and phrase = 1) as last_word,
  string_agg(distinct label, ',' order by label) filter (verified and phrase = 1) as base_labels,
  string_agg(distinct label, ',' order by label) filter (verified) as labels, max(share) as score from spans group by rid)
select doc_id, len(ws) as n_words, coalesce(n_base, 0) as n_base, cast(first_word as bigint) as first_word,
  cast(last_word as bigint) as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
  cast(coalesce(score, 0) as double) as score
from d left join found using (rid)
"""


@query(_license_sql())
def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Places of license phrases and labels of license notices in every document."""
    return licenses.license_scan(table(spark, folder, "documents"), ["doc_id"])


# ---------------------------------------------------------------- 10: quality rules


def _rules_sql() -> str:
    value = {
        "symbols": "symbols * 1000 // greatest(chars, 1)", "dup_lines": "dups * 1000 // greatest(lines, 1)",
        "repeated": "repeated * 1000 // greatest(n, 1)", "long_words": "chars * 1000 // greatest(n, 1)", "short": "1000 // greatest(n, 1)",
    }
    tests = ", ".join(f"('{rule}', {c})" for rule, cs in rules.CUTOFFS.items() for c in cs)
    risk, per = rules.RISK / len(rules.CUTOFFS), rules.ERROR
    pick = "case rule " + " ".join(f"when '{rule}' then {v}" for rule, v in value.items()) + " end"
    reject = " or ".join(f"coalesce(({v}) > (select min(cutoff) from safe where safe.stratum = f.stratum and rule = '{rule}'), false)" for rule, v in value.items())
    return f"""
with d as (select row_number() over () as rid, doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as t,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from documents),
runs as (select rid, i, array_to_string(ws[i:i + 7], ' ') as run from (select rid, ws, unnest(range(1, len(ws) - 6)) as i from d)),
marks as (select rid, i, count(*) over (partition by rid, run) as c from runs),
gaps as (select rid, coalesce(least(i - lag(i) over (partition by rid order by i), 8), 8) as more from marks where c > 1),
again as (select rid, sum(more) as repeated from gaps group by rid),
f as (select d.rid, doc_id, stratum, len(ws) as n, length(array_to_string(ws, '')) as chars,
    length(t) - length(translate(t, '{rules.SYMBOLS}', '')) as symbols, len(ls) as lines, len(ls) - len(list_distinct(ls)) as dups,
    cast(coalesce(repeated, 0) as bigint) as repeated from d left join again using (rid)),
b as (select *, n < 20 or 100 * repeated > 30 * n as failed from f),
good as (select b.* from b where not failed and doc_id in (select doc_id from labels where quality = 1)),
tests(rule, cutoff) as (values {tests}),
counts as (select stratum, rule, cutoff, count(*) as good, count(*) filter ({pick} > cutoff) as lost from good, tests group by all),
tails as (select stratum, rule, cutoff, sum(exp(lgamma(good + 1) - lgamma(i + 1) - lgamma(good - i + 1) + i * ln({risk}) + (good - i) * ln(1 - {risk}))) as p
  from (select *, unnest(range(0, lost + 1)) as i from counts where lost < {risk} * good) group by all),
safe as (select * from tails where p <= {per} / ({len(rules.CUTOFFS)} * (select count(distinct stratum) from good)))
select doc_id, n as n_words, chars as word_chars, symbols as n_symbols, dups as n_dup_lines, repeated as n_repeat_words,
  failed as base_failed, not failed and not ({reject}) as kept from b as f
"""


@query(_rules_sql())
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts of every document and whether it passes the base rules and the risk-controlled ones."""
    return rules.quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))


# ---------------------------------------------------------------- 3: benchmark decontamination


@query()
def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """The benchmark items found in documents, one row for each document and item; clean documents have none."""
    return decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"), ["doc_id"])


# ---------------------------------------------------------------- 5: substring dedup

OP5_SQL = """
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
runs as (select doc_id, i, array_to_string(ws[i:i + 19], ' ') as run from (select doc_id, ws, unnest(range(1, len(ws) - 18)) as i from d)),
later as (select doc_id, i from (select *, row_number() over (partition by run order by doc_id, i) as nth from runs) where nth > 1),
gone as (select distinct doc_id, i + j as w from later, (select unnest(range(0, 20)) as j)),
each as (select doc_id, ws[w] as word, w from (select doc_id, ws, unnest(range(1, len(ws) + 1)) as w from d)),
left_over as (select doc_id, string_agg(word, ' ' order by w) as kept, count(*) as n from each anti join gone using (doc_id, w) group by doc_id)
select doc_id, len(ws) as n_words, len(ws) - coalesce(n, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join left_over using (doc_id)
"""


@query(OP5_SQL)
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that are left after repeated runs of 20 words are removed."""
    kept = Repeats(table(spark, folder, "documents")).kept()
    return kept.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


# ---------------------------------------------------------------- 6: near copies


@query()
def op6_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    """The class of near copies that every document belongs to."""
    classes = NearCopies(table(spark, folder, "documents")).classes()
    return classes.select(F.col("id").alias("doc_id"), "class_id", "class_size", "first")


# ---------------------------------------------------------------- 4: mixing sources to target weights


def _filled_sql(depth: int) -> str:
    level, parent = mixing.LEVELS[depth], mixing.LEVELS[:depth]
    keys = "".join(f"{p}, " for p in parent)
    part = f"partition by {', '.join(parent)}" if parent else ""
    weights = " ".join(f"when '{v}' then {w}" for v, w in mixing.WEIGHTS[level].items() if v != mixing.OTHER) or "when null then 0"
    budget = f"join q{depth - 1} using ({', '.join(parent)})" if parent else f"cross join (select cast(floor(sum(tokens) * {mixing.SHARE}) as hugeint) as part from leaves)"
    return f"""
n{depth} as (select {keys}{level}, cast(sum(tokens) * {mixing.EPOCHS} as hugeint) as cap, cast(case {level} {weights} else {mixing.WEIGHTS[level][mixing.OTHER]} end as hugeint) as weight
  from leaves group by all),
b{depth} as (select n{depth}.*, cast(part as hugeint) as budget from n{depth} {budget}),
f{depth} as (select *, cap * sum(weight) over (o rows between current row and unbounded following)
    <= weight * (budget - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0)) as fits
  from b{depth} window o as ({part} order by cast(cap as double) / cast(weight as double), {level})),
m{depth} as (select *, bool_and(fits) over ({part} order by cast(cap as double) / cast(weight as double), {level} rows between unbounded preceding and current row) as saturated from f{depth}),
q{depth} as (select {keys}{level}, cast(least(cap, case when saturated then cap else
    cast(weight * (budget - coalesce(sum(case when saturated then cap end) over ({part}), 0)) as hugeint) // cast(sum(case when not saturated then weight end) over ({part}) as hugeint) end) as bigint) as part
  from m{depth})"""


OP4_SQL = f"""
with d as (select doc_id, body, lang_ as lang, source_ as source, n_tokens,
    case when regexp_extract(source_, '([0-9]+)$', 1) = '' then '' else {list(mixing.NAMED_DOMAINS)}[cast(right(source_, 1) as int) % 3 + 1] end as domain
  from (select doc_id, md5(coalesce(text, '')) as body, coalesce(lang, '') as lang_, coalesce(source, '') as source_, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as n_tokens from documents)
  where n_tokens > 0),
leaves as (select domain, lang, source, sum(n_tokens) as tokens from d group by all),
{",".join(_filled_sql(i) for i in range(3))},
drawn as (select d.*, part // tokens as passes, part % tokens as rest,
    md5('{mixing.SEED}:' || cast(part // tokens as bigint) || ':' || coalesce(cast(doc_id as varchar), '') || ':' || body) as rank
  from d join leaves using (domain, lang, source) join q2 using (domain, lang, source)),
summed as (select *, sum(n_tokens) over (partition by domain, lang, source order by rank) <= rest as more from drawn)
select doc_id, domain, lang, source, n_tokens, unnest(range(0, cast(passes as bigint) + more::int)) as epoch from summed
"""


@query(OP4_SQL)
def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Documents drawn so that half of all tokens follow the target weights of domains, languages and sources."""
    return mixing.mixed_sources(table(spark, folder, "documents"))


# ---------------------------------------------------------------- 7: quality classifier


@query()
def op7_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document, learned from heuristic labellers alone, and whether it is kept."""
    docs = table(spark, folder, "documents")
    scored = docs.select("doc_id", quality_model.score(spark, F.col("text"), quality_model.train(docs)).alias("score"))
    return scored.withColumn("kept", F.col("score") >= 0.5)


# ---------------------------------------------------------------- 11: ranked lexical search

BEST = 50

OP11_SQL = f"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ts from documents),
q as (select row_number() over () as item_row, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as ts from benchmark),
sizes as (select rid, doc_id, len(ts) as n from d where len(ts) > 0),
sums as (select count(*) as total, cast(sum(n) as bigint) as length from sizes),
tf as (select rid, term, count(*) as tf from (select rid, unnest(ts) as term from d) group by all),
weights as (select term, cast(floor(1000 * ln((2 * total + 2) / (2 * count(*) + 1))) as bigint) as w from tf, sums group by term, total),
scores as (select item_row, rid, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * total) // length)))) as bigint) as score
  from (select item_row, unnest(ts) as term from q) join tf using (term) join weights using (term) join sizes using (rid), sums group by all),
ranked as (select *, row_number() over (partition by item_row order by score desc, doc_id nulls last) as rank from scores join sizes using (rid) where score > 0)
select item_id, cast(rank as int) as rank, doc_id, score from ranked join q using (item_row) where rank <= {BEST}
"""


@query(OP11_SQL)
def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 highest-scoring documents of every benchmark item."""
    found = ranked_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), BEST)
    return found.select(F.col("item").alias("item_id"), "rank", F.col("key").alias("doc_id"), "score")


# ---------------------------------------------------------------- 12: token ids in binary files

END_ID = 1


@query()
def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Place, number and checksum of every document's token ids, read back from the written files by the document's key."""
    docs = table(spark, folder, "documents")
    files = TokenFiles.write(docs, Encoder(public_tokenizers.path("word_bpe_49k.json"), END_ID))
    ids = files.read(docs)
    return ids.select(F.col("key").alias("doc_id"), "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


# ---------------------------------------------------------------- 13: conversation prefix trie

OP13_SQL = f"""
with t as (select conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as key,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as words,
    row_number() over (partition by conv_id order by turn nulls first, key) - 1 as nth from conversations where conv_id is not null),
c as (select conv_id, conv_id - conv_id % {prefix_trie.FAMILY} as head, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
    lambda crc, x: list_reduce([xor(crc, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, 3988292384 * (a & 1))))) % {prefix_trie.HEADS} as h from (select distinct conv_id from t)),
r as (select c.conv_id, 0 as part, nth, key, words from c join t on t.conv_id = head where nth < h union all select conv_id, 1, nth, key, words from c join t using (conv_id) where nth >= h),
s as (select conv_id, coalesce(ks, []) as ks, coalesce(ws, []) as ws from c left join (select conv_id, list(key order by part, nth) as ks, list(words order by part, nth) as ws from r group by conv_id) using (conv_id)),
paths as (select conv_id, d, ks[1:d] as path, coalesce(ws[d], 0) as words, len(ks) = d as ends from (select *, unnest(range(0, len(ks) + 1)) as d from s)),
nodes as (select path, d, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(words) as saved,
  sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256 from paths group by path, d),
kids as (select path[1:d - 1] as path, count(*) as n_children from nodes where d > 0 group by 1),
each as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join kids using (path)),
sums as (select path[1:up] as path, count(*) filter (n_children = 0) as n_leaves, cast(sum(saved) as bigint) as saved_tokens from (select *, unnest(range(0, d + 1)) as up from each) group by 1)
select each.conv_id, each.d as depth, above.conv_id as parent_conv_id, each.n_convs, each.n_children, n_leaves, saved_tokens, each.ends_sha256
from each join sums using (path) left join nodes above on above.path = each.path[1:each.d - 1] and above.d = each.d - 1
"""


@query(OP13_SQL)
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations with its members, children, leaves and saved tokens."""
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))
