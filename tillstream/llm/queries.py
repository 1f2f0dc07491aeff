"""Registered queries of the operators in this package, each next to its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.llm import (
    block_repeats, decontaminate, fragment_join, host_reputation, importance_draw, line_index, line_labels, mixing,
    notice_search, periodic_runs, perspectives, secrets_ledger, subword_quality,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return add


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shingle_sql(n: int, percent: int) -> str:
    """Components of the n-gram join in SQL: (doc_id, n_shingles, component_id)."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
with recursive tokens as (
  select doc_id, regexp_extract_all({lower}, '[^\x20\x09-\x0D]+') as w from documents),
shingled as (
  select doc_id, case when len(w) = 0 then [] when len(w) < {n} then [array_to_string(w, ' ')]
    else list_distinct([array_to_string(w[i:i + {n - 1}], ' ') for i in range(1, len(w) - {n - 2})]) end as s
  from tokens),
named as (select doc_id, s, len(s) as size, md5(array_to_string(list_sort(s), '|')) as name from shingled),
grouped as (select name, min(doc_id) as node, any_value(size) as size, any_value(s) as s from named where size > 0 group by name),
grams as (select node, size, unnest(s) as g from grouped),
pairs as (
  select x.node as a, y.node as b from grams x join grams y on x.g = y.g and x.node < y.node
  where 100 * least(x.size, y.size) >= {percent} * greatest(x.size, y.size)
  group by 1, 2, x.size, y.size having 100 * count(*) >= {percent} * (x.size + y.size - count(*))),
links as (select a, b from pairs union all select b, a from pairs),
reach(node, other) as (select node, node from grouped union select r.node, l.b from reach r join links l on l.a = r.other),
lowest as (select node, min(other) as component from reach group by node)
select n.doc_id, cast(n.size as bigint) as n_shingles, coalesce(l.component, n.doc_id) as component_id
from named n left join grouped g on g.name = n.name left join lowest l on l.node = g.node
"""


@query(shingle_sql(3, 90))
def op1_ngram_join(spark, folder):
    """Components of documents whose 3-word shingle sets have a Jaccard similarity of 0.9 or more."""
    return fragment_join.link_components(read(spark, folder, "documents"), n=3, percent=90)


@query(r"""
with tokens as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
grams as (
  select doc_id, i as start, array_to_string(w[i:i + 12], ' ') as g
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from tokens where len(w) >= 13)),
lowest as (select g, min(doc_id) as low from grams group by g),
covered as (
  select distinct doc_id, unnest(range(start, start + 13)) as pos from grams join lowest using (g) where doc_id > low),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as pos from tokens),
kept as (
  select doc_id, string_agg(word, ' ' order by pos) as text, count(*) as n
  from words anti join covered using (doc_id, pos) group by doc_id)
select t.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(k.n, 0) as bigint) as n_removed,
       sha256(coalesce(k.text, '')) as kept_sha256
from tokens t left join kept k using (doc_id)
""")
def op4_repeated_passages(spark, folder):
    """Words of passages of 13 words and more that an earlier document holds as well."""
    return block_repeats.remove_repeats(read(spark, folder, "documents"))


@query()
def op5_secret_scan(spark, folder):
    """Secrets of every document, each distinct text scanned once."""
    found, _, _ = secrets_ledger.scan(read(spark, folder, "documents"), "doc_id", carry=["doc_id"])
    kinds = tuple(r.kind for r in secrets_ledger.BASE_RULES)

    def count(kind):
        return F.size(F.filter("found", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.withColumn("found", F.coalesce("found", F.expr(
        "cast(array() as array<struct<start: int, kind_order: int, kind: string, end: int>>)"))).select(
        "row.doc_id", *map(count, kinds), F.sha2(secrets_ledger.digest("found", kinds), 256).alias("base_sha256"),
        secrets_ledger.digest("found").alias("spans"))


@query(r"""
with b as (select item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from benchmark),
items as (select item_id, len(w) as item_size, greatest(1, len(w) - 4) as span, case when len(w) >= 5
    then [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] else [array_to_string(w, ' ')] end as s
  from b where item_id is not null and len(w) > 0),
t as (select doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from documents),
d as (select doc_id, len(w) as n, greatest(1, len(w) - 4) as total, case when len(w) >= 5
    then [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] else [array_to_string(w, ' ')] end as s
  from t where doc_id is not null and len(w) > 0),
e as (select doc_id, total, unnest(s) as g, unnest(range(len(s))) as p from d),
g as (select item_id, item_size, span, unnest(s) as g from items),
known as (select e.* from e semi join g on e.g = g.g),
near as (select distinct k.doc_id, k.total, k.p, g.item_id, g.item_size, g.span from known k join g on k.g = g.g),
meet as (select distinct doc_id, total, item_id, item_size, span, p - o as start
  from (select *, unnest(range(least(span, total))) as o from near) where p - o >= 0 and p - o <= total - least(span, total)),
mine as (select m.doc_id, m.total, m.item_id, m.item_size, m.span, m.start, k.g, count(*) as here
  from meet m join known k on k.doc_id = m.doc_id and k.p between m.start and m.start + least(m.span, m.total) - 1
  group by all),
theirs as (select item_id, g, count(*) as there from g group by all),
common as (select doc_id, total, item_id, item_size, span, start, sum(least(here, there)) as common
  from mine join theirs using (item_id, g) group by all),
scored as (select *, common / (least(span, total) + span - common) as similarity from common)
select doc_id, item_id, cast(start as int) as start_word, cast(item_size as int) as item_words, cast(similarity as double) as similarity
from scored where similarity >= 0.8
qualify row_number() over (partition by doc_id, item_id order by similarity desc, start, item_size desc) = 1
""")
def op10_benchmark_leaks(spark, folder):
    """Benchmark items that documents hold, with the most similar window."""
    return decontaminate.leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query()
def op2_quality(spark, folder):
    """Probability that a text is of good quality, learned from the labels outside fold 0."""
    return subword_quality.score(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query(r"""
with hashed as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
    md5(concat(coalesce(cast(doc_id as varchar), ''), chr(31), coalesce(text, ''), chr(31), '1')) as digest
  from documents),
numbered as (select *, row_number() over (partition by doc_id, source, size, digest) as k, length(bin(size)) as digits from hashed),
rows as (
  select *, (cast('0x' || substr(case when k = 1 then digest else md5(digest || ':' || k) end, 1, 13) as bigint)
      + 0.5::double) / 4503599627370496::double as u
  from numbered),
sizes as (select source, sum(size) as s from rows group by source),
weighted as (
  select *, ((row_number() over (order by encode(source) nulls last) - 1) % 3 + 1)::double as w from sizes),
filled as (
  select *, (sum(s) over () - 3.0::double * coalesce(sum(s) over (o rows between unbounded preceding and 1 preceding), 0))::double
      / sum(w) over (o rows between current row and unbounded following) as c
  from weighted window o as (order by s / w, encode(source) nulls last)),
share as (select max(c) as c from filled where c * w <= 3.0::double * s),
wanted as (
  select source, s, least(3.0::double * s, w * share.c) as target, case when s > 0 then least(3.0::double * s, w * share.c) / s else 0 end as ratio
  from filled cross join share),
classes as (
  select r.source, digits, w.s, w.target, floor(ratio) as whole, target - floor(ratio) * w.s as rest, sum(size) as c
  from rows r join wanted w on r.source is not distinct from w.source group by all),
tried as (
  select *, (rest - coalesce(sum(c) over (o rows between unbounded preceding and 1 preceding), 0))::double
      / nullif(sum(digits * c) over (o rows between current row and unbounded following), 0)::double as f
  from classes window o as (partition by source order by digits desc)),
rated as (
  select *, greatest(0, least(1, coalesce(digits * max(case when f * digits <= 1 then f end) over (partition by source), 1))) as rate from tried),
chances as (
  select source, digits, s, target, whole + case when rate >= 1 and rest > 0 then 1 else 0 end as copies,
    case when rate >= 1 then 0 else rate end as chance,
    rest - sum(case when rate >= 1 then c else 0 end) over (partition by source) as quota
  from rated),
odds as (
  select r.*, c.s, c.target, copies, chance, quota,
    case when chance > 0 then (u / (1 - u)) / (chance / (1 - chance)) else 0 end as odds
  from rows r join chances c on r.source is not distinct from c.source and r.digits = c.digits),
running as (
  select *, coalesce(sum(case when chance > 0 then size else 0 end) over (
    partition by source order by odds, doc_id, size rows between unbounded preceding and 1 preceding), 0) as before
  from odds)
select doc_id, cast(size as bigint) as size, cast(s as bigint) as source_size, target,
  cast((copies + case when chance > 0 and before + size / 2 <= quota then 1 else 0 end) * size as bigint) as taken
from running
""")
def op3_source_mix(spark, folder):
    """Words that a mix of all sources by weights 1, 2, 3 takes of every document."""
    return mixing.mix(read(spark, folder, "documents"))


@query()
def op7_license_notices(spark, folder):
    """Licence notices of every document: exact phrases, and short notices with bounded edits."""
    found = notice_search.find_notices(read(spark, folder, "documents"))
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["first_word"])

    def labels(matches):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"))


@query()
def op8_quality_rules(spark, folder):
    """Counts, base rules and the share of content lines of every document."""
    return line_labels.judge(read(spark, folder, "documents"), read(spark, folder, "labels")).drop("line_labels")


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcome of labelled pages: bad if the document named at the end of the path is poor or toxic."""
    _, path = host_reputation.host_and_path("url")
    named = pages.select("page_id", F.regexp_extract(path, r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", 1).alias("name"))
    known = labels.select(
        F.col("doc_id").cast("string").alias("name"), F.expr("if(quality = 0 or toxic = 1, 1, 0)").alias("bad"))
    return named.join(known, "name").select("page_id", "bad")


@query(r"""
with parts as (
  select page_id, url, case when contains(url, '://') then regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', ['host', 'path'])
    else {'host': '', 'path': ''} end as p from pages),
placed as (select page_id, translate(p.host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, p.path as path from parts),
outcomes as (
  select page_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as bad
  from placed join labels on cast(doc_id as varchar) = regexp_extract(path, '/([0-9]{1,18})(?:\.[a-z]+)?/?$', 1) group by page_id),
hosts as (
  select host, array_to_string(string_split(host, '.')[-2:], '.') as domain, string_split(host, '.')[-1] as suffix,
    count(bad) as n, coalesce(sum(bad), 0) as bad
  from placed left join outcomes using (page_id) group by host),
suffixes as (select suffix, sum(n) as n, sum(bad) as bad, (select coalesce(sum(bad) / sum(n), 0) from hosts) as mean from hosts group by suffix),
s1 as (select count(*) as k, sum(n) as n, sum(n * n) as sq, sum(n * (bad / n - mean) ** 2) as b, sum(n * (bad / n) * (1 - bad / n)) as w from suffixes where n > 0),
m1 as (select case when k < 2 or n <= k then 1 else (with t as (select w / (n - k) as mw, b / (k - 1) - w / (n - k) as sp, (n - sq / n) / (k - 1) as ty)
  select case when sp > 0 and sp + ty * mw > 0 then least(1000, greatest(1, (sp + ty * mw) / sp - 1)) else 1000 end from t) end as m from s1),
r1 as (select suffix, (mean * m + bad) / (n + m) as mean from suffixes, m1),
domains as (select domain, suffix, sum(n) as n, sum(bad) as bad, any_value(mean) as mean from hosts join r1 using (suffix) group by domain, suffix),
s2 as (select count(*) as k, sum(n) as n, sum(n * n) as sq, sum(n * (bad / n - mean) ** 2) as b, sum(n * (bad / n) * (1 - bad / n)) as w from domains where n > 0),
m2 as (select case when k < 2 or n <= k then 1 else (with t as (select w / (n - k) as mw, b / (k - 1) - w / (n - k) as sp, (n - sq / n) / (k - 1) as ty)
  select case when sp > 0 and sp + ty * mw > 0 then least(1000, greatest(1, (sp + ty * mw) / sp - 1)) else 1000 end from t) end as m from s2),
r2 as (select domain, (mean * m + bad) / (n + m) as mean from domains, m2),
leaves as (select host, n, bad, mean from hosts join r2 using (domain)),
s3 as (select count(*) as k, sum(n) as n, sum(n * n) as sq, sum(n * (bad / n - mean) ** 2) as b, sum(n * (bad / n) * (1 - bad / n)) as w from leaves where n > 0),
m3 as (select case when k < 2 or n <= k then 1 else (with t as (select w / (n - k) as mw, b / (k - 1) - w / (n - k) as sp, (n - sq / n) / (k - 1) as ty)
  select case when sp > 0 and sp + ty * mw > 0 then least(1000, greatest(1, (sp + ty * mw) / sp - 1)) else 1000 end from t) end as m from s3),
rated as (select host, (mean * m + bad) / (n + m) as rate, n + m as total from leaves, m3),
bounded as (select host, rate - 1.645 * sqrt(rate * (1 - rate) / (total + 1)) as bound from rated),
ruled as (
  select placed.*, case
      when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
      when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
      when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
      when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule
  from placed)
select page_id, host, path, rule, case when rule in ('net/', 'example.com/de/') then 'block' when rule is not null then 'allow'
    when bound > 0.5 then 'block' else 'allow' end as verdict
from ruled join bounded using (host)
""")
def op9_url_filter(spark, folder):
    """Verdict on every page's URL by rules, else by the reputation of its host."""
    pages = read(spark, folder, "pages")
    outcomes = page_outcomes(pages, read(spark, folder, "labels"))
    return host_reputation.filter_urls(pages.select("page_id", "url"), outcomes).drop("bad_rate", "lower_bound")


@query(r"""
with said as (
  select distinct conv_id, turn, coalesce(role, 'unknown') as role, coalesce(text, '') as text, turn // 64 as part from conversations
  where conv_id is not null and turn is not null),
views as (select distinct conv_id, part, role as participant from said where role <> 'system'),
pieces as (
  select v.*, turn, role, text, role = participant as mine,
    case when role = participant then '<|im_start|>assistant' || chr(10) when role = 'system' then '<|im_start|>system' || chr(10)
      else '<|im_start|>user name=' || replace(role, '<|im_', '< |im_') || chr(10) end as head,
    replace(text, '<|im_', '< |im_') || '<|im_end|>' as body
  from views v join said using (conv_id, part)),
placed as (
  select *, coalesce(sum(length(head) + length(body) + 1) over (
    partition by conv_id, part, participant order by turn, role, text rows between unbounded preceding and 1 preceding), 0) + length(head) as start
  from pieces)
select conv_id, participant, cast(part as bigint) as part, cast(count(*) as int) as n_turns, cast(count_if(mine) as int) as n_trained,
  string_agg(head || body || chr(10), '' order by turn, role, text) as text,
  string_agg(start::bigint || '-' || (start + length(body))::bigint, ',' order by turn, role, text) filter (where mine) as mask
from placed group by conv_id, part, participant
""")
def op6_perspectives(spark, folder):
    """Every conversation as training text from each participant's perspective."""
    return perspectives.dialogues(read(spark, folder, "conversations"))


@query(r"""
with split as (select doc_id, row_number() over () as r, string_split(coalesce(text, ''), chr(10)) as l from documents),
lines as (select doc_id, r, unnest(l) as line, unnest(range(1, len(l) + 1)) as pos from split),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
lowest as (
  select key, min(doc_id) as low from keyed where length(key) >= 10 group by key having count(distinct doc_id) > 1),
kept as (
  select r, string_agg(line, chr(10) order by pos) as text, count(*) as n
  from keyed left join lowest using (key) where low is null or doc_id is null or doc_id = low group by r)
select doc_id, cast(len(l) as bigint) as n_lines, cast(len(l) - coalesce(n, 0) as bigint) as n_dropped,
       sha256(coalesce(text, '')) as kept_sha256
from split left join kept using (r)
""")
def op11_line_dedup(spark, folder):
    """Documents without the lines that an earlier document holds, by an index that can be undone."""
    docs = read(spark, folder, "documents")
    cleaned = line_index.LineIndex.create(spark).insert(docs).cleaned(docs)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


#: Unsigned crc32 in SQL: the table of its 256 byte steps, and the loop over the bytes of {0} (a varchar).
CRC_TABLE_SQL = """select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end)) as steps"""
CRC_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(0, octet_length(encode({0})) * 2, 2),
    lambda i: cast('0x' || substr(hex(encode({0})), cast(i + 1 as int), 2) as bigint))),
    lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1])))"""


@query(rf"""
with table_ as ({CRC_TABLE_SQL}),
words as (
  select doc_id, row_number() over () as r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
theirs as (
  select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as f from benchmark),
mine as (select r, unnest(w) as f from words),
known as (select f, {CRC_SQL.format('f')} % 10000 as b from (select f from mine union select f from theirs), table_),
s as (select b, count(*) as n from mine join known using (f) group by b),
t as (select b, count(*) as n from theirs join known using (f) group by b),
gains as (
  select b, cast(floor(1000 * ln((coalesce(t.n, 0) + 1)::double * (coalesce((select sum(n) from s), 0) + 10000)::double
      / ((coalesce(s.n, 0) + 1)::double * (coalesce((select sum(n) from t), 0) + 10000)::double))) as bigint) as gain
  from (select unnest(range(10000)) as b) left join s using (b) left join t using (b)),
weighed as (select r, sum(gain) as weight from mine join known using (f) join gains using (b) group by r),
scored as (
  select doc_id, cast(len(w) as bigint) as n_features, cast(coalesce(weight, 0) as bigint) as weight,
    cast(coalesce(weight, 0) + floor(-1000 * ln(-ln((cast('0x' || substr(sha256('2024:' || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint)
      + 0.5::double) / 4294967296::double))) as bigint) as score
  from words left join weighed using (r)),
drawn as (
  select *, row_number() over (order by n_features < 20, score desc, doc_id nulls last, n_features) as place,
    count_if(n_features >= 20) over () as n from scored)
select doc_id, n_features, weight, score, case when place <= 10 * n // 100 then place end as rank from drawn
""")
def op12_importance_draw(spark, folder):
    """Documents drawn towards the words of the benchmark, a tenth of those with 20 words and more."""
    docs, target = read(spark, folder, "documents"), read(spark, folder, "benchmark")
    return importance_draw.resample(docs, target).drop("n_words")


def planted_periods(docs: DataFrame) -> DataFrame:
    """Documents of which a tenth, chosen by the crc32 of the id, is made periodic from some word on.

    With g the tenth of that number, words from a = g % n on repeat every 1 + (n - a) // (3 + g % 8) words.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    parts = docs.select("doc_id", "text", h.alias("h"), F.when(
        h % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).alias("w"))
    sized = parts.withColumns({"n": F.size("w").cast("bigint"), "g": F.floor(F.col("h") / 10)}).withColumn(
        "a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    sized = sized.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    periodic = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), lambda i: F.get(
        "w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return sized.select("doc_id", F.when(F.col("n") > 0, F.array_join(periodic, " ")).otherwise(F.col("text")).alias("text"))


@query(rf"""
with table_ as ({CRC_TABLE_SQL}),
given as (
  select doc_id, row_number() over () as r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    {CRC_SQL.format("cast(doc_id as varchar)")} as h
  from documents, table_),
sized as (select *, len(w) as n, h // 10 as g, case when len(w) > 0 then (h // 10) % len(w) end as a from given),
words as (
  select doc_id, r, n, case when n > 0 and h % 10 = 0
    then list_transform(range(n), lambda i: w[case when i < a then i + 1 else a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1 end])
    else w end as w
  from sized),
placed as (select r, n, unnest(w) as word, unnest(range(n)) as i from words),
equal as (
  select x.r, y.i - x.i as q, x.i, x.i - row_number() over (partition by x.r, y.i - x.i order by x.i) as island
  from placed x join placed y on x.r = y.r and x.word = y.word and y.i > x.i and 4 * (y.i - x.i) <= x.n),
stretches as (
  select r, q, min(i) as start, count(*) + q as length from equal group by r, q, island
  having count(*) + q >= greatest(6, 4 * q)),
runs as (select r, start, length, min(q) as period from stretches group by r, start, length),
listed as (
  select r, count(*) as n_runs, arg_max({{'s': start, 'l': length, 'p': period}}, [length, -start, -period]) as top,
    string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as text
  from runs group by r),
gone as (select distinct r, unnest(range(start + period, start + length)) as i from runs),
kept as (select r, string_agg(word, ' ' order by i) as text from placed anti join gone using (r, i) group by r)
select doc_id, coalesce(n_runs, 0) as n_runs, top.s as start, top.l as length, top.p as period,
  1000 * top.l // top.p as exponent_milli, sha256(coalesce(listed.text, '')) as runs_sha256,
  sha256(coalesce(kept.text, '')) as collapsed_sha256
from words left join listed using (r) left join kept using (r)
""")
def op13_periodic_runs(spark, folder):
    """Periodic runs of words in every document, and its text with each run cut to one period."""
    found = periodic_runs.periodic_runs(planted_periods(read(spark, folder, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("shorter"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    top = found.select("*", longest.alias("top"), listed.alias("listed"))
    period = -F.col("top.shorter")
    return top.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.back")).alias("start"),
        F.col("top.length").alias("length"), period.alias("period"),
        F.floor(F.col("top.length") * 1000 / period).alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))
