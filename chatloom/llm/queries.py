"""One query per operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm import collocations, decontamination, divergence, neighbours, passages, pieces, quality, records, scoring, sharding, simhash, token_counts, urls
from chatloom.llm.common import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]
    )
    return found.select(
        "kept.doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


ORACLES["op2_winnowing"] = r"""
with d as (
  select row_number() over () as k, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
  from documents
),
i as (
  select item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
),
iw as (
  select distinct item_id, t, array_to_string(w[s + 1 : s + t], ' ') as g
  from (select item_id, w, least(13, len(w)) as t, unnest(range(0, len(w) - least(13, len(w)) + 1)) as s
        from i where len(w) > 0)
),
dw as (
  select k, t, s, array_to_string(w[s + 1 : s + t], ' ') as g
  from (select k, w, t, unnest(range(0, len(w) - t + 1)) as s
        from d, (select distinct t from iw) where len(w) >= t)
),
hit as (select k, s, t, item_id from dw join iw using (t, g)),
n as (select k, count(*) as n_hit from (select distinct k, unnest(range(s, s + t)) from hit) group by k),
m as (
  select k, count(*) as n_items, string_agg(cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
  from (select distinct k, item_id from hit) group by k
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join n using (k) left join m using (k)
"""


@query
def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.occurrences(table(spark, sf_dir, "documents"))


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.token_record_digests(table(spark, sf_dir, "documents"), BYTE_BPE)


# The rules of the contract.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


@query
def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge_urls(pages, rules).drop("url")


ORACLES["op6_url_filters"] = """
with rules(rhost, rpath, v) as (values {values}),
rest as (
  select row_number() over () as k, page_id,
    case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as r
  from pages
),
placed as (
  select k, page_id,
    translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path
  from rest
),
fit as (
  select k, max_by(rhost || rpath, length(rhost || rpath)) as rule, max_by(v, length(rhost || rpath)) as v
  from placed join rules
    on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
  group by k
)
select page_id, host, path, rule, coalesce(v, 'allow') as verdict
from placed left join fit using (k)
""".format(values=", ".join(str(r) for r in URL_RULES))


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return quality.score_documents(table(spark, sf_dir, "documents"), labels)


@query
def op8_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), 16, grown=17)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "next_shard",
    )


@query
def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoding_digests(table(spark, sf_dir, "documents"), PIECE_BPE)


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), PIECE_BPE)


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_collocations"] = r"""
with pieces as (
  select row_number() over () as k, lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as piece
  from (select coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents)
),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
n as (select lang, cast(sum(len(w)) as bigint) as n from w group by lang),
g as (
  select lang, t as size, w[s : s + t - 1] as p
  from (select lang, w, t, unnest(range(1, len(w) - t + 2)) as s from w, range(1, 6) r(t) where len(w) >= t)
),
f as (select lang, size, p, count(*) as f from g group by all having count(*) >= 100),
cut as (
  select c.lang, c.p, c.size, c.f as a, k, x.f as l, y.f as r, n.n,
    (1000::hugeint * c.f * n.n) // (x.f::hugeint * y.f) as score
  from (select *, unnest(range(1, size)) as k from f where size > 1) c
  join f x on x.lang = c.lang and x.p = c.p[1 : k]
  join f y on y.lang = c.lang and y.p = c.p[k + 1 : c.size]
  join n on n.lang = c.lang
),
best as (select * from cut qualify row_number() over (partition by lang, p order by score, k) = 1),
covered as (
  select distinct c.lang, c.p
  from f c join (select *, unnest(range(1, size + 1)) as s from f) b
    on b.lang = c.lang and b.size > c.size and b.p[s : s + c.size - 1] = c.p
  where c.size > 1 and 100 * b.f >= 100 * c.f
)
select lang, row_number() over (partition by lang order by score desc, a desc, array_to_string(p, ' ')) as rank,
  array_to_string(p, ' ') as phrase, a, l, r, n, cast(score as bigint) as score
from best anti join covered using (lang, p)
qualify rank <= 2000
"""


@query
def op12_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_documents(table(spark, sf_dir, "documents"))


@query
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op13_divergence"] = r"""
with d as (
  select row_number() over () as k, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
),
o as (select k, lang, source, unnest(w) as term from d),
t as (
  select lang, term, count(*) as n from o group by lang, term having count(distinct k) >= 3
),
l as (select lang, count(*) as v, sum(n) as n from t group by lang),
g as (select distinct lang, source from d),
c as (select lang, source, term, count(*) as n from o group by all),
gt as (select g.lang, g.source, t.term, coalesce(c.n, 0) as n, t.n as ln
  from g join t using (lang) left join c using (lang, source, term)),
gn as (select lang, source, sum(n) as n from gt group by all),
p as (
  select gt.lang, gt.source, gt.term, gt.n as c,
    1 + (1000000000::hugeint * (gt.n + 1)) // (gn.n + l.v) as p,
    1 + (1000000000::hugeint * (gt.ln + 1)) // (l.n + l.v) as q
  from gt join gn using (lang, source) join l using (lang)
),
pair as (
  select a.lang, a.source, b.source as item,
    coalesce((select sum(((x.p - y.p) * (x.p - y.p)) // y.p) from p x join p y using (lang, term)
      where x.lang = a.lang and x.source = a.source and y.source = b.source), 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
),
term as (select lang, source, term as item, ((p - q) * (p - q)) // q as value from p where c > 0 and p > q),
r as (
  select *, 'pair' as part, row_number() over (partition by lang, source order by value desc, item) as rank from pair
  union all by name
  select *, 'term' as part, row_number() over (partition by lang, source order by value desc, item) as rank from term
  qualify rank <= 200
)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as int) as rank from r
"""
