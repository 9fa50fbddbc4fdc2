"""The operators' named queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.llm import bpe, conversations, decontaminate, filter_audit, html, jaccard, language, licenses, lm_score, sharding, simhash, substrings, token_files
from tillwatch.llm.shared import shared_folder, stored

SHARDS = [f"shard-{n:02d}" for n in range(32)]
#: fixed value: the id written after each document
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def sharding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return sharding.assign_shards(docs, "doc_id", SHARDS)


def lm_scoring_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good documents (labels.quality = 1) are the target, all documents the background."""
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return lm_score.score_documents(table(spark, sf_dir, "documents"), good)


def bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path(), digests=True)


def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.withColumn("n_hit", decontaminate.hit_words()).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def substring_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def license_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents")).drop("fuzzy")


def html_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(table(spark, sf_dir, "pages"))


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = language.learn_profiles(docs.filter(~F.coalesce(held_out(), F.lit(False))))
    found = language.predict_language(docs, profiles)
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def fingerprint_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For ids divisible by 100 also n_near: how many documents have a fingerprint within the radius (itself included)."""
    found = stored(simhash.edited_fingerprints(table(spark, sf_dir, "documents")), "fingerprints")
    sizes = found.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"))
    queries = found.filter("doc_id % 100 = 0").select("fingerprint").distinct()
    near = simhash.within_radius(queries, sizes).join(sizes.withColumnRenamed("fingerprint", "near"), "near")
    near = near.groupBy("fingerprint").agg(F.sum("n").alias("n_near"))
    hexed = [F.lower(F.lpad(F.hex(c), 16, "0")).alias(c) for c in ("fingerprint", "edited_fingerprint")]
    return found.join(near, "fingerprint", "left").select(
        "doc_id", "n_chars", "edited_sha256", *hexed, "near_edited", "near_next", F.when(F.col("doc_id") % 100 == 0, F.col("n_near")).alias("n_near"),
    )


def jaccard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def filter_audit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def conversation_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    return conversations.repair_conversations(conversations.damaged(given), given, digests=True)


def token_output_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    token_files.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path(), folder, end_id=END_ID)
    return token_files.read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": sharding_query,
    "op2_lm_scoring": lm_scoring_query,
    "op3_bpe": bpe_query,
    "op4_decontamination": decontamination_query,
    "op5_substring_dedup": substring_query,
    "op6_license_scan": license_query,
    "op7_html_extraction": html_query,
    "op8_language_id": language_query,
    "op9_fingerprints": fingerprint_query,
    "op10_jaccard_join": jaccard_query,
    "op11_filter_audit": filter_audit_query,
    "op12_conversation_repair": conversation_query,
    "op13_token_output": token_output_query,
}


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTERS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLES: dict[str, str] = {
    "op1_sharding": f"""
with recursive shards as (
  select n, 'shard-' || lpad(n::varchar, 2, '0') as shard from range({len(SHARDS)}) t(n)
), prefs as (
  select list(('0x' || substr(md5('offset ' || shard), 1, 15))::bigint % {sharding.SLOTS} order by n) as start,
         list(('0x' || substr(md5('skip ' || shard), 1, 15))::bigint % {sharding.SLOTS - 1} + 1 order by n) as skip
  from shards
), fill(turn, owner) as (
  select 0, list_transform(range({sharding.SLOTS}), lambda x: -1)
  union all
  select turn + 1, list_transform(range({sharding.SLOTS}), lambda x: case when x = slot then turn % {len(SHARDS)} else owner[x + 1] end)
  from (
    select turn, owner, (
      s + (list_position(list_transform(range({sharding.SLOTS}), lambda k: owner[(s + k * p) % {sharding.SLOTS} + 1] < 0), true) - 1) * p
    ) % {sharding.SLOTS} as slot
    from (select turn, owner, start[turn % {len(SHARDS)} + 1] as s, skip[turn % {len(SHARDS)} + 1] as p from fill, prefs where turn < {sharding.SLOTS})
  )
), slots as (
  select unnest(range({sharding.SLOTS})) as slot, unnest(owner) as n from fill where turn = {sharding.SLOTS}
), placed as (
  select doc_id, source, n_chars, ('0x' || substr(md5(doc_id::varchar), 1, 15))::bigint % {sharding.SLOTS} as slot from documents
)
select p.doc_id, p.source, p.n_chars, p.slot, s.shard
from placed p left join slots using (slot) left join shards s using (n)""",
    "op4_decontamination": f"""
with doc as (select doc_id, coalesce({_LETTERS}, []) as w from documents),
item as (select item_id, {_LETTERS} as w from benchmark),
windows as (
  select item_id, least(len(w), 10) as size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as seq
  from item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(i) where len(w) > 0
),
sizes as (select distinct size from windows),
places as (
  select doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') as seq
  from doc, sizes, unnest(range(1, len(w) - size + 2)) t(i)
),
hits as (select doc_id, i, size, item_id from places join windows using (size, seq)),
words as (select doc_id, count(distinct i + k) as n_hit from hits, unnest(range(size)) t(k) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct doc_id, item_id::varchar as item_id from hits) group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join words using (doc_id) left join items using (doc_id)""",
    "op5_substring_dedup": r"""
with doc as (select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents),
windows as (
  select doc_id, i, array_to_string(w[i : i + 19], ' ') as seq from doc, unnest(range(1, len(w) - 18)) t(i)
),
later as (
  select doc_id, i from (select doc_id, i, row_number() over (partition by seq order by doc_id, i) as n from windows) where n > 1
),
gone as (select distinct doc_id, i + k as i from later, unnest(range(20)) t(k)),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from doc),
kept as (
  select doc_id, string_agg(word, ' ' order by i) as kept, count(*) as n
  from words anti join gone using (doc_id, i) group by doc_id
)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from doc left join kept using (doc_id)""",
    "op10_jaccard_join": f"""
with recursive doc as (select doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+'), []) as w from documents),
shingles as (
  select distinct doc_id, array_to_string(w[i : i + 4], ' ') as s from doc, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i) where len(w) > 0
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as shared from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2
),
links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * shared >= 75 * (x.n + y.n - shared)
),
both_ways as (select a, b from links union all select b, a from links),
reach(a, b) as (select a, b from both_ways union select r.a, l.b from reach r join both_ways l on r.b = l.a)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, least(d.doc_id, coalesce(min(r.b), d.doc_id)) as component_id
from doc d left join sizes s using (doc_id) left join reach r on r.a = d.doc_id
group by d.doc_id, n""",
    "op11_filter_audit": r"""
with doc as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
         coalesce(min(doc_id) over (partition by coalesce(text, '')) < doc_id, false) as repeated
  from documents
),
said as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
words as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w from doc),
fails as (
  select part, doc_id, [
    len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
    regexp_matches(t, '[#$%&*|]'), repeated] as f
  from words
),
cells as (
  select part, f, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic from fails left join said using (doc_id) group by part, f
),
filters as (select unnest(['A', 'B', 'C', 'D', 'E']) as l, unnest([1, 2, 3, 4, 5]) as k),
orders as (
  select a.l || b.l || c.l || d.l || e.l as filter_order, [a.k, b.k, c.k, d.k, e.k] as ks
  from filters a, filters b, filters c, filters d, filters e
  where a.k not in (b.k, c.k, d.k, e.k) and b.k not in (c.k, d.k, e.k) and c.k not in (d.k, e.k) and d.k <> e.k
),
steps as (select filter_order, step, ks[step] as k, ks[1 : step - 1] as before from orders, range(1, 6) t(step)),
seen as (
  select part, filter_order, step, k, n, good, toxic, f[k] as fails, list_bool_or(list_transform(before, lambda b: f[b])) as gone,
         list_sum(list_transform(f, lambda x: x::int)) = 1 as sole
  from cells, steps
),
sums as (
  select part, filter_order, step, k,
         coalesce(sum(n) filter (not fails and not coalesce(gone, false)), 0)::bigint as kept,
         coalesce(sum(n) filter (fails and not coalesce(gone, false)), 0)::bigint as removed,
         coalesce(sum(n) filter (fails and coalesce(gone, false)), 0)::bigint as redundant,
         coalesce(sum(n) filter (fails and sole), 0)::bigint as unique_fails,
         coalesce(sum(good) filter (fails and not coalesce(gone, false)), 0)::bigint as good_lost,
         coalesce(sum(toxic) filter (fails and not coalesce(gone, false)), 0)::bigint as toxic_lost
  from seen group by part, filter_order, step, k
)
select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, k))::bigint as shapley
from sums""",
    "op12_conversation_repair": """
with recursive crc as (
  select list(v order by n) as t
  from (select n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v from range(256) r(n))
),
given as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         xor(list_reduce(list_prepend(4294967295, list_transform(
           string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: ord(x)::bigint)),
           lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 as roll
  from conversations, crc
),
rows as (
  select conv_id, turn, case when roll = 4 then 'user' else role end as role,
         case roll when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from given, range(2) c(k) where roll <> 0 and (k = 0 or roll = 3)
),
placed as (
  select *, row_number() over (partition by conv_id, role, text order by i) as nth,
         right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) as ending
  from (select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as i from rows)
),
faults as (
  select conv_id, i, turn, role, text, left(role, 1) as initial, lag(left(role, 1)) over (partition by conv_id order by i) as before,
         case when ending = '' then 'b' when nth > 1 then 'd' when ending not in ('.', '!', '?') then 't' else '' end as fault
  from placed
),
conv as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
         count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate, count(*) filter (fault = 't') as truncated,
         count(*) filter (before || initial not in ('su', 'ua', 'au')) as illegal,
         list(case when fault in ('b', 'd') then '-' when initial in ('s', 'u', 'a') then initial else 'x' end order by i) as codes,
         list(case when fault = 't' then 3 else 0 end order by i) as cuts,
         list({'role': role, 'text': text} order by i) as turns
  from faults group by conv_id
),
walk(conv_id, i, w0, w1, w2, w3) as (
  select conv_id, 0, {'c': 0, 'a': ''}, {'c': 1000000000, 'a': ''}, {'c': 3, 'a': 'I'}, {'c': 6, 'a': 'II'} from conv
  union all
  select conv_id, i, w0, w1, w2, list_min([w3, {'c': w2.c + 3, 'a': w2.a || 'I'}])
  from (
    select conv_id, i, w0, w1,
           list_min([w2, {'c': w0.c + 3, 'a': w0.a || 'I'}, {'c': w1.c + 3, 'a': w1.a || 'I'}, {'c': w3.c + 3, 'a': w3.a || 'I'}]) as w2, w3
    from (
      select conv_id, i + 1 as i, {'c': w0.c + 4, 'a': w0.a || 'D'} as w0,
             list_min([{'c': w1.c + 4, 'a': w1.a || 'D'}, {'c': w0.c + cut + case when x = 's' then 0 else 1000000000 end, 'a': w0.a || 'K'}]) as w1,
             list_min([{'c': w2.c + 4, 'a': w2.a || 'D'}, {'c': w0.c + asu, 'a': w0.a || eu}, {'c': w1.c + asu, 'a': w1.a || eu}, {'c': w3.c + asu, 'a': w3.a || eu}]) as w2,
             list_min([{'c': w3.c + 4, 'a': w3.a || 'D'}, {'c': w2.c + asa, 'a': w2.a || ea}]) as w3
      from (
        select w.*, codes[w.i + 1] as x, cuts[w.i + 1] as cut,
               case codes[w.i + 1] when '-' then 1000000000 when 'u' then 0 else 3 end + cuts[w.i + 1] as asu, case codes[w.i + 1] when 'u' then 'K' else 'R' end as eu,
               case codes[w.i + 1] when '-' then 1000000000 when 'a' then 0 else 3 end + cuts[w.i + 1] as asa, case codes[w.i + 1] when 'a' then 'K' else 'R' end as ea
        from walk w join conv c on w.conv_id is not distinct from c.conv_id where w.i < len(codes)
      )
    )
  )
),
ends as (
  select c.conv_id, gaps, blank, duplicate, truncated, illegal, turns, list_min([w0, w3]) as way
  from walk w join conv c on w.conv_id is not distinct from c.conv_id where w.i = len(codes)
),
repaired as (
  select *, list_reduce(string_split(way.a, ''), lambda s, e: case
      when e = 'D' then {'at': s.at + 1, 'u': s.u, 'out': s.out}
      when e = 'K' then {'at': s.at + 1, 'u': left(turns[s.at].role, 1) = 'u', 'out': list_append(s.out, turns[s.at].role || ':' || turns[s.at].text)}
      when e = 'R' then {'at': s.at + 1, 'u': not s.u, 'out': list_append(s.out, case when s.u then 'assistant' else 'user' end || ':' || turns[s.at].text)}
      else {'at': s.at, 'u': not s.u, 'out': list_append(s.out, case when s.u then 'assistant' else 'user' end || ':')} end,
    {'at': 1, 'u': false, 'out': []::varchar[]}) as s
  from ends
)
select g.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
       coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(way.c, 0)::bigint as cost,
       coalesce(way.a, '') as audit, sha256(coalesce(array_to_string(s.out, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) g left join repaired r on g.conv_id is not distinct from r.conv_id""",
}
