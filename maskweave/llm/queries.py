"""Registered queries of the numbered operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskweave.llm import (
    bpe, brown, decontaminate, exact_dedup, fill_middle, html_extract, language_id, licenses, near_dedup, prefix_trie,
    suffix_dedup, vector_dedup, warc,
)
from maskweave.llm.common import table
from maskweave.session import prepare


def op1_html_extraction(spark, sf):
    """The main text of every page."""
    return html_extract.extract(table(spark, sf, "pages"))


def op2_lm_scoring(spark, sf):
    """Brown-class and unigram scores of every document, learned from the
    rows of a remainder other than 0."""
    docs = table(spark, sf, "documents")
    return brown.train_and_score(docs, remainder(10) != 0)


def op5_exact_dedup(spark, sf):
    """The group of every document, by a digest index that starts empty."""
    return exact_dedup.classify(table(spark, sf, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP5_SQL = """
select doc_id, max(doc_id) over (partition by coalesce(text, '')) as keep_id,
       count(*) over (partition by coalesce(text, '')) as group_size,
       doc_id = max(doc_id) over (partition by coalesce(text, '')) as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents
"""


def op9_near_dedup(spark, sf):
    """The near-duplicate group of every document: 4-word shingles, 80 %."""
    return near_dedup.near_groups(table(spark, sf, "documents"), size=4, percent=80)


OP9_SQL = r"""
with recursive words as materialized (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents),
shingle as materialized (
  select distinct doc_id, unnest(case when len(w) = 0 then []
    when len(w) < 4 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as s
  from words),
size as materialized (select doc_id, count(*) as n from shingle group by doc_id),
inter as (
  select a.doc_id as x, b.doc_id as y, count(*) as i
  from shingle a join shingle b on a.s = b.s and a.doc_id < b.doc_id group by all),
link as materialized (
  select x, y from inter join size p on p.doc_id = x join size q on q.doc_id = y
  where 100 * i >= 80 * (p.n + q.n - i)),
both_ways as materialized (select x, y from link union all select y, x from link),
reach(doc_id, r) as (
  select doc_id, doc_id from words
  union
  select b.y, reach.r from reach join both_ways b on b.x = reach.doc_id)
select w.doc_id, coalesce(any_value(n), 0)::bigint as n_shingles,
       min(r) as component_id, w.doc_id = min(r) as kept
from words w join reach using (doc_id) left join size using (doc_id)
group by w.doc_id
"""

def remainder(n: int):
    """crc32 of doc_id as text, modulo n; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op3_license_scan(spark, sf):
    """The licences that documents state or contain, with their spans."""
    return licenses.scan(table(spark, sf, "documents"))


def op4_byte_bpe(spark, sf):
    """Digests of the ids of every document and of their decoded bytes."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(table(spark, sf, "documents"), path, public_tokenizers.PATTERN).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_suffix_dedup(spark, sf):
    """What is left of every document without 50-byte strings that a document
    with a smaller doc_id has."""
    return suffix_dedup.report(table(spark, sf, "documents"))


OP6_SQL = """
with h as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as materialized (
  select doc_id, s, substr(h, 2 * s + 1, 100) as w
  from (select doc_id, h, unnest(range(0, greatest(length(h) // 2 - 49, 0))) as s from h)),
low as (select w, min(doc_id) as least from w group by w),
hit as (select doc_id, s from w join low using (w) where least < doc_id),
marked as (
  select doc_id, s, case when s <= lag(s) over (partition by doc_id order by s) + 50 then 0 else 1 end as opens
  from hit),
numbered as (select doc_id, s, sum(opens) over (partition by doc_id order by s) as k from marked),
span as (select doc_id, k, min(s) as a, max(s) + 50 as z from numbered group by doc_id, k),
gap as (
  select doc_id, a, z, coalesce(lag(z) over (partition by doc_id order by a), 0) as from_, 0 as last from span
  union all
  select doc_id, null, null, coalesce(max(z), 0), 1 from (select doc_id from h) left join span using (doc_id)
  group by doc_id),
left_ as (
  select doc_id, count(a) as n_spans, coalesce(sum(z - a), 0) as n_removed,
         string_agg(substr(h, 2 * from_ + 1, 2 * (coalesce(a, length(h) // 2) - from_)), '' order by from_, last) as kept
  from gap join h using (doc_id) group by doc_id)
select doc_id, (length(h) // 2)::bigint as n_bytes, n_removed::bigint as n_removed, n_spans::bigint as n_spans,
       sha256(unhex(kept)) as kept_sha256
from left_ join h using (doc_id)
"""


def op7_warc(spark, sf):
    """Every page written to WARC archives and read back."""
    return warc.round_trip(table(spark, sf, "pages")).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


OP7_SQL = """
with d as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as hex from pages),
g as (select *, min(page_id) over (partition by hex) as first from d)
select page_id, payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda k:
    array_to_string(list_transform(range(0, 4), lambda j:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             1 + (((('0x' || substr(hex, 5 * k + 1, 5))::bigint) >> (15 - 5 * j)) & 31)::int, 1)), '')), '')
    as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id != first then first end as refers_to
from g
"""


def op8_decontamination(spark, sf):
    """Every document that aligns with a test item, with that item."""
    return decontaminate.matches(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op10_language_id(spark, sf):
    """The language of every document, learned from the rows of remainder 0 and 2."""
    docs = table(spark, sf, "documents")
    model = language_id.fit(docs.where(remainder(3) != 1))
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")


def op11_embedding_dedup(spark, sf):
    """The links and the group of every vector at a cosine of 0.95 or more."""
    return vector_dedup.groups(table(spark, sf, "embeddings"), threshold=0.95)


OP11_SQL = """
with recursive v as materialized (select vec_id, embedding::double[] as e from embeddings),
ok as materialized (
  select vec_id, e from v where e is not null and len(e) > 0
    and list_sum(list_transform(e, lambda x: case when x is null or not isfinite(x) then 1 else 0 end)) = 0
    and list_max(list_transform(e, lambda x: abs(x))) > 0),
link as materialized (
  select a.vec_id as x, b.vec_id as y from ok a join ok b on a.vec_id != b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.95),
reach(vec_id, r) as (
  select vec_id, vec_id from v
  union
  select l.y, reach.r from reach join link l on l.x = reach.vec_id),
low as (select vec_id, min(r) as component_id from reach group by vec_id),
n as (select x, count(*) as n from link group by x)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from v join low using (vec_id) left join n on x = vec_id
"""


def op12_conversation_trie(spark, sf):
    """The nodes of the prefix trie of the rebuilt conversations."""
    return prefix_trie.conversation_trie(table(spark, sf, "conversations"), every=20, most=4)


OP12_SQL = r"""
with o as materialized (
  select conv_id, x.d, len(regexp_extract_all(x.text, '[^\x20\x09-\x0D]+')) as w,
         row_number() over (partition by conv_id order by turn nulls first, x.d) as i
  from (select conv_id, turn, {'text': coalesce(text, ''), 'd':
          md5(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))} as x
        from conversations where conv_id is not null)),
c as materialized (
  select conv_id, xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(
    string_split(conv_id::varchar, ''), lambda ch: [ascii(ch)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda s, x: case when x >= 0 then xor(s, x) else xor(s >> 1, (s & 1) * 3988292384) end), 4294967295) % 4 as h
  from (select distinct conv_id from o)),
built as materialized (
  select conv_id, list(d order by part, i) as p, list(w order by part, i) as w from (
    select c.conv_id, 0 as part, i, d, w from c join o on o.conv_id = c.conv_id - c.conv_id % 20 and i <= h
    union all
    select c.conv_id, 1, i, d, w from c join o on o.conv_id = c.conv_id and i > h)
  group by conv_id
  union all
  select conv_id, [], [] from c where not exists (
    select 1 from o where (o.conv_id = c.conv_id - c.conv_id % 20 and i <= h) or (o.conv_id = c.conv_id and i > h))),
member as (select conv_id, p[1:depth] as p, depth, w[depth] as w, len(p) = depth as at_end
           from (select *, unnest(range(0, len(p) + 1)) as depth from built)),
node as materialized (
  select p, depth, min(conv_id) as conv_id, count(*) as n, coalesce(any_value(w), 0) as w,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (at_end), '')) as ends_sha256
  from member group by p, depth),
child as materialized (select p[1:depth - 1] as p, count(*) as n from node where depth > 0 group by 1),
below as (
  select p[1:k] as p, count(*) filter (not has) as leaves, sum((n - 1) * w) as saved from (
    select node.*, child.n is not null as has, unnest(range(0, depth + 1)) as k from node left join child using (p))
  group by 1)
select node.conv_id, node.depth, up.conv_id as parent_conv_id, node.n as n_convs,
       coalesce(child.n, 0) as n_children, leaves as n_leaves, saved::bigint as saved_tokens, node.ends_sha256
from node join below using (p) left join child using (p)
left join node up on node.depth > 0 and up.p = node.p[1:node.depth - 1]
"""


def op13_fill_in_middle(spark, sf):
    """Every document arranged for fill-in-middle, and its text again."""
    out = fill_middle.transform(table(spark, sf, "documents"), separator="\n", rate=100, spm=50, seed=7)
    return fill_middle.restore(out).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


OP13_SQL = r"""
with t as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as u,
         sha256('7:' || coalesce(doc_id::varchar, '')) as d
  from documents),
h as (
  select *, len(u) as n, ('0x' || substr(d, 1, 8))::bigint as h1, ('0x' || substr(d, 9, 8))::bigint as h2,
         ('0x' || substr(d, 17, 8))::bigint as h3, ('0x' || substr(d, 25, 8))::bigint as h4 from t),
cut as (
  select doc_id, text, n, array_to_string(u[1:least(h1 % (n + 1), h2 % (n + 1))], '') as p,
         array_to_string(u[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') as m,
         array_to_string(u[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') as s,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                or h3 % 100 >= 100 then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end as form
  from h)
select doc_id, n::bigint as n, form, case when form != 'plain' then length(p) end as prefix_chars,
       case when form != 'plain' then length(m) end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
              else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(text) as restored_sha256
from cut
"""


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_lm_scoring, op3_license_scan, op4_byte_bpe, op5_exact_dedup, op6_suffix_dedup, op7_warc,
    op8_decontamination, op9_near_dedup, op10_language_id, op11_embedding_dedup, op12_conversation_trie,
    op13_fill_in_middle)}
ORACLES = {"op5_exact_dedup": OP5_SQL, "op6_suffix_dedup": OP6_SQL, "op7_warc": OP7_SQL, "op9_near_dedup": OP9_SQL,
           "op11_embedding_dedup": OP11_SQL, "op12_conversation_trie": OP12_SQL, "op13_fill_in_middle": OP13_SQL}


def _prepared(fn):
    """The session gets its checkpoint folder and this package on its workers."""
    def run(spark, sf_dir):
        prepare(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def queries():
    return {k: _prepared(v) for k, v in QUERIES.items()}


def oracles():
    return dict(ORACLES)
