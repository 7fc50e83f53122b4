"""Step 5 queries: encoding, special masks, pad guarantee, embedding
resize, vocabulary fallback."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskweave.catalog import sqlparts as Q
from maskweave.catalog.common import docs
from maskweave.operators import encode as EN
from maskweave.operators import merges as M
from maskweave.operators import vocab as V
from maskweave.operators import words as WD
from maskweave.sources import corpus as C
from maskweave.sources import sinks as S
from maskweave.session import scratch_path

QUERIES = {}
ORACLES = {}

WP_COUNTS = Q.counts(Q.wp_words())


def q(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def test_vocab(spark, sf):
    """FIXTURES vocab_sql: specials, alphabet, '##' forms, top 500 words."""
    return M.word_vocab(WD.wordpiece_words(docs(spark, sf)), 500)


VOCAB_CTES = f"""base as (select * from {Q.base_vocab_sql(WP_COUNTS, 'wordpiece')}),
topw as (select word as piece, n from {WP_COUNTS} order by n desc, word limit 500),
vocab as (select id, piece, role from base
          union all
          select (select max(id) from base) + row_number() over (order by n desc, piece) as id, piece, null as role
            from topw where piece not in (select piece from base))"""


def greedy_ctes(src: str, key: str) -> str:
    """Greedy longest-match WordPiece over the word types of ``src``."""
    return f"""dw as (select {key}, unnest(l) as word, generate_subscripts(l, 1) as i
         from (select {key}, {Q.wp_word_list('text')} as l from {src})),
wt as (select distinct word from dw),
cand as (select word, st, unnest(range(1, least(length(word) - st, 100) + 1)) as len
           from (select word, unnest(range(0, length(word))) as st from wt where length(word) <= 100)),
best as (select c.word, c.st, max(c.len) as len from cand c join vocab v
           on v.piece = (case when c.st = 0 then '' else '{Q.CONT}' end) || substr(c.word, c.st + 1, c.len)
          group by c.word, c.st),
chain(word, st, k) as (select word, 0, 0 from wt where length(word) <= 100
                       union all
                       select c.word, c.st + b.len, c.k + 1 from chain c join best b on b.word = c.word and b.st = c.st),
done as (select distinct word from chain where st = length(word)),
toks as (select c.word, c.k, v.id from chain c join best b on b.word = c.word and b.st = c.st
           join vocab v on v.piece = (case when c.st = 0 then '' else '{Q.CONT}' end) || substr(c.word, c.st + 1, b.len)
          where c.word in (select word from done)),
wids as (select wt.word,
                coalesce((select string_agg(cast(id as varchar), ' ' order by k) from toks where toks.word = wt.word), '0') as ids,
                coalesce((select count(*) from toks where toks.word = wt.word), 1) as n
           from wt),
wtok as (select wt.word, coalesce(t.k, 0) as k, coalesce(t.id, 0) as id from wt left join toks t on t.word = wt.word),
dtok as (select d.{key}, row_number() over (partition by d.{key} order by d.i, w.k) - 1 as t_idx, w.id
           from dw d join wtok w on w.word = d.word),
enc as (select s.{key}, cast(coalesce(sum(w.n), 0) as bigint) as n_tokens,
               coalesce(string_agg(w.ids, ' ' order by d.i), '') as ids
          from {src} s left join dw d on d.{key} = s.{key} left join wids w on w.word = d.word
         group by s.{key})"""


@q("wordpiece_encode", f"""with recursive {VOCAB_CTES},
{greedy_ctes('documents', 'doc_id')}
select doc_id, n_tokens, ids from enc""")
def wordpiece_encode(spark, sf):
    enc = EN.encode(docs(spark, sf), test_vocab(spark, sf), "wordpiece")
    return enc.select("doc_id", F.size("input_ids").cast("bigint").alias("n_tokens"),
                      EN.ids_string("input_ids").alias("ids"))


@q("special_mask", f"""with recursive {VOCAB_CTES},
{greedy_ctes('benchmark', 'item_id')}
select item_id, n_tokens + 2 as n_tokens,
       cast(2 + len(list_filter(string_split(ids, ' '), lambda x: x <> '' and cast(x as bigint) < 5)) as bigint) as n_special,
       trim('3 ' || ids || ' 1') as ids
  from enc""")
def special_mask(spark, sf):
    b = C.read_table(spark, sf, "benchmark")
    enc = EN.encode(b, test_vocab(spark, sf), "wordpiece", keys=("item_id",), frame=True)
    return enc.select("item_id", F.size("input_ids").cast("bigint").alias("n_tokens"),
                      F.aggregate("special_tokens_mask", F.lit(0).cast("bigint"), lambda a, x: a + x)
                       .alias("n_special"),
                      EN.ids_string("input_ids").alias("ids"))


@q("ensure_pad", f"""with {VOCAB_CTES.split(',' + chr(10) + 'topw')[0]}
select id, piece, role from base where role is null
union all
select (select max(id) + 1 from base), '[PAD]', 'pad'""")
def ensure_pad(spark, sf):
    wc = WD.wordpiece_words(docs(spark, sf))
    plain = M.learn_merges(wc, "wordpiece", max_merges=0).release().vocab.filter(F.col("role").isNull())
    v, resized = V.ensure_pad(plain)
    assert resized
    return v.select("id", "piece", "role")


@q("resize_embeddings", f"""with {VOCAB_CTES},
old as (select vec_id as id, embedding from embeddings),
dims as (select d, cast(avg(x) as float) as x
           from (select unnest(embedding) as x, generate_subscripts(embedding, 1) as d from embeddings) group by d),
mean as (select list(x order by d) as m from dims)
select v.id, cast(len(coalesce(o.embedding, m.m)) as bigint) as dim,
       round(cast(coalesce(o.embedding, m.m)[1] as double), 6) as first_x,
       round(cast(coalesce(o.embedding, m.m)[-1] as double), 6) as last_x
  from vocab v left join old o on o.id = v.id cross join mean m""")
def resize_embeddings(spark, sf):
    old = C.read_table(spark, sf, "embeddings")
    r = EN.resize_embeddings(test_vocab(spark, sf), old)
    e = F.col("embedding")
    return r.select("id", F.size(e).cast("bigint").alias("dim"),
                    F.round(e[0].cast("double"), 6).alias("first_x"),
                    F.round(F.element_at(e, -1).cast("double"), 6).alias("last_x"))


@q("load_vocab_fallback", f"with {VOCAB_CTES} select id, piece, role from vocab")
def load_vocab_fallback(spark, sf):
    missing = scratch_path(spark, "no-such-vocab")
    v, loaded = S.load_vocab(spark, missing, test_vocab(spark, sf))
    assert not loaded
    return v.select("id", "piece", "role")


@q("vocab_roundtrip", f"with {VOCAB_CTES} select id, piece, role from vocab")
def vocab_roundtrip(spark, sf):
    out = scratch_path(spark, "vocab")
    S.prepare_output_dir(spark, out, overwrite=False)
    S.write_vocab(test_vocab(spark, sf), out, special_tokens=V.special_map())
    v, loaded = S.load_vocab(spark, out, None)
    assert loaded
    return v.select("id", "piece", "role")
