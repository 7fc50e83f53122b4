"""Step 8 queries: unigram seed (exact SQL), unigram vocabulary and
Viterbi encoding (rows-only; checked against brute force in tests)."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskweave.catalog import sqlparts as Q
from maskweave.catalog.common import docs
from maskweave.operators import encode as EN
from maskweave.operators import unigram as U
from maskweave.operators import words as WD

QUERIES = {}
ORACLES = {}

SP_COUNTS = Q.counts(Q.sp_pieces())
SEED_TOP = 5000


def q(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@q("unigram_seed", f"""with w as (select word, n from {SP_COUNTS}),
s as (select n, substr(word, st + 1, len) as piece
        from (select word, n, st, unnest(range(1, least(16, length(word) - st) + 1)) as len
                from (select word, n, unnest(range(0, length(word))) as st from w)))
select piece, cast(sum(n) as bigint) as freq, cast(sum(n) * length(piece) as bigint) as score
  from s group by piece order by score desc, piece limit {SEED_TOP}""")
def unigram_seed(spark, sf):
    seed = U.seed_pieces(WD.sp_words(docs(spark, sf)))
    return seed.orderBy(F.desc("score"), "piece").limit(SEED_TOP)


def unigram_model(spark, sf):
    return U.train_unigram(WD.sp_words(docs(spark, sf)), vocab_size=600, seed_size=4000)


BEST = 2000  # seeds of the queries below, besides all characters

_SEEDS = f"""w as materialized (select word, n from {SP_COUNTS} where length(word) > 0),
sub as (select n, substr(word, st + 1, len) as piece
          from (select word, n, st, unnest(range(1, least(16, length(word) - st) + 1)) as len
                  from (select word, n, unnest(range(0, length(word))) as st from w))),
freq as materialized (select piece, sum(n)::double as f from sub group by piece),
best as (select piece, f from (select * from freq where length(piece) > 1
           order by f * length(piece) desc, piece limit {BEST})
         union all select piece, f from freq where length(piece) = 1),
model as materialized (select piece, {{score}} as lp from best, (select sum(f) as total from best))"""

# edges of each word's lattice, by where they end and by where they begin
_LATTICE = """edge as materialized (
  select x.word, st, st + len as en, lp from (
    select word, st, unnest(range(1, least(16, length(word) - st) + 1)) as len
      from (select word, unnest(range(0, length(word))) as st from w)) x
  join model on piece = substr(x.word, st + 1, len)),
into_ as (select word, en, list({'s': st, 'v': lp} order by st) as x from edge group by word, en),
forward as (select word, list(x order by en) as xs from into_ group by word)"""


def _lse(values: str) -> str:
    return f"(list_max({values}) + ln(list_sum(list_transform({values}, lambda z: exp(z - list_max({values}))))))"


def _sums(xs: str) -> str:
    """Log sums over the paths up to each position: {{s: position, v: sum}}."""
    values = "list_transform(x, lambda t: t.v + a[t.s + 1].v)"
    return (f"list_reduce(list_concat([[{{'s': 0::bigint, 'v': 0.0::double}}]], {xs}), "
            f"lambda a, x: list_append(a, {{'s': len(a)::bigint, 'v': {_lse(values)}}}))")


@q("unigram_em_step", f"""with {_SEEDS.replace('{score}', 'ln(f / total)')}, {_LATTICE},
outof as (select word, st, list({{'s': length(word) - en, 'v': lp}} order by en) as x from edge group by word, st),
backward as (select word, list(x order by st desc) as xs from outof group by word),
sums as materialized (select word, {_sums('forward.xs')} as a, {_sums('backward.xs')} as b
  from forward join backward using (word))
select substr(e.word, st + 1, en - st) as piece,
       round(sum(n * exp(a[st + 1].v + lp + b[length(e.word) - en + 1].v - a[length(e.word) + 1].v)), 3) as c
  from edge e join sums s on s.word = e.word join w on w.word = e.word group by 1
having sum(n * exp(a[st + 1].v + lp + b[length(e.word) - en + 1].v - a[length(e.word) + 1].v)) >= 0.5""")
def unigram_em_step(spark, sf):
    """Expected counts of one E-step from the seeds."""
    words = WD.sp_words(docs(spark, sf)).where(F.length("word") > 0).cache()
    counts, _ = U.expected_counts(words, U.initial_model(words, BEST))
    words.unpersist()
    return counts.where("c >= 0.5").select("piece", F.round("c", 3).alias("c"))


@q("unigram_best_path", f"""with recursive {_SEEDS.replace('{score}', 'round(ln(f / total), 6)')}, {_LATTICE},
best_path as materialized (select word, list_reduce(list_concat([[{{'s': 0::bigint, 'v': 0.0::double}}]], xs),
  lambda a, x: list_append(a, list_reduce(list_transform(x, lambda t: {{'s': t.s, 'v': a[t.s + 1].v + t.v}}),
    lambda p, q: case when q.v > p.v then q else p end))) as b from forward),
path(word, en, st, back) as (
  select word, length(word), b[length(word) + 1].s, 0 from best_path
  union all
  select p.word, p.st, b[p.st + 1].s, back + 1 from path p join best_path using (word) where p.st > 0),
ids as (select piece, 3 + row_number() over (order by lp desc, piece) as id from model),
wtok as materialized (select word, back, id from path join ids on piece = substr(word, st + 1, en - st)),
dtok as (select d.doc_id, d.i, d.k, t.back, t.id from {Q.sp_doc_pieces()} d join wtok t on t.word = d.word)
select s.doc_id, count(t.id) as n_tokens,
       coalesce(string_agg(t.id::varchar, ' ' order by t.i, t.k, t.back desc), '') as ids
  from documents s left join dtok t using (doc_id) group by s.doc_id""")
def unigram_best_path(spark, sf):
    """The best segmentation of every document under the seeds."""
    d = docs(spark, sf)
    model = U.initial_model(WD.sp_words(d), BEST)
    vocab = U.to_vocab(model.withColumn("lp", F.round("lp", 6)))
    return _ids(EN.encode(d, vocab, "unigram"))


def _ids(enc):
    return enc.select("doc_id", F.size("input_ids").cast("bigint").alias("n_tokens"),
                      EN.ids_string("input_ids").alias("ids"))


@q("unigram_vocab")
def unigram_vocab(spark, sf):
    v = unigram_model(spark, sf).vocab
    return v.select("id", "piece", F.round("score", 6).alias("score"), "role")


@q("unigram_encode")
def unigram_encode(spark, sf):
    d = docs(spark, sf)
    return _ids(EN.encode(d, unigram_model(spark, sf).vocab, "unigram"))


@q("unigram_full")
def unigram_full(spark, sf):
    """D8, D12, E3 at the default sizes: 32,768 pieces from 1,000,000 seeds
    (fewer where the corpus has fewer substrings), then the whole corpus."""
    d = docs(spark, sf)
    return _ids(EN.encode(d, U.train_unigram(WD.sp_words(d)).vocab, "unigram"))
