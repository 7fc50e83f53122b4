"""Step 4 queries: pair counts and merge learning (WordPiece, SentencePiece
BPE, byte-level BPE) and the vocabularies they produce."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskweave.catalog import sqlparts as Q
from maskweave.catalog.common import docs
from maskweave.operators import encode as EN
from maskweave.operators import merges as M
from maskweave.operators import vocab as V
from maskweave.operators import words as WD

QUERIES = {}
ORACLES = {}

WP_COUNTS = Q.counts(Q.wp_words())
SP_COUNTS = Q.counts(Q.sp_pieces())
BYTE_COUNTS = Q.counts(Q.byte_words())


def q(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _merges(model):
    return model.merges.select("rank", "left", "right", "merged", "n")


@q("pair_counts", f"""with w0 as (select {Q.symbol_sql('wordpiece')} as sy, n from {WP_COUNTS})
select l as "left", r as "right", n from {Q.pairs_sql('w0')}""")
def pair_counts(spark, sf):
    wc = WD.wordpiece_words(docs(spark, sf))
    return M.pair_counts(M.word_table(wc, "wordpiece"))


@q("wordpiece_merges", Q.merges_sql(WP_COUNTS, "wordpiece", 5))
def wordpiece_merges(spark, sf):
    wc = WD.wordpiece_words(docs(spark, sf))
    return _merges(M.learn_merges(wc, "wordpiece", max_merges=5).release())


@q("wordpiece_merges_batched", Q.merges_sql(WP_COUNTS, "wordpiece", 40))
def wordpiece_merges_batched(spark, sf):
    wc = WD.wordpiece_words(docs(spark, sf))
    return _merges(M.learn_merges(wc, "wordpiece", max_merges=40, per_round=16).release())


@q("sp_bpe_merges", Q.merges_sql(SP_COUNTS, "bpe", 5))
def sp_bpe_merges(spark, sf):
    wc = WD.sp_words(docs(spark, sf))
    return _merges(M.learn_merges(wc, "bpe", max_merges=5).release())


@q("byte_bpe_merges", Q.merges_sql(BYTE_COUNTS, "byte", 5))
def byte_bpe_merges(spark, sf):
    wc = WD.byte_word_counts(docs(spark, sf))
    return _merges(M.learn_merges(wc, "byte", max_merges=5).release())


def _vocab_sql(counts_sql, kind, rounds):
    ctes = Q.merge_rounds_sql(counts_sql, kind, rounds)
    union = "\nunion all ".join(f"select {k} as rank, merged from m{k}" for k in range(1, rounds + 1))
    return f"""{ctes},
base as (select * from {Q.base_vocab_sql(counts_sql, kind)}),
learned as (select merged as piece, min(rank) as rank from ({union})
             where merged not in (select piece from base) group by merged)
select id, piece, role from base
union all
select (select max(id) from base) + row_number() over (order by rank) as id, piece, null as role from learned"""


@q("wordpiece_vocab", _vocab_sql(WP_COUNTS, "wordpiece", 40))
def wordpiece_vocab(spark, sf):
    wc = WD.wordpiece_words(docs(spark, sf))
    return M.learn_merges(wc, "wordpiece", max_merges=40).release().vocab.select("id", "piece", "role")


@q("vocab_special_ids", f"""select id, piece, role from ({_vocab_sql(WP_COUNTS, 'wordpiece', 5)})
 where role is not null""")
def vocab_special_ids(spark, sf):
    wc = WD.wordpiece_words(docs(spark, sf))
    v = M.learn_merges(wc, "wordpiece", max_merges=5).release().vocab
    return v.filter(F.col("role").isNotNull()).select("id", "piece", "role")


def _encoded(enc):
    return enc.select("doc_id", F.size("input_ids").cast("bigint").alias("n_tokens"),
                      EN.ids_string("input_ids").alias("ids"))


@q("sp_bpe_encode", Q.bpe_encode_sql(SP_COUNTS, Q.sp_doc_pieces(), "bpe", 40))
def sp_bpe_encode(spark, sf):
    d = docs(spark, sf)
    model = M.learn_merges(WD.sp_words(d), "bpe", max_merges=40).release()
    return _encoded(EN.encode(d, model.vocab, "bpe", merges=model.merges))


@q("byte_bpe_encode", Q.bpe_encode_sql(BYTE_COUNTS, Q.byte_doc_words(), "byte", 40))
def byte_bpe_encode(spark, sf):
    d = docs(spark, sf)
    model = M.learn_merges(WD.byte_word_counts(d), "byte", max_merges=40).release()
    return _encoded(EN.encode(d, model.vocab, "byte", merges=model.merges))


@q("sp_vocab_roles", f"""{Q.vocab_with_merges_sql(SP_COUNTS, 'bpe', 5)}
select id, piece, role from vocab where role is not null
union all
select (select max(id) from vocab) + row_number() over (order by o) as id, piece, role
  from (values (1, '[SEP]', 'sep'), (2, '[CLS]', 'cls'), (3, '[MASK]', 'mask')) as t(o, piece, role)""")
def sp_vocab_roles(spark, sf):
    model = M.learn_merges(WD.sp_words(docs(spark, sf)), "bpe", max_merges=5).release()
    v = V.to_encoder_vocab(model.vocab)
    return v.filter(F.col("role").isNotNull()).select("id", "piece", "role")
