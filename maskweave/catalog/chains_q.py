"""Trainer chains as a user runs them: limit the corpus, learn a vocabulary to
a size or a minimum frequency, save it, load it, encode the whole corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskweave.catalog import sqlparts as Q
from maskweave.catalog.common import docs
from maskweave.catalog.encode_q import VOCAB_CTES, test_vocab
from maskweave.operators import encode as EN
from maskweave.operators import merges as M
from maskweave.operators import position as P
from maskweave.operators import vocab as V
from maskweave.operators import words as WD
from maskweave.session import scratch_path
from maskweave.sources import corpus as C
from maskweave.sources import sinks as S

QUERIES = {}
ORACLES = {}

GROWTH = 24  # pieces beyond specials and alphabet: the size at which learning stops


def q(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _learned(spark, counts, kind):
    """Learn to a vocabulary size, save, load."""
    counts = counts.cache()
    base = M.learn_merges(counts, kind, max_merges=0).release().vocab.count()
    model = M.learn_merges(counts, kind, vocab_size=base + GROWTH, max_merges=None).release()
    counts.unpersist()
    out = scratch_path(spark, f"{kind}-vocab")
    S.prepare_output_dir(spark, out)
    S.write_vocab(model.vocab, out, merges=model.merges, special_tokens=V.special_map())
    vocab, loaded = S.load_vocab(spark, out, None)
    assert loaded
    return vocab, S.read_merges(spark, out)


def _encoded(enc):
    return enc.select("doc_id", F.size("input_ids").cast("bigint").alias("n_tokens"),
                      EN.ids_string("input_ids").alias("ids"))


FIRST = "(select * from documents order by doc_id limit {n})"


@q("sp_bpe_chain", Q.bpe_encode_sql(Q.counts(Q.sp_pieces(FIRST.format(n=300))), Q.sp_doc_pieces(), "bpe", GROWTH))
def sp_bpe_chain(spark, sf):
    """B3, D7 to a size, A7, A10, E4: the first 300 raw rows train."""
    d = docs(spark, sf)
    vocab, merges = _learned(spark, WD.sp_words(P.first_rows(d, 300)), "bpe")
    return _encoded(EN.encode(d, vocab, "bpe", merges=merges))


@q("byte_bpe_chain", Q.bpe_encode_sql(Q.counts(Q.byte_words(
    "(select * from documents where text is not null and text <> '' order by doc_id limit 300)")),
    Q.byte_doc_words(), "byte", GROWTH))
def byte_bpe_chain(spark, sf):
    """D10, D9 to a size, A8, A10, E4: the first 300 non-empty rows train."""
    d = docs(spark, sf)
    train = P.first_rows(C.nonempty(d), 300)
    vocab, merges = _learned(spark, WD.byte_word_counts(train), "byte")
    return _encoded(EN.encode(d, vocab, "byte", merges=merges))


@q("wordpiece_chain", f"""{Q.vocab_with_merges_sql(Q.counts(Q.wp_words(FIRST.format(n=300))), 'wordpiece', GROWTH)}
select id, piece, role from vocab""")
def wordpiece_chain(spark, sf):
    """B4, D6 to a size, A8, A10: whole batches of 100 up to 250 rows."""
    train = P.first_rows(docs(spark, sf), P.rounded_limit(250, 100))
    vocab, _ = _learned(spark, WD.wordpiece_words(train), "wordpiece")
    return vocab.select("id", "piece", "role")


SHARE = 40  # a merge must occur once in so many words of the corpus
ROUNDS = 60  # of the SQL; learning ends long before

_STOP_COUNTS = Q.counts(Q.wp_words())
_STOP = f"(select greatest(2, sum(n) // {SHARE}) from {_STOP_COUNTS})"


@q("min_frequency_stop", Q.merge_rounds_sql(_STOP_COUNTS, "wordpiece", ROUNDS, _STOP) + "\nselect * from ("
   + " union all ".join(f"select {k} as rank, l as \"left\", r as \"right\", merged, n from m{k}"
                        for k in range(1, ROUNDS + 1)) + ")")
def min_frequency_stop(spark, sf):
    """Learning stops when the best pair is rarer than the minimum, which
    is a share of the corpus; nothing else ends it."""
    counts = WD.wordpiece_words(docs(spark, sf)).cache()
    least = max(2, counts.agg(F.sum("n")).first()[0] // SHARE)
    model = M.learn_merges(counts, "wordpiece", vocab_size=None, min_pair_n=least).release()
    counts.unpersist()
    return model.merges.select("rank", "left", "right", "merged", "n")


def _whole(spark, sf, words, kind):
    """D12 at the default size: 32,768 pieces (fewer where no pair is left
    that occurs twice), saved, loaded, the whole corpus encoded."""
    d = docs(spark, sf)
    model = M.learn_merges(words(d), kind).release()
    out = scratch_path(spark, f"{kind}-vocab")
    S.write_vocab(model.vocab, out, merges=model.merges, special_tokens=V.special_map())
    vocab, loaded = S.load_vocab(spark, out, None)
    assert loaded
    return _encoded(EN.encode(d, vocab, kind, merges=S.read_merges(spark, out)))


@q("wordpiece_full")
def wordpiece_full(spark, sf):
    """D6, A8, A10, E2 with a vocabulary of the default size."""
    return _whole(spark, sf, WD.wordpiece_words, "wordpiece")


@q("sp_bpe_full")
def sp_bpe_full(spark, sf):
    """D7, A7, A10, E4 with a vocabulary of the default size."""
    return _whole(spark, sf, WD.sp_words, "bpe")


@q("byte_bpe_full")
def byte_bpe_full(spark, sf):
    """D9, A8, A10, E4 with a vocabulary of the default size."""
    return _whole(spark, sf, WD.byte_word_counts, "byte")


@q("byte_roundtrip", "select doc_id, text from documents where text is not null")
def byte_roundtrip(spark, sf):
    """Every document's text again from its byte-level ids."""
    d = docs(spark, sf)
    model = M.learn_merges(WD.byte_word_counts(d), "byte", max_merges=10).release()
    enc = EN.encode(d.where("text is not null"), model.vocab, "byte", merges=model.merges)
    return EN.decode_bytes(enc, model.vocab).select("doc_id", "text")


def _saved(spark, sf):
    out = scratch_path(spark, "vocab")
    S.prepare_output_dir(spark, out)
    S.write_vocab(test_vocab(spark, sf), out, special_tokens=V.special_map())
    return out


@q("vocab_text_roundtrip", f"""with {VOCAB_CTES},
n as (select max(id) as base from base)
select piece, (case when role is not null or id <= base then 0.0 else -id end)::double as score from vocab, n""")
def vocab_text_roundtrip(spark, sf):
    """Piece and score from the text file."""
    return S.read_vocab_text(spark, _saved(spark, sf))


@q("special_tokens_roundtrip", "select * from (values ('unk_token', '[UNK]'), ('sep_token', '[SEP]'), "
   "('pad_token', '[PAD]'), ('cls_token', '[CLS]'), ('mask_token', '[MASK]')) as t(role, token)")
def special_tokens_roundtrip(spark, sf):
    """The special-token map from its JSON file."""
    got = S.read_special_tokens(spark, _saved(spark, sf))
    return spark.createDataFrame(sorted(got.items()), "role string, token string")


@q("corrupt_vocab_fallback", f"with {VOCAB_CTES} select id, piece, role from vocab")
def corrupt_vocab_fallback(spark, sf):
    """A10: a folder that holds no vocabulary gives the default."""
    out = scratch_path(spark, "corrupt-vocab")
    spark.createDataFrame([("not a vocabulary",)], "value string").write.text(f"{out}/vocab")
    vocab, loaded = S.load_vocab(spark, out, test_vocab(spark, sf))
    assert not loaded
    return vocab.select("id", "piece", "role")
