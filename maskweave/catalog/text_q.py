"""Step 2 queries: normalisation, pre-tokenisation, word counts, alphabet."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskweave.catalog import sqlparts as Q
from maskweave.catalog.common import docs
from maskweave.functions import text as TX
from maskweave.operators import merges as M
from maskweave.operators import words as WD

QUERIES = {}
ORACLES = {}


def q(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@q("normalize_nfkc_cf", """select doc_id,
  translate(replace(lower(text), 'ß', 'ss'), chr(9) || chr(10) || chr(13), '   ') as norm from documents""")
def normalize_nfkc_cf(spark, sf):
    return docs(spark, sf).select("doc_id", TX.nfkc_casefold("text").alias("norm"))


# Text that normalisation and word splitting treat specially, the result of
# each spelled out: (text, normalised, words, byte-level words).
EDGES = [
    ("\ufb01n \uff21\uff22\uff23", "fin abc", "\ufb01n|\uff21\uff22\uff23", "\ufb01n| \uff21\uff22\uff23"),
    ("a\u200bb\x07c", "a bc", "a|\u200b|b|\x07|c", "a|\u200b|b|\x07|c"),
    ("x\u2028y\u1680z", "x y z", "x|y|z", "x|\u2028|y|\u1680|z"),
    ("Stra\xdfe \xa0 \xbd", "strasse 1\u20442", "Stra\xdfe|\xbd", "Stra\xdfe| \xa0| \xbd"),
    ("\ufeffTop\u2581mark", "top mark", "\ufeff|Top|\u2581|mark", "\ufeff|Top|\u2581|mark"),
    ("e\u0301 x\xb2y_z", "\xe9 x2y_z", "e\u0301|x|\xb2|y_z", "e|\u0301| x|\xb2|y|_|z"),
    ("\t don't\r\n  we'll  ", "don't we'll", "don|'|t|we|'|ll", "\t| don|'t|\r\n | we|'ll|  "),
    ("q\ue000\ue001 a\u203fb 12", "q\ue000\ue001 a\u203fb 12", "q|\ue000\ue001|a\u203fb|12",
     "q|\ue000\ue001| a|\u203f|b| 12"),
]


def _edge(k):
    return F.element_at(F.array(*[F.lit(e[k]) for e in EDGES]), (F.col("doc_id") % len(EDGES) + 1).cast("int"))


def _edge_sql(k):
    def text(t):
        return " || ".join(f"chr({ord(c)})" if c in "'|" or not " " <= c <= "~" else f"'{c}'" for c in t)

    return f"([{', '.join(text(e[k]) for e in EDGES)}])[doc_id % {len(EDGES)} + 1]"


@q("normalize_edges", f"select doc_id, {_edge_sql(1)} || ' ' || replace(lower(text), chr(10), ' ') as norm from documents"
   .replace("lower(text)", "trim(regexp_replace(replace(lower(text), '\xdf', 'ss'), '\\s+', ' ', 'g'))"))
def normalize_edges(spark, sf):
    joined = F.concat(_edge(0), F.lit(" \u3000 "), F.col("text"))
    return docs(spark, sf).select("doc_id", TX.sp_normalize(joined).alias("norm"))


@q("word_edges", f"select doc_id, {_edge_sql(2)} as words, {_edge_sql(3)} as byte_words from documents")
def word_edges(spark, sf):
    return docs(spark, sf).select("doc_id", F.array_join(TX.whitespace_words(_edge(0)), "|").alias("words"),
                                  F.array_join(TX.byte_words(_edge(0)), "|").alias("byte_words"))


@q("remove_extra_whitespace", f"select doc_id, {Q.sp_norm('text')} as norm from documents")
def remove_extra_whitespace(spark, sf):
    return docs(spark, sf).select("doc_id", TX.sp_normalize("text").alias("norm"))


@q("no_dummy_prefix", f"select word, count(*) as n from {Q.marked_words()} group by word")
def no_dummy_prefix(spark, sf):
    d = docs(spark, sf)
    return WD.count_words(d, TX.marked_words(TX.sp_normalize("text")))


@q("split_digits", f"select word, count(*) as n from {Q.sp_pieces()} group by word")
def split_digits(spark, sf):
    return WD.sp_words(docs(spark, sf))


@q("whitespace_words", f"""select doc_id, cast(len(l) as bigint) as n_words, array_to_string(l, ' ') as words
  from (select doc_id, {Q.wp_word_list('text')} as l from documents)""")
def whitespace_words(spark, sf):
    w = docs(spark, sf).select("doc_id", TX.whitespace_words("text").alias("l"))
    return w.select("doc_id", F.size("l").cast("bigint").alias("n_words"),
                    F.array_join("l", " ").alias("words"))


@q("word_counts", f"select word, n from {Q.counts(Q.wp_words())}")
def word_counts(spark, sf):
    return WD.wordpiece_words(docs(spark, sf))


@q("byte_word_counts", f"select word, n from {Q.counts(Q.byte_words())}")
def byte_word_counts(spark, sf):
    return WD.byte_word_counts(docs(spark, sf))


@q("alphabet", f"select id, piece, role from {Q.base_vocab_sql(Q.counts(Q.wp_words()), 'wordpiece')}")
def alphabet(spark, sf):
    wc = WD.wordpiece_words(docs(spark, sf))
    return M.learn_merges(wc, "wordpiece", max_merges=0).release().vocab.select("id", "piece", "role")
