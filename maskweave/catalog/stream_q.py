"""Step 9 queries: streaming encode and streaming word counts, read back
from their sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskweave.catalog import sqlparts as Q
from maskweave.catalog.encode_q import ORACLES as ENC_SQL
from maskweave.catalog.encode_q import test_vocab
from maskweave.operators import encode as EN
from maskweave.streaming import stream as ST

QUERIES = {}
ORACLES = {}


def q(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@q("stream_encode", ENC_SQL["wordpiece_encode"])
def stream_encode(spark, sf):
    src = ST.stream_table(spark, sf, "documents")
    out = spark.read.parquet(ST.stream_encode(src, test_vocab(spark, sf))).drop("batch_id")
    return out.select("doc_id", F.size("input_ids").cast("bigint").alias("n_tokens"),
                      EN.ids_string("input_ids").alias("ids"))


@q("stream_word_counts", f"select word, n from {Q.counts(Q.wp_words())}")
def stream_word_counts(spark, sf):
    src = ST.stream_table(spark, sf, "documents")
    return ST.read_word_counts(spark, ST.stream_word_counts(src))


@q("stream_limit", "select doc_id from (select * from documents where text is not null and text <> '' "
   "order by doc_id limit 120)")
def stream_limit(spark, sf):
    """K1, B2: a stream that ends after so many non-empty rows."""
    src = ST.stream_table(spark, sf, "documents")
    return spark.read.parquet(ST.stream_encode(src, test_vocab(spark, sf), limit=120)).select("doc_id")


@q("stream_counts_merged", f"select word, n from {Q.counts(Q.wp_words())}")
def stream_counts_merged(spark, sf):
    """K2: word counts after the epochs' folders were merged."""
    sink = ST.stream_word_counts(ST.stream_table(spark, sf, "documents"))
    ST.compact_word_counts(spark, sink)
    return ST.read_word_counts(spark, sink)
