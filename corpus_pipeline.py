"""Pipeline over ``documents``: language, exact and near duplicates, benchmark
passages, byte-level BPE.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame.  ``run`` writes every stage as Parquet to the shared
checkpoint folder and hands what it reads back to the next one, so a lost
executor never reaches behind the stage that runs.  All stages but the last
return the columns of ``documents``.

* ``language_id`` drops texts that have no letter, are null, or whose language
  is ambiguous; it learns from the rows that have a language.  Where no row has
  one, nothing is learned and every text with a letter stays.
* ``exact_dedup`` keeps of equal texts the row with the largest doc_id.
* ``near_dedup`` keeps the smallest doc_id of each group of texts that are
  linked at 80 % of their 5-word shingles; empty texts are in no group.
* ``decontaminate`` drops documents that align with an item of ``benchmark``.
* ``byte_bpe`` encodes what is left and returns, for each document, the number
  of tokens and digests of its ids and decoded bytes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from maskweave.llm import bpe, decontaminate, exact_dedup, language_id, near_dedup
from maskweave.session import discard, materialize, prepare

#: The language model and the aligner are no SQL; tests/llm compares the
#: pipeline with brute force instead.
ORACLE_SQL = None


def identify_language(spark, docs, sf_dir):
    prepare(spark)
    if docs.where("lang is not null and text is not null").isEmpty():
        return docs.where(F.col("text").rlike(r"\p{L}"))
    # columns of documents that are named like the prediction's keep their values
    aside = {c: f"_mw_{c}" for c in ("lang_pred", "score", "ambiguous") if c in docs.columns}
    found = language_id.predict(docs.withColumnsRenamed(aside), language_id.fit(docs))
    kept = found.where("lang_pred != 'und' and not ambiguous").drop("lang_pred", "score", "ambiguous")
    return kept.withColumnsRenamed({new: old for old, new in aside.items()}).select(*docs.columns)


def drop_exact_copies(spark, docs, sf_dir):
    prepare(spark)
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark, docs, sf_dir):
    prepare(spark)
    return near_dedup.deduplicate(docs, size=5, percent=80)


def drop_benchmark_passages(spark, docs, sf_dir):
    prepare(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_and_decode(spark, docs, sf_dir):
    prepare(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language_id", identify_language), ("exact_dedup", drop_exact_copies),
          ("near_dedup", drop_near_copies), ("decontaminate", drop_benchmark_passages),
          ("byte_bpe", encode_and_decode)]


def run(spark, sf_dir):
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(before)  # what the stage has read; the table itself is not touched
    return docs
