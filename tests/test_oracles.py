"""Registered queries against their DuckDB SQL on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import os
import sys

import pytest

from conftest import ROOT, SF_MID, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
from check_oracles import rows_of  # noqa: E402

import __spark_entry__ as E  # noqa: E402

FAST = ["text_by_schema", "text_by_key", "text_truthy", "global_position", "conversation_position",
        "raw_limit", "batch_rounded_limit", "fixed_batches", "corpus_lines", "normalize_nfkc_cf",
        "split_digits", "word_counts", "alphabet", "wordpiece_merges", "sp_bpe_merges",
        "byte_bpe_merges", "normalize_edges", "word_edges", "byte_roundtrip", "corrupt_vocab_fallback", "two_epoch_slices",
        "special_tokens_roundtrip", "wordpiece_encode", "curriculum_slices", "global_steps",
        "checkpoint_manifest", "mlm_mask", "batch_scores", "eval_mean_empty", "min_frequency_stop"]
#: Learn from the first 300 rows: the smallest tables have no more than these.
CHAINS = ["sp_bpe_chain", "byte_bpe_chain"]
ALL = sorted(k for k in E.oracle_sql() if not k.startswith("op") and k != "pipeline")
NAMES = ALL if os.environ.get("MASKWEAVE_ALL_ORACLES") else FAST


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck(SF_SMALL).execute(E.oracle_sql()[name])
    o_cols, o_rows = rows_of([d[0] for d in res.description], res.fetchall())
    assert s_cols == o_cols
    assert s_rows == o_rows


@pytest.mark.parametrize("name", CHAINS)
def test_words_outside_the_training_rows(spark, duck, name):
    df = E.queries()[name](spark, SF_MID)
    s_cols, s_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck(SF_MID).execute(E.oracle_sql()[name])
    assert (s_cols, s_rows) == rows_of([d[0] for d in res.description], res.fetchall())


def test_the_minimum_frequency_ends_learning(spark):
    from maskweave.catalog.chains_q import ROUNDS

    rows = E.queries()["min_frequency_stop"](spark, SF_SMALL).collect()
    assert 3 < len(rows) < ROUNDS


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"input_ids", "attention_mask", "labels"} <= set(df.columns)
