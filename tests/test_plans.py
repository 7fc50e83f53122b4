"""Physical-plan properties that matter at scale, pinned as tests."""

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from maskweave.catalog.common import docs
from maskweave.catalog.curriculum_q import CFG
from maskweave.catalog.encode_q import test_vocab as build_vocab
from maskweave.operators import encode as EN
from maskweave.operators import position as P
from maskweave.operators import words as WD
from maskweave.plans import curriculum as CU
from maskweave.plans.batches import training_data
from maskweave.sources import corpus as C


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_mode_filter_and_pruning_reach_parquet(spark):
    p = plan(C.resolve_text(docs(spark, SF_SMALL), "key"))
    assert "PushedFilters: [IsNotNull(text), Not(EqualTo(text,))]" in p
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_position_broadcasts_only_the_offsets(spark):
    pos = P.with_position(C.resolve_text(docs(spark, SF_SMALL), "key").select("doc_id"))
    p = plan(pos)
    assert "BroadcastHashJoin" in p
    # the single-partition window runs over the per-partition count table
    assert "SinglePartition" in p and "partial_count" in p


def test_aligned_buffer_has_one_shuffle_above_positions(spark):
    cfg = CFG  # the block is a multiple of the batch
    td = training_data(docs(spark, SF_SMALL), build_vocab(spark, SF_SMALL), cfg)
    p = plan(td.padded)
    hashed = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    data_shuffles = [h for h in hashed if "block" in h or "micro_step" in h]
    assert len(data_shuffles) == 1 and "block" in data_shuffles[0]


def test_no_text_is_shuffled_and_epochs_add_no_shuffled_rows(spark):
    cfg = CFG._replace(epochs=3)
    t = C.resolve_text(docs(spark, SF_SMALL), "key")
    keys = P.with_position(t.select("doc_id"))
    p = plan(EN.encode(t, build_vocab(spark, SF_SMALL)).join(keys, "doc_id"))
    for exchange in re.finditer(r"Exchange[^\n]*\n([^\n]*)", p):
        assert "text" not in exchange[1]
    sl = CU.slices(keys, cfg, keys.count())
    once, all_ = CU.shuffled(sl, cfg), CU.with_epochs(CU.shuffled(sl, cfg), cfg)
    assert all_.count() == 3 * once.count()
    p = plan(all_)
    assert p.index("Generate explode") < p.index("Exchange")  # epochs stand above the shuffle


def test_limits_cut_by_key_in_the_scan(spark):
    p = plan(P.first_rows(docs(spark, SF_SMALL), 30))
    assert "LessThanOrEqual(doc_id," in p and "Exchange" not in p


def test_word_counts_aggregate_partially_without_python(spark):
    p = plan(WD.wordpiece_words(docs(spark, SF_SMALL)))
    assert "partial_count" in p
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p


def test_batches_are_ordered_without_their_ids(spark):
    p = plan(training_data(docs(spark, SF_SMALL), build_vocab(spark, SF_SMALL), CFG).padded)
    read = re.findall(r"ReadSchema: struct<([^\n]*)>", p)
    assert any("input_ids" in r for r in read) and any("pos:" in r for r in read)
    assert not any("input_ids" in r and "pos:" in r for r in read)
    assert "ShuffledHashJoin" in p


def test_id_lists_go_to_python_in_small_batches(spark):
    from maskweave.session import _BATCH_SETTING, BATCH_BYTES, small_batches

    training_data(docs(spark, SF_SMALL), build_vocab(spark, SF_SMALL), CFG)
    try:
        assert spark.conf.get(_BATCH_SETTING) == f"{BATCH_BYTES}b"
        spark.conf.set(_BATCH_SETTING, "64k")
        small_batches(spark)
        assert spark.conf.get(_BATCH_SETTING) == "64k"
    finally:
        spark.conf.set(_BATCH_SETTING, f"{BATCH_BYTES}b")
