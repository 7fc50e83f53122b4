"""Limits by selection, the shuffle of whole phases, committed writes."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from maskweave.catalog.common import docs
from maskweave.catalog.curriculum_q import CFG
from maskweave.operators import encode as EN
from maskweave.operators import position as P
from maskweave.plans import curriculum as CU
from maskweave.session import scratch_path
from maskweave.sources import sinks as S


@pytest.mark.parametrize("bins", [2, 5, 4096])
def test_nth_key(spark, monkeypatch, bins):
    monkeypatch.setattr(P, "BINS", bins)
    rng = random.Random(bins)
    keys = sorted({-2 ** 63, 2 ** 63 - 1, 0, -1} | {rng.randint(-10 ** rng.randint(1, 18), 10 ** 9) for _ in range(60)})
    df = spark.createDataFrame([(k,) for k in rng.sample(keys, len(keys))], "doc_id long").cache()
    for n in (1, 2, 30, len(keys) - 1, len(keys)):
        assert P.nth_key(df, n) == keys[n - 1]
    assert P.nth_key(df, len(keys) + 1) is None
    assert P.nth_key(df.limit(0), 1) is None
    df.unpersist()


def test_rows_between(spark):
    rows = [(k * 7, f"k{k:03d}") for k in range(50)]
    df = spark.createDataFrame(rows, "doc_id int, name string").repartition(3)
    for skip, take in ((0, 5), (10, 7), (45, 20), (60, 3), (3, None), (0, 0), (49, 1)):
        want = rows[skip:] if take is None else rows[skip:skip + take]
        for key in ("doc_id", "name"):
            assert sorted(map(tuple, P.rows_between(df, skip, take, key).collect())) == want, (skip, take, key)


def test_selection_sorts_and_writes_nothing(spark, monkeypatch):
    monkeypatch.setattr(P, "materialize", lambda *a: pytest.fail("written"))
    p = P.rows_between(docs(spark, SF_SMALL), 10, 30)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in p and "GreaterThan(doc_id," in p and "LessThanOrEqual(doc_id," in p


def test_global_shuffle_has_no_window_over_rows(spark):
    pos = P.with_position(docs(spark, SF_SMALL).select("doc_id"))
    n = pos.count()
    sh = CU.shuffled(CU.slices(pos, CFG, n), CFG, mode="global")
    plan = sh._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan
    train = sh.where("split = 'train'")
    assert train.groupBy("phase").agg((F.max("seq") + 1 == F.count("*")).alias("dense"),
                                      (F.countDistinct("seq") == F.count("*")).alias("own")).where(
        "not (dense and own)").count() == 0
    assert set(sh.columns) == set(CU.shuffled(CU.slices(pos, CFG, n), CFG).columns)
    with pytest.raises(ValueError):
        CU.shuffled(sh, CFG, mode="buffer")


VOCAB = "id bigint, piece string, score double, role string"


def test_a_write_that_stops_half_way_reads_as_the_old_vocabulary(spark, monkeypatch):
    out = scratch_path(spark, "vocab")
    one = spark.createDataFrame([(0, "[UNK]", 0.0, "unk"), (1, "a", 0.0, None)], VOCAB)
    two = spark.createDataFrame([(0, "[UNK]", 0.0, "unk"), (1, "b", 0.0, None)], VOCAB)
    merges = spark.createDataFrame([(1, "a", "a", "aa", 3)], "rank int, left string, right string, merged string, n bigint")
    S.write_vocab(one, out, merges, {"unk_token": "[UNK]"})
    with monkeypatch.context() as m:
        m.setattr(S, "_commit", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            S.write_vocab(two, out, merges, {"unk_token": "<unk>"})
    vocab, loaded = S.load_vocab(spark, out, None)
    assert loaded and {r.piece for r in vocab.collect()} == {"[UNK]", "a"}
    assert S.read_special_tokens(spark, out) == {"unk_token": "[UNK]"}
    S.write_vocab(two, out, merges, {"unk_token": "<unk>"})
    assert {r.piece for r in S.read_vocab(spark, out).collect()} == {"[UNK]", "b"}
    assert S.read_special_tokens(spark, out) == {"unk_token": "<unk>"}
    assert S.read_merges(spark, out).count() == 1


def test_a_replayed_log_adds_nothing(spark):
    path = scratch_path(spark, "metrics")
    log = spark.createDataFrame([("r", 1, "loss", 2.0), ("r", 2, "loss", 1.5), ("r", 2, "loss", 1.5)],
                                "run string, step int, name string, value double")
    S.log_metrics(log, path, once=True)
    S.log_metrics(log, path, once=True)
    more = spark.createDataFrame([("r", 2, "loss", 9.0), ("r", 2, "eval_loss", 3.0)], log.schema)
    S.log_metrics(more, path, once=True)
    got = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert got == [("r", 1, "loss", 2.0), ("r", 2, "eval_loss", 3.0), ("r", 2, "loss", 1.5)]


def test_a_long_word_of_wordpieces():
    m = EN.TokenModel(kind="wordpiece", ids={"[UNK]": 0, "ab": 1, "##cd": 2, "##abc": 3, "##d": 4}, max_piece=5,
                      max_word_chars=None)
    assert m.encode_word("ab" + "cdabcd" * 200_000) == [1] + [2, 3, 4] * 200_000


def test_a_phase_reads_its_row_groups_only(spark):
    cfg = CFG._replace(eval_rows=10) if hasattr(CFG, "eval_rows") else CFG
    rows = spark.range(40_000).select(F.col("id").alias("doc_id"), F.col("id").alias("pos"),
                                      F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    table = CU.clustered(rows, block_bytes=64 << 10)
    whole = 0
    for split in CU.SPLITS:
        part = CU.phase_slice(table, cfg, 40_000, 1, split)
        got = {r.pos for r in part.collect()}
        sl = CU.slices(rows.select("doc_id", "pos"), cfg, 40_000)
        want = {r.pos for r in sl.where((F.col("phase") == 1) & (F.col("split") == split)).collect()}
        assert got == want and got
        execution = part._jdf.queryExecution()
        execution.executedPlan().executeCollect()
        scan = execution.executedPlan().collectLeaves().head()
        read = scan.metrics().apply("numOutputRows").value()
        whole += read
        assert read < 40_000
    with pytest.raises(ValueError):
        CU.phase_slice(table, cfg, 40_000, 99, "train")
