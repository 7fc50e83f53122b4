"""Invariants of encoding, slicing, masking and padding on sf0.001."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from maskweave.catalog.common import docs
from maskweave.catalog.encode_q import test_vocab as build_vocab
from maskweave.functions import text as TX
from maskweave.operators import collate as CO
from maskweave.operators import encode as EN
from maskweave.plans.batches import training_data
from maskweave.catalog.curriculum_q import CFG
from maskweave.plans.config import numbers


@pytest.fixture(scope="module")
def td(spark):
    return training_data(docs(spark, SF_SMALL), build_vocab(spark, SF_SMALL), CFG)


def test_slice_sizes(td):
    cfg = CFG
    c, e = numbers(cfg, td.n_rows).chunk, cfg.eval_rows
    sizes = {(r["phase"], r["split"]): r["count"] for r in td.batches.groupBy("phase", "split").count().collect()}
    for ph in range(5):
        assert sizes[(ph, "eval")] == e
        want = max(0, min(ph * c + e + c, td.n_rows) - (ph * c + e))
        assert sizes.get((ph, "train"), 0) == want


def test_equal_lengths_per_batch(td):
    lens = td.padded.groupBy(*td.batch_keys).agg(
        F.countDistinct(F.size("input_ids")).alias("a"), F.countDistinct(F.size("labels")).alias("b"),
        F.countDistinct(F.size("attention_mask")).alias("c"))
    assert lens.filter("a <> 1 or b <> 1 or c <> 1").count() == 0


def test_labels_only_where_selected(td):
    m = td.masked.join(td.encoded.select("doc_id", F.col("input_ids").alias("orig")), "doc_id")
    z = m.select(F.arrays_zip("orig", "input_ids", "labels").alias("z")).select(F.explode("z").alias("z"))
    bad = z.filter("(z.labels <> -100 and z.labels <> z.orig) or (z.labels = -100 and z.input_ids <> z.orig)")
    assert bad.count() == 0


def test_mask_rate_within_three_sigma(td):
    per = td.masked.select("p", F.explode("labels").alias("l")).groupBy("p").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("l") != CO.IGNORE).cast("int")).alias("s"))
    for r in per.collect():
        n, s, p = r["n"], r["s"], r["p"]
        assert abs(s - n * p) <= 3 * math.sqrt(n * p * (1 - p)) + 1, (p, n, s)


def test_second_run_identical(spark, td):
    again = training_data(docs(spark, SF_SMALL), build_vocab(spark, SF_SMALL), CFG)
    cols = ["epoch", "phase", "split", "doc_id", "micro_step", "input_ids", "labels"]
    a = td.padded.select(*cols)
    b = again.padded.select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_decode_encode_roundtrip(spark):
    d = docs(spark, SF_SMALL)
    v = build_vocab(spark, SF_SMALL)
    enc = EN.encode(d, v, "wordpiece")
    inv = {int(r["id"]): r["piece"] for r in v.collect()}
    words = {r["doc_id"]: r["w"] for r in d.select("doc_id", TX.whitespace_words("text").alias("w")).collect()}
    checked = 0
    for r in enc.collect():
        if any("#" in w for w in words[r["doc_id"]]):
            continue  # whole words such as '###' are pieces that look like continuations
        text = "".join(inv[i][2:] if inv[i].startswith("##") else " " + inv[i] for i in r["input_ids"])
        assert text.split() == words[r["doc_id"]]
        checked += 1
    assert checked > 50


def test_squeeze_rejects_leading_size_two(spark):
    ok = spark.createDataFrame([([[1, 2, 3]],)], "x array<array<bigint>>")
    assert ok.select(CO.squeeze_leading(F.col("x"))).first()[0] == [1, 2, 3]
    bad = spark.createDataFrame([([[1], [2]],)], "x array<array<bigint>>")
    with pytest.raises(Exception, match="one inner list expected"):
        bad.select(CO.squeeze_leading(F.col("x"))).collect()


def test_token_types_are_padded_and_shaped(spark):
    df = spark.createDataFrame([(1, [5, 6, 7], [1, 1, 1], [0, 0, 1]), (1, [8], [1], [0])],
                               "b int, input_ids array<bigint>, attention_mask array<bigint>, token_type_ids array<bigint>")
    rows = CO.pad_batches(df, 0, ["b"]).collect()
    assert sorted(r.token_type_ids for r in rows) == [[0, 0, 0], [0, 0, 1]]
    nested = spark.createDataFrame([([[5, 6]], [[0, 1]])], "input_ids array<array<int>>, token_type_ids array<array<int>>")
    out = CO.shape_batch(nested)
    assert out.dtypes == [("input_ids", "array<bigint>"), ("token_type_ids", "array<bigint>")]
    assert tuple(out.first()) == ([5, 6], [0, 1])
    bad = spark.createDataFrame([([[5], [6]],)], "token_type_ids array<array<int>>")
    with pytest.raises(Exception, match="token_type_ids: one inner list expected, found 2"):
        CO.shape_batch(bad).collect()


def test_scores_take_many_batches_a_call_and_keep_failures_apart(spark):
    from maskweave.operators import evaluate as EV

    df = spark.createDataFrame([(0, 0, "train", k // 2, float(k)) for k in range(20)],
                               "epoch int, phase int, split string, micro_step bigint, x double")

    def mean(batch):
        if batch["micro_step"].iloc[0] == 3:
            raise RuntimeError("no")
        return None if batch["micro_step"].iloc[0] == 4 else batch["x"].mean()

    for per_call in (1, 4, 256):
        rows = {r.micro_step: (r.loss, r.error) for r in EV.score_with(df, mean, per_call=per_call).collect()}
        assert len(rows) == 10 and rows[0] == (0.5, None) and rows[9] == (18.5, None)
        assert rows[3] == (None, "RuntimeError: no") and rows[4][0] is None and rows[4][1]


def test_masks_equal_the_formula_one_token_at_a_time(spark):
    """Rows over several slices, empty and null id lists."""
    import hashlib
    import math

    n, specials, rows = 50, [0, 3], [(k, [(k * 7 + j) % 50 for j in range(k % 40)]) for k in range(200)]
    df = spark.createDataFrame([(0, 1, "train", k, 0.3, ids) for k, ids in [*rows, (900, None)]],
                               "epoch int, phase int, split string, doc_id bigint, p double, input_ids array<bigint>")
    many, EN.SLICE_IDS = EN.SLICE_IDS, 64
    try:
        got = {r.doc_id: r for r in CO.mlm_mask(df.coalesce(1), specials, 4, n).collect()}
    finally:
        EN.SLICE_IDS = many
    assert (got.pop(900).labels, len(got)) == (None, 200)
    share = lambda p: math.ceil(p * float(CO.PRIME))
    for k, ids in rows:
        h = hashlib.md5(f"42:mlm:0:1:train:{k}".encode()).hexdigest()
        s0, s1, s2 = (int(h[7 * i:7 * i + 7], 16) * 8 for i in range(3))
        new, labels = [], []
        for j, t in enumerate(ids):
            z = CO.turn((s0 + (j + 1) * CO.STEP) % CO.PRIME)
            hit = z < share(0.3) and t not in specials
            act = CO.turn((z + s1) % CO.PRIME)
            other = CO.turn((act + s2) % CO.PRIME) * n // CO.PRIME
            new.append(t if not hit or act >= share(0.9) else 4 if act < share(0.8) else other)
            labels.append(t if hit else CO.IGNORE)
        assert (got[k].input_ids, got[k].labels, got[k].attention_mask) == (new, labels, [1] * len(ids))


def test_masking_is_no_expression_for_each_token(spark):
    import __spark_entry__ as E

    for name in ("mlm_mask", "flagship_batches"):
        plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" in plan and "zip_with" not in plan and "transform(" not in plan


def test_ids_as_a_string_and_bytes_as_text(spark):
    df = spark.createDataFrame([(0, [1, 20, 300]), (1, []), (2, None), (3, [7])], "k int, input_ids array<bigint>")
    assert [r[0] for r in df.orderBy("k").select(EN.ids_string("input_ids")).collect()] == ["1 20 300", "", None, "7"]
    vocab = spark.createDataFrame([(0, "[UNK]", 0.0, "unk"), (1, "61", 0.0, None), (20, "C3A9", 0.0, None), (7, "62", 0.0, None)],
                                  "id int, piece string, score double, role string")
    assert [r.text for r in EN.decode_bytes(df, vocab).orderBy("k").collect()] == ["aé", "", None, "b"]


def test_a_long_row_is_drawn_in_parts(monkeypatch):
    import numpy as np

    monkeypatch.setattr(CO, "CHUNK", 64)
    at = np.array([0, 0, 5, 5, 300, 301, 301])
    parts = list(CO._places(at))
    assert max(len(row) for row, _ in parts) == 64
    assert np.concatenate([row for row, _ in parts]).tolist() == np.repeat(np.arange(6), np.diff(at)).tolist()
    assert np.concatenate([place for _, place in parts]).tolist() == list(range(301))
    assert not list(CO._places(np.array([0, 0])))
