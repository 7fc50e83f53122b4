"""Draw thresholds; streaming equals batch."""

from math import gcd

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from maskweave.catalog.common import docs
from maskweave.catalog.encode_q import test_vocab as build_vocab
from maskweave.operators import encode as EN
from maskweave.operators.collate import PRIME, STEP, turn
from maskweave.streaming import stream as ST


@settings(max_examples=300, deadline=None)
@given(x=st.integers(min_value=0, max_value=PRIME - 1))
def test_turn_stays_in_range_and_in_64_bits(x):
    assert 0 <= turn(x) < PRIME
    y = x * x % PRIME
    assert max(x * x, y * y, (PRIME - 1) ** 2, (PRIME - 1) * 48271 + 11) < 2 ** 63


def test_turn_is_one_to_one_and_draws_are_even():
    assert gcd(5, PRIME - 1) == 1  # so x -> x**5 permutes the residues
    x = (np.arange(1, 200_001, dtype=np.int64) * STEP + 8 * 123456789) % PRIME
    u = turn(x) / PRIME
    assert len(set(turn(x).tolist())) == len(x)
    assert abs(u.mean() - 0.5) < 0.005 and abs(u.var() - 1 / 12) < 0.002
    assert abs(np.corrcoef(u[:-1], u[1:])[0, 1]) < 0.01
    for p in (0.14, 0.3, 0.8, 0.9):
        assert abs((u < p).mean() - p) < 0.005


def test_stream_encode_equals_batch(spark):
    v = build_vocab(spark, SF_SMALL)
    batch = EN.encode(docs(spark, SF_SMALL), v).select("doc_id", "input_ids")
    sink = ST.stream_encode(ST.stream_table(spark, SF_SMALL, "documents"), v)
    streamed = spark.read.parquet(sink).select("doc_id", "input_ids")
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0


def test_stream_word_counts_resume_from_checkpoint(spark, tmp_path):
    from maskweave.operators import words as WD

    src, sink, ckpt = str(tmp_path / "src"), str(tmp_path / "sink"), str(tmp_path / "ckpt")
    d = docs(spark, SF_SMALL).select("doc_id", "text")
    d.filter("doc_id < 100").write.parquet(src)
    ST.stream_word_counts(ST.stream_table(spark, src, "part-*"), sink=sink, checkpoint=ckpt)
    d.filter("doc_id >= 100").write.mode("append").parquet(src)   # new files arrive
    ST.stream_word_counts(ST.stream_table(spark, src, "part-*"), sink=sink, checkpoint=ckpt)
    got = ST.read_word_counts(spark, sink)
    assert spark.read.parquet(sink).where("epoch = 1").count() < got.count()  # changed words only
    want = WD.wordpiece_words(d)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def _fed(spark, tmp_path, files=4, rows=30):
    """A folder of several files: odd rows empty."""
    for k in range(files):
        data = [(k * rows + i, "" if i % 3 == 0 else f"word{i % 5} text {k}") for i in range(rows)]
        spark.createDataFrame(data, "doc_id long, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return (spark.readStream.schema("doc_id long, text string").option("maxFilesPerTrigger", 1)
            .parquet(str(tmp_path / "in")))


def test_a_stream_ends_at_its_limit_and_after_a_restart(spark, tmp_path):
    from maskweave.catalog.encode_q import test_vocab as build_vocab
    from maskweave.streaming import stream as ST

    vocab = build_vocab(spark, SF_SMALL)
    for limit in (1, 20, 33, 80, 500):
        src = _fed(spark, tmp_path / str(limit))
        sink = ST.stream_encode(src, vocab, limit=limit, sink=str(tmp_path / f"out{limit}"),
                                checkpoint=str(tmp_path / f"ckpt{limit}"))
        got = sorted(r.doc_id for r in spark.read.parquet(sink).select("doc_id").collect())
        assert len(got) == min(limit, 80) and all(k % 30 % 3 for k in got)
    # a batch that is replayed counts only what came before it
    assert ST._rows_before(spark, str(tmp_path / "out33"), 0) == 0
    assert ST._rows_before(spark, str(tmp_path / "out33"), 1) == 20


def test_a_stream_that_fails_in_the_middle_ends_with_the_same_rows(spark, tmp_path, monkeypatch):
    from maskweave.catalog.encode_q import test_vocab as build_vocab
    from maskweave.streaming import stream as ST

    vocab, plain, calls = build_vocab(spark, SF_SMALL), ST.EN.with_masks, []

    def failing(*args):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("stopped")
        return plain(*args)

    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    with monkeypatch.context() as m:
        m.setattr(ST.EN, "with_masks", failing)
        with pytest.raises(Exception, match="stopped"):
            ST.stream_encode(_fed(spark, tmp_path), vocab, limit=50, sink=out, checkpoint=ckpt)
    assert spark.read.parquet(out).count() == 40
    again = (spark.readStream.schema("doc_id long, text string").option("maxFilesPerTrigger", 1)
             .parquet(str(tmp_path / "in")))
    ST.stream_encode(again, vocab, limit=50, sink=out, checkpoint=ckpt)
    got = [r.doc_id for r in spark.read.parquet(out).collect()]
    assert len(got) == len(set(got)) == 50 and all(k % 30 % 3 for k in got)


def test_merged_counts_equal_all_epochs(spark, tmp_path):
    from maskweave.streaming import stream as ST

    sink = ST.stream_word_counts(_fed(spark, tmp_path), sink=str(tmp_path / "counts"), checkpoint=str(tmp_path / "c"))
    want = {tuple(r) for r in ST.read_word_counts(spark, sink).collect()}
    assert len(ST._folders(spark, sink, "epoch")) >= 4
    last = ST.compact_word_counts(spark, sink)
    assert {tuple(r) for r in ST.read_word_counts(spark, sink).collect()} == want
    assert not ST._folders(spark, sink, "epoch") and ST.compact_word_counts(spark, sink) == last
    spark.createDataFrame([("word1", 999)], "word string, n bigint").write.parquet(f"{sink}/epoch={last + 1}")
    after = dict(tuple(r) for r in ST.read_word_counts(spark, sink).collect())
    assert after == dict(want) | {"word1": 999}
    ST.compact_word_counts(spark, sink)
    assert dict(tuple(r) for r in ST.read_word_counts(spark, sink).collect()) == after
    assert ST.read_word_counts(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("files", [1, 3])
def test_stream_queries_read_a_table_of_many_files(spark, tmp_path, files):
    import __spark_entry__ as E

    rows = docs(spark, SF_SMALL).select("doc_id", "text").repartition(files)
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    assert len(list((tmp_path / "documents.parquet").glob("part-*"))) == files
    got = E.queries()["stream_encode"](spark, str(tmp_path))
    want = E.queries()["wordpiece_encode"](spark, str(tmp_path))
    assert want.count() > 50 and got.count() == want.count() and got.exceptAll(want).count() == 0
    assert E.queries()["stream_limit"](spark, str(tmp_path)).count() == 120
    counts = E.queries()["word_counts"](spark, str(tmp_path))
    for name in ("stream_word_counts", "stream_counts_merged"):
        found = E.queries()[name](spark, str(tmp_path)).select(*counts.columns)
        assert found.count() == counts.count() and found.exceptAll(counts).count() == 0
