"""Text functions, text-choice modes and sources/sinks."""

import math
import unicodedata
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from maskweave.functions import text as TX
from maskweave.operators import evaluate as EV
from maskweave.session import scratch_path
from maskweave.sources import corpus as C
from maskweave.sources import sinks as S


def test_nfkc_casefold_literals(spark):
    # FIXTURES nfkc_literals
    df = spark.createDataFrame([("ﬁn",), ("Ⅳ",), ("Ａ１",), ("Straße",)], "t string")
    got = [r[0] for r in df.select(TX.nfkc_casefold("t")).collect()]
    assert got == ["fin", "iv", "a1", "strasse"]


def test_truthy_strict_raises_without_text(spark):
    df = spark.createDataFrame([(1, "", None)], "doc_id long, text string, content string")
    with pytest.raises(Exception, match="row without a value"):
        C.resolve_text(df, "truthy").collect()


def test_key_mode_does_not_fall_back_to_content(spark):
    df = spark.createDataFrame([(1, "", "c"), (2, "t", "c")], "doc_id long, text string, content string")
    assert [r["doc_id"] for r in C.resolve_text(df, "key").collect()] == [2]
    only = spark.createDataFrame([(1, "c")], "doc_id long, content string")
    assert C.resolve_text(only, "key").collect()[0]["text"] == "c"


def test_marked_words_and_digits(spark):
    df = spark.createDataFrame([("  Hello   wörld 2024ab ",)], "t string")
    got = df.select(F.flatten(F.transform(TX.marked_words(TX.sp_normalize("t")), TX.split_digits))).first()[0]
    assert got == ["hello", "▁wörld", "▁", "2", "0", "2", "4", "ab"]


def test_prepare_output_dir(spark):
    p = scratch_path(spark, "outdir")
    S.prepare_output_dir(spark, p)            # created
    S.prepare_output_dir(spark, p)            # exists and empty: fine
    spark.range(1).write.parquet(p + "/x")
    with pytest.raises(FileExistsError):
        S.prepare_output_dir(spark, p)
    S.prepare_output_dir(spark, p, overwrite=True)


def test_eval_mean_infinite_on_no_batches(spark):
    empty = spark.createDataFrame([], "split string, loss double, error string")
    row = EV.overall_mean(empty).first()
    assert row["n_batches"] == 0 and math.isinf(row["mean_loss"])


def test_corpus_lines_one_per_document(spark):
    d = C.read_corpus(spark, SF_SMALL)
    path = S.write_corpus_lines(C.resolve_text(d, "truthy"))
    assert spark.read.text(path).count() == d.count()


def test_log_metrics_appends(spark):
    path = scratch_path(spark, "metrics")
    m = spark.createDataFrame([("r", 1, "loss", 2.5)], "run string, step long, name string, value double")
    S.log_metrics(m, path)
    S.log_metrics(m, path)
    assert spark.read.parquet(path).count() == 2


@pytest.mark.parametrize("kind,spark_words", [
    ("wordpiece", lambda c: TX.whitespace_words(c)),
    ("byte", lambda c: TX.byte_words(c)),
    ("sp", None),
])
def test_python_pretokenizer_equals_spark(spark, kind, spark_words):
    from maskweave.operators import words as WD

    d = C.read_corpus(spark, "/root/testdata/sf0.01")
    expr = WD.sp_pieces("text") if spark_words is None else spark_words(F.col("text"))
    got = {r["doc_id"]: list(r["w"]) for r in d.select("doc_id", expr.alias("w")).collect()}
    split = TX.python_pretokenizer(kind)
    for r in d.select("doc_id", "text").collect():
        assert split(r["text"]) == got[r["doc_id"]], r["doc_id"]


def test_normalize_and_collapse_in_one_pass_for_every_character(spark):
    odd = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    odd = [c for c in odd if c.isspace() or not c.isprintable() and ord(c) < 0x10000 and unicodedata.category(c) != "Co"]
    rows = [(k, f" {c}a{c}B{c}{c} \n9{c}") for k, c in enumerate(odd)] + [(-1, None), (-2, ""), (-3, " \t ")]
    df = spark.createDataFrame(rows, "k int, t string")
    both = df.select("t", TX.sp_normalize("t").alias("one"), TX.collapse_whitespace(TX.nfkc_casefold("t")).alias("two"))
    assert [r for r in both.collect() if r.one != r.two] == []
    plain = {r.t: r.one for r in both.collect()}
    assert plain[None] is None and plain[""] == "" and plain[" \t "] == ""
