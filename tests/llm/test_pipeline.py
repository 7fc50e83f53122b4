"""The pipeline against a brute-force version of each of its stages."""

import hashlib
import re

import numpy as np
import public_tokenizers
import tiktoken
from conftest import SF_SMALL
from test_exact_near import brute_groups  # noqa: E402

import corpus_pipeline
from maskweave.llm import bpe, decontaminate, language_id


def words(t):
    h = [w for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))]
    return np.array([int.from_bytes(hashlib.sha1(w.encode()).digest()[:8], "little") for w in h], np.uint64)


def test_pipeline_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    more = spark.createDataFrame([(10 ** 6, "123 456 !?", "en", "s", 10), (10 ** 6 + 1, None, "en", "s", 0),
                                  (10 ** 6 + 2, "", None, None, None)], docs.schema)
    docs = docs.unionByName(more)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    items = [words(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]

    guess = {r.doc_id: r for r in language_id.predict(docs, language_id.fit(docs)).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()
            if re.search(r"[^\W\d_]", r.text or "") and not guess[r.doc_id].ambiguous]
    last = {}
    for k, t in rows:
        last[t] = max(last.get(t, k), k)
    rows = [(k, t) for k, t in rows if last[t] == k]
    groups = brute_groups(rows, 5, 80)
    rows = [(k, t) for k, t in rows if groups[k][1] == k]
    clean = []
    for k, t in rows:  # every item against the whole text
        score, _ = decontaminate.align(items, [words(t)] * len(items))
        if not any(s >= 0.5 * 2 * len(i) for s, i in zip(score, items)):
            clean.append((k, t))
    ranks = bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_50k.tiktoken")).ranks
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for k, t in clean:
        ids = own.encode_ordinary(t)
        want.append((k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(t.encode()).hexdigest()))
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == sorted(want) and 0 < len(got) < len(rows)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(40)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_SMALL).columns == docs.columns, name
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0, name


def test_stages_leave_columns_with_their_names_alone(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(30)
    extra = docs.selectExpr("*", "doc_id * 2 as score", "'x' as lang_pred", "true as ambiguous", "'d' as digest",
                            "1L as keep_id", "false as kept", "2L as component_id", "'k' as key", "array(1) as ids")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, extra, SF_SMALL)
        assert out.columns == extra.columns, name
        assert out.where("score != doc_id * 2 or lang_pred != 'x' or not ambiguous or kept or keep_id != 1").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, extra, SF_SMALL).count() == 30


def test_texts_stay_where_no_language_is_known(spark):
    docs = spark.createDataFrame([(1, "abc def", None, "s", 7), (2, "12 !", None, "s", 4), (3, None, None, "s", 0)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SF_SMALL)
    assert [r.doc_id for r in kept.collect()] == [1]
