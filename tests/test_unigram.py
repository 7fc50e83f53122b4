"""Unigram trainer and Viterbi encoder against brute force."""

import math
import random
from collections import Counter
from itertools import combinations

import pytest

from pyspark.sql import functions as F

from conftest import SF_SMALL
from maskweave.catalog.common import docs
from maskweave.operators import encode as EN
from maskweave.operators import unigram as U
from maskweave.operators import words as WD


def segmentations(w, vocab, max_piece):
    n = len(w)
    for k in range(n):
        for cuts in combinations(range(1, n), k):
            b = (0,) + cuts + (n,)
            parts = [w[b[i]:b[i + 1]] for i in range(len(b) - 1)]
            if all(p in vocab and len(p) <= max_piece for p in parts):
                yield parts


LP = {"a": math.log(0.2), "b": math.log(0.2), "ab": math.log(0.3), "ba": math.log(0.1),
      "aba": math.log(0.15), "c": math.log(0.05)}


def test_forward_backward_matches_enumeration():
    for w in ["abab", "aba", "cab", "babac"]:
        segs = list(segmentations(w, LP, 3))
        z = math.log(sum(math.exp(sum(LP[p] for p in s)) for s in segs))
        want = {}
        for s in segs:
            pr = math.exp(sum(LP[p] for p in s) - z)
            for p in s:
                want[p] = want.get(p, 0.0) + pr
        got, gz = U.forward_backward(w, LP, 3)
        assert abs(gz - z) < 1e-9
        assert set(got) == set(want)
        for p in want:
            assert abs(got[p] - want[p]) < 1e-9


def test_long_words_sum_logs():
    for w in ["ab" * 14, "abacab" * 4, "c" * 29]:
        want, z = U._short_sums(w, LP, 3)
        short, U.SHORT = U.SHORT, 0
        try:
            got, gz = U.forward_backward(w, LP, 3)
        finally:
            U.SHORT = short
        assert abs(gz - z) < 1e-9 and got.keys() == want.keys()
        assert all(abs(got[p] - want[p]) < 1e-9 for p in want)
    assert U.forward_backward("xyz", LP, 3) == ({}, U.NEG)


def test_viterbi_matches_enumeration():
    ids = {p: i for i, p in enumerate(sorted(LP))}
    m = EN.TokenModel(kind="unigram", ids=ids, scores=LP, max_piece=3)
    for w in ["abab", "aba", "cab", "babac"]:
        best = max(segmentations(w, LP, 3), key=lambda s: sum(LP[p] for p in s))
        assert m.encode_word(w) == [ids[p] for p in best]


def test_em_likelihood_does_not_fall_and_probs_sum_to_one(spark):
    wc = WD.sp_words(docs(spark, SF_SMALL))
    model = U.train_unigram(wc, vocab_size=10_000, seed_size=800, em_steps=3, min_count=0.0)
    h = model.loglik
    for a, b in zip(h[:3], h[1:3]):
        assert b >= a - 1e-6 * abs(a)
    lp = [r["score"] for r in model.vocab.filter(F.col("role").isNull()).collect()]
    assert abs(sum(math.exp(x) for x in lp) - 1.0) < 1e-6


def test_vocab_size_and_characters_kept(spark):
    wc = WD.sp_words(docs(spark, SF_SMALL))
    model = U.train_unigram(wc, vocab_size=300, seed_size=2000)
    v = model.vocab
    assert v.count() == 300
    chars = {r["word"] for r in wc.select(F.explode(WD.chars("word")).alias("word")).distinct().collect()}
    pieces = {r["piece"] for r in v.collect()}
    assert chars <= pieces
    enc = EN.encode(docs(spark, SF_SMALL), v, "unigram")
    assert enc.filter(F.array_contains("input_ids", 0)).count() == 0  # no [UNK] on training text


def plain_seeds(words, max_piece):
    freq = Counter()
    for w, n in words:
        for i in range(len(w)):
            for j in range(i + 1, min(len(w), i + max_piece) + 1):
                freq[w[i:j]] += n
    return freq


def plain_train(words, vocab_size, seed_size, max_piece=16, em_steps=2, shrink=0.75, overshoot=1.1, min_count=0.5):
    """The trainer's contract with plain dictionaries: piece -> log probability."""
    freq = plain_seeds(words, max_piece)
    chars = {p for p in freq if len(p) == 1}
    top = sorted((p for p in freq if len(p) > 1), key=lambda p: (-freq[p] * len(p), p))[:seed_size]
    c = {p: freq[p] for p in [*top, *chars]}
    norm = lambda c: {p: math.log(x / sum(c.values())) for p, x in c.items()}
    lp, history, target = norm(c), [], vocab_size - 4

    def em(lp):
        c, ll = Counter(), 0.0
        for w, n in words:
            got, z = U.forward_backward(w, lp, max_piece)
            ll += n * z
            for p, x in got.items():
                c[p] += n * x
        history.append(ll)
        kept = {p: x for p, x in c.items() if len(p) > 1 and x >= min_count}
        return c, norm(kept | {p: c.get(p, min_count) for p in chars})

    while True:
        for _ in range(em_steps):
            c, lp = em(lp)
        if len(lp) <= max(target, int(overshoot * target)):
            break
        goal = max(int(overshoot * target), int(len(lp) * shrink))
        cost = {p: c[p] * (lp[p] - U.best_segmentation(p, lp, max_piece, exclude=p)) for p in lp if len(p) > 1}
        keep = set(sorted(cost, key=lambda p: (-cost[p], p))[:max(0, goal - len(chars))]) | chars
        lp = {p: v for p, v in lp.items() if p in keep}
    _, lp = em(lp)
    if len(lp) > target:
        rest = sorted((p for p in lp if len(p) > 1), key=lambda p: (-lp[p], p))[:max(0, target - len(chars))]
        lp = norm({p: math.exp(lp[p]) for p in [*rest, *chars]})
    return lp, history


def test_training_equals_plain_dictionaries(spark):
    rng = random.Random(2)
    words = {"".join(rng.choice("abcdeé\U0001f600") for _ in range(rng.randint(1, 12))): rng.randint(1, 40)
             for _ in range(150)}
    df = spark.createDataFrame(list(words.items()) + [("", 3)], "word string, n bigint")
    want, history = plain_train(sorted(words.items()), 150, 700)
    model = U.train_unigram(df, vocab_size=150, seed_size=700)
    rows = model.vocab.orderBy("id").collect()
    got = {r.piece: r.score for r in rows if r.role is None}
    assert [r.id for r in rows] == list(range(len(rows))) and len(rows) == 150
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)
    assert [r.score for r in rows[4:]] == sorted((r.score for r in rows[4:]), reverse=True)
    assert all(abs(a - b) < 1e-6 * abs(b) for a, b in zip(model.loglik, history))


@pytest.mark.parametrize("max_piece", [1, 4, 16])
def test_seeds_equal_all_substrings(spark, max_piece):
    rng = random.Random(4)
    words = {"".join(rng.choice("abé\U0001f600\0") for _ in range(rng.randint(1, 25))): rng.randint(1, 9) for _ in range(300)}
    words |= {"a" * 60: 2, "ab" * 40: 3}
    df = spark.createDataFrame(list(words.items()) + [("", 5)], "word string, n bigint").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")  # intervals over many batches
    try:
        got = {r.piece: (r.freq, r.score) for r in U.seed_pieces(df, max_piece).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = plain_seeds(words.items(), max_piece)
    assert got == {p: (n, n * len(p)) for p, n in want.items()}


def test_no_words(spark):
    none = spark.createDataFrame([], "word string, n bigint")
    assert [r.role for r in U.train_unigram(none).vocab.orderBy("id").collect()] == ["unk", "bos", "eos", "pad"]


def test_words_of_one_length_are_summed_together(spark, monkeypatch):
    """The plain sums are those of forward_backward; tasks take short words
    in groups, the long one and one that underflows alone."""
    words = ["abab", "caba", "abcb", "aaaa", "ab" * 20, "c" * 29]
    lp = {**LP, "c": -40.0}
    rows = [(w, k + 1) for k, w in enumerate(words)]
    want, ll = {}, 0.0
    for w, n in rows:
        got, z = U.forward_backward(w, lp, 3)
        ll += n * z
        for p, x in got.items():
            want[p] = want.get(p, 0.0) + n * x
    model = spark.createDataFrame(list(lp.items()), "piece string, lp double")
    counts, z = U.expected_counts(spark.createDataFrame(rows, "word string, n bigint").coalesce(1), model, 3)
    got = {r.piece: r.c for r in counts.collect()}
    assert abs(z - ll) < 1e-9 * abs(ll) and got.keys() == want.keys()
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)
    seen = []
    plain = U.forward_backward
    monkeypatch.setattr(U, "forward_backward", lambda w, *rest: seen.append(w) or plain(w, *rest))
    import numpy as np

    place, probs = {p: k for k, p in enumerate(lp)}, np.append(np.exp(list(lp.values())), 0.0)
    word, at, c, z = U._sums_of_equal_length(words[:4], place, probs, 3)
    assert not seen and all(abs(a - plain(w, lp, 3)[1]) < 1e-9 for a, w in zip(z, words))
    assert {(word[i], at[i]) for i in range(len(c))} == {(k, place[p]) for k, w in enumerate(words[:4]) for p in plain(w, lp, 3)[0]}
    *none, z = U._sums_of_equal_length(["x"], place, probs, 3)
    assert [len(x) for x in none] == [0, 0, 0] and z[0] == U.NEG


def test_sums_have_the_digits_of_one_word_after_another(spark):
    rng = random.Random(8)
    rows = [("".join(rng.choice("abc") for _ in range(rng.randint(1, 14))), rng.randint(1, 50)) for _ in range(500)] + [("ab" * 25, 3)]
    want = {}
    for w, n in rows:
        for p, x in U.forward_backward(w, LP, 4)[0].items():
            want[p] = want.get(p, 0.0) + n * x
    model = spark.createDataFrame(list(LP.items()), "piece string, lp double")
    counts, _ = U.expected_counts(spark.createDataFrame(rows, "word string, n bigint").coalesce(1), model, 4)
    assert {r.piece: r.c for r in counts.collect()} == want


@pytest.mark.parametrize("size", [0, 1, 5, 9, 10_000])
def test_the_best_seeds_with_ties(spark, size):
    words = {"abc": 2, "abd": 2, "xyz": 5, "q": 1}
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    freq = plain_seeds(words.items(), 16)
    top = sorted((p for p in freq if len(p) > 1), key=lambda p: (-freq[p] * len(p), p))[:size]
    assert {r.piece for r in U.initial_model(df, size).collect()} == {*top, *(p for p in freq if len(p) == 1)}


def test_words_of_one_length_are_segmented_together():
    rng = random.Random(5)
    pieces = ["a", "b", "ab", "ba", "aba", "bab", "abab", "bb"]
    for _ in range(20):
        lp = {p: -rng.randint(1, 6) / 2 for p in pieces if p != "b" or rng.random() < 0.5}  # ties are frequent
        m = EN.TokenModel("unigram", ids={p: k + 4 for k, p in enumerate(lp)}, unk_id=0, scores=lp, max_piece=4)
        words = sorted({"".join(rng.choice("abx") for _ in range(rng.randint(0, 9))) for _ in range(200)} | {"ab" * 20})
        for w, got in zip(words, EN.encode_many(m, words)):
            assert memoryview(got).cast("q").tolist() == m.encode_word(w), w
    none = EN.TokenModel("unigram", unk_id=7)
    assert EN.encode_many(none, ["ab"]) == [b"".join(x.to_bytes(8, "little") for x in none.encode_word("ab"))]


def test_pieces_are_found_by_their_hashes():
    from maskweave.operators.pieces import PieceTable, points_of, spans_of

    rng = random.Random(3)
    pieces = sorted({"".join(rng.choice("abc\u2581\U0001F600") for _ in range(rng.randint(1, 5))) for _ in range(300)})
    place, table = {p: k for k, p in enumerate(pieces)}, PieceTable(pieces)
    for size in (1, 4, 9):
        words = ["".join(rng.choice("abcx\u2581\U0001F600") for _ in range(size)) for _ in range(50)]
        at = table.edges(points_of(words), 5)
        want = [[place.get(w[s:e], len(pieces)) for w in words] for s, e in spans_of(size, 5)]
        assert at.tolist() == want
    assert PieceTable([]).edges(points_of(["ab"]), 2).tolist() == [[0], [0], [0]]


def test_a_lattice_serves_models_with_fewer_pieces(spark, monkeypatch):
    """Repeated pieces, long words and several blocks; the sums are those of
    one word after another."""
    rng = random.Random(4)
    rows = [("".join(rng.choice("ab") for _ in range(rng.randint(1, 12))), rng.randint(1, 50)) for _ in range(300)] + [("ab" * 25, 3)]
    words = spark.createDataFrame(rows, "word string, n bigint").coalesce(1)
    lp = {"a": -1.0, "b": -1.5, "ab": -2.0, "ba": -2.5, "aba": -3.0, "bbb": -3.5}
    monkeypatch.setattr(U, "BLOCK", 64)
    lat = U.lattice(words, spark.createDataFrame(list(lp.items()), "piece string, lp double"), 4)
    assert lat.table.count() >= 1 and "word" not in lat.table.columns
    for left in (lp, {p: v + 0.1 for p, v in lp.items() if p != "ab"}):
        want = {}
        for w, n in rows:
            for p, x in U.forward_backward(w, left, 4)[0].items():
                want[p] = want.get(p, 0.0) + n * x
        counts, _ = U.expected_counts(lat, spark.createDataFrame(list(left.items()), "piece string, lp double"))
        assert {r.piece: r.c for r in counts.collect()} == want
    with pytest.raises(ValueError, match="lacks"):
        U.expected_counts(lat, spark.createDataFrame([("zz", -1.0)], "piece string, lp double"))


def test_partial_sums_do_not_grow_with_the_partitions(spark):
    words = spark.createDataFrame([("ab" * (1 + k % 5), 1) for k in range(400)], "word string, n bigint").repartition(200)
    model = spark.createDataFrame([("a", -1.0), ("b", -1.0)], "piece string, lp double")
    seen = []
    plain = U.materialize
    try:
        U.materialize = lambda df, name: seen.append(df._jdf.queryExecution().executedPlan().toString()) or plain(df, name)
        counts, _ = U.expected_counts(words, model, 4)
    finally:
        U.materialize = plain
    assert {r.piece: r.c for r in counts.collect()} == {"a": 1200.0, "b": 1200.0}
    assert f"Coalesce {max(U.SUM_TASKS, spark.sparkContext.defaultParallelism)}" in seen[0]
