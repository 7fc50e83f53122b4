"""Merge learning: the batched Spark trainer equals a plain one-merge-at-
a-time reference written here, at depth."""

import heapq
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from maskweave.catalog.common import docs
from maskweave.operators import merge_rounds as R
from maskweave.operators import merges as M
from maskweave.operators import words as WD


def brute_merges(word_counts, kind, n_merges, min_n=2):
    words = []
    for w, n in word_counts:
        if kind == "wordpiece":
            syms = [w[0]] + ["##" + c for c in w[1:]]
        else:
            syms = list(w)
        words.append((syms, n))
    out = []
    for rank in range(1, n_merges + 1):
        pairs = Counter()
        for syms, n in words:
            for a, b in zip(syms, syms[1:]):
                pairs[(a, b)] += n
        if not pairs:
            break
        (a, b), cnt = min(pairs.items(), key=lambda kv: (-kv[1], kv[0][0], kv[0][1]))
        if cnt < min_n:
            break
        m = M.merged_name(a, b, kind)
        out.append((rank, a, b, m, cnt))
        new = []
        for syms, n in words:
            i, s2 = 0, []
            while i < len(syms):
                if i + 1 < len(syms) and syms[i] == a and syms[i + 1] == b:
                    s2.append(m)
                    i += 2
                else:
                    s2.append(syms[i])
                    i += 1
            new.append((s2, n))
        words = new
    return out


def indexed_merges(word_counts, kind, n_merges, min_n=2):
    """As brute_merges, fast: counts kept up to date, words found by pair."""
    words = []
    for w, n in word_counts:
        syms = [w[0]] + ["##" + c for c in w[1:]] if kind == "wordpiece" else list(w)
        words.append((syms, n))
    count, where = Counter(), defaultdict(set)
    for i, (syms, n) in enumerate(words):
        for p in zip(syms, syms[1:]):
            count[p] += n
            where[p].add(i)
    heap = [(-c, p) for p, c in count.items()]
    heapq.heapify(heap)
    out = []
    while heap and len(out) < n_merges:
        c, p = heapq.heappop(heap)
        if count.get(p, 0) != -c:
            continue
        if -c < min_n:
            break
        m = M.merged_name(*p, kind)
        out.append((len(out) + 1, *p, m, -c))
        change = Counter()
        for i in list(where[p]):
            syms, n = words[i]
            new, k = [], 0
            while k < len(syms):
                if tuple(syms[k:k + 2]) == p:
                    new.append(m)
                    k += 2
                else:
                    new.append(syms[k])
                    k += 1
            for q in zip(syms, syms[1:]):
                change[q] -= n
            for q in zip(new, new[1:]):
                change[q] += n
                where[q].add(i)
            words[i] = (new, n)
        for q, d in change.items():
            if d:
                count[q] += d
                heapq.heappush(heap, (-count[q], q))
                if not count[q]:
                    del count[q]
    return out


def learned(model):
    rows = [tuple(r) for r in model.merges.orderBy("rank").collect()]
    model.release()
    return rows


@pytest.mark.parametrize("kind,per_round", [("wordpiece", 128), ("bpe", 48)])
def test_batched_equals_one_at_a_time(spark, kind, per_round):
    d = docs(spark, SF_SMALL)
    wc = WD.wordpiece_words(d) if kind == "wordpiece" else WD.sp_words(d)
    local = [(r["word"], r["n"]) for r in wc.collect()]
    want = brute_merges(local, kind, 400)
    assert indexed_merges(local, kind, 400) == want
    assert learned(M.learn_merges(wc, kind, max_merges=400, per_round=per_round)) == want


@pytest.mark.parametrize("kind", ["wordpiece", "bpe"])
def test_a_whole_vocabulary_equals_one_at_a_time(spark, kind):
    """8,000 merges, down to pairs that tie by the thousand."""
    d = docs(spark, SF_MID)
    wc = (WD.wordpiece_words(d) if kind == "wordpiece" else WD.sp_words(d)).cache()
    want = indexed_merges([(r["word"], r["n"]) for r in wc.collect()], kind, 8000)
    assert learned(M.learn_merges(wc, kind, vocab_size=None, max_merges=8000)) == want
    wc.unpersist()


def counted(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n bigint")


def test_merges_with_few_runs_in_one_place(spark, monkeypatch):
    """Rounds that must look at fewer pairs, and rounds where all tie."""
    rng = random.Random(5)
    words = {"".join(rng.choice("abcde") for _ in range(rng.randint(1, 9))): rng.choice([1, 1, 2, 3, 50])
             for _ in range(80)}
    words |= {"aaaaaaa": 9, "bababab": 9, "#": 3, "a##b": 2}
    want = indexed_merges(list(words.items()), "wordpiece", 10 ** 6)
    assert want == brute_merges(list(words.items()), "wordpiece", 10 ** 6)
    for most, merges in ((150_000, len(want)), (20, 40), (1, 8)):
        monkeypatch.setattr(R, "MAX_RUNS", most)
        got = learned(M.learn_merges(counted(spark, words), "wordpiece", vocab_size=None, per_round=64, max_merges=merges))
        assert got == want[:merges]


def test_a_symbol_that_exists_ends_a_round(spark):
    """Two ways to one symbol: (a, bc) and (ab, c) both give abc."""
    words = {"xabc": 30, "abcx": 29, "ab": 100, "bc": 90, "qab": 80, "bcq": 70, "zabcz": 20, "abz": 60, "abcc": 5}
    want = brute_merges(list(words.items()), "bpe", 50)
    assert learned(M.learn_merges(counted(spark, words), "bpe", vocab_size=None)) == want


def test_runs_and_what_is_put_back():
    ids = np.array([1, 2, 3, 1, 2, 1, 1, 1, 4], np.int32)
    off = np.array([0, 3, 5, 5, 9])
    hot = np.sort(np.array([1 << 32 | 2, 1 << 32 | 1]))
    first, end = R.runs(ids, off, hot)
    assert [ids[a:z].tolist() for a, z in zip(first, end)] == [[1, 2], [1, 2], [1, 1, 1]]
    pack = lambda *x: np.array(x, "<i4").tobytes()
    new, ends, changed = R.replace(ids, off, hot, {pack(1, 2): pack(9), pack(1, 1, 1): pack(8, 1)})
    assert new.tolist() == [9, 3, 9, 8, 1, 4] and ends.tolist() == [0, 2, 3, 3, 6]
    assert changed.tolist() == [True, True, False, True]


def test_pair_counts_stay_exact(spark):
    """After any number of merges the table of pairs is a recount of the words."""
    wc = WD.wordpiece_words(docs(spark, SF_SMALL))
    for merges in (1, 37, 300):
        model = M.learn_merges(wc, "wordpiece", vocab_size=None, max_merges=merges, per_round=32)
        kept = {r.code: r.n for r in model.words.pairs.collect()}
        recount = Counter()
        for r in model.words.words.collect():
            w = np.frombuffer(r.word, "<i4").tolist()
            for a, b in zip(w, w[1:]):
                recount[a << 32 | b] += r.n
        assert kept == recount
        model.release()


def test_learning_stops_at_the_minimum_frequency(spark):
    wc = WD.wordpiece_words(docs(spark, SF_SMALL))
    local = [(r["word"], r["n"]) for r in wc.collect()]
    for least in (500, 60):
        want = indexed_merges(local, "wordpiece", 10 ** 6, least)
        got = learned(M.learn_merges(wc, "wordpiece", vocab_size=None, min_pair_n=least))
        assert got == want and got[-1][4] >= least


def test_no_words(spark):
    none = spark.createDataFrame([], "word string, n bigint")
    assert learned(M.learn_merges(none, "wordpiece")) == []


def test_vocab_size_stop_and_unique_pieces(spark):
    wc = WD.wordpiece_words(docs(spark, SF_SMALL))
    base = M.learn_merges(wc, "wordpiece", max_merges=0).vocab.count()
    model = M.learn_merges(wc, "wordpiece", vocab_size=base + 50)
    v = model.vocab
    assert v.count() == base + 50
    assert v.select("piece").distinct().count() == v.count()
    ids = [r["id"] for r in v.orderBy("id").collect()]
    assert ids == list(range(len(ids)))
    specials = [r["piece"] for r in v.filter(F.col("role").isNotNull()).orderBy("id").collect()]
    assert specials == ["[UNK]", "[SEP]", "[PAD]", "[CLS]", "[MASK]"]


def test_choose_round_rule():
    rows = [{"left": "a", "right": "b", "n": 10}, {"left": "c", "right": "d", "n": 9},
            {"left": "b", "right": "e", "n": 8}, {"left": "f", "right": "g", "n": 7}]
    got = M.choose_round(rows, 8, "bpe", set("abcdefg"), None, 2)
    # (b, e) can follow (a, b): stop with s = 8, keep n > 8
    assert [(t[0], t[1]) for t in got] == [("a", "b"), ("c", "d")]
    fan = [{"left": "a", "right": "b", "n": 10}, {"left": "a", "right": "c", "n": 9},
           {"left": "d", "right": "c", "n": 8}, {"left": "x", "right": "a", "n": 7}, {"left": "y", "right": "z", "n": 6}]
    # pairs that share a side never overlap in a word; (x, a) can stand before (a, b)
    assert [t[:2] for t in M.choose_round(fan, 8, "bpe", set("abcdxyz"), None, 2)] == [("a", "b"), ("a", "c"), ("d", "c")]
    tie = [{"left": "a", "right": "b", "n": 5}, {"left": "c", "right": "d", "n": 5},
           {"left": "b", "right": "x", "n": 5}]
    got = M.choose_round(tie, 8, "bpe", set("abcdx"), None, 2)
    assert [(t[0], t[1]) for t in got] == [("a", "b")]
