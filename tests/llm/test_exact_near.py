"""Exact and near duplicates: SQL, brute force, edge cases."""

import itertools
import random
import re

import numpy as np
import pytest
from conftest import SF_SMALL
from test_oracles import rows_of

import __spark_entry__ as E
from maskweave.llm import exact_dedup, near_dedup
from maskweave.llm.common import components, word_slices

SCHEMA = "doc_id long, text string, kept string, digest string"


@pytest.mark.parametrize("name", ["op5_exact_dedup", "op6_suffix_dedup", "op7_warc", "op9_near_dedup"])
def test_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck(SF_SMALL).execute(E.oracle_sql()[name])
    assert got == rows_of([d[0] for d in res.description], res.fetchall())


def edge(spark):
    return spark.createDataFrame([
        (1, None, "x", "d"), (2, "", "x", "d"), (3, "a b c d e f", None, None), (3, "a b c d e f", "y", "d"),
        (9, "a b c d e f", "z", "d"), (5, "A b c d e f", "z", "d"), (None, "solo", "z", "d"), (4, "solo", "z", "d"),
        (7, "x " * 40_000 + "end", "z", "d"), (8, "x " * 40_000 + "end", "z", "d")], SCHEMA)


def test_exact_edges(spark):
    rows = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.classify(edge(spark)).collect()}
    assert rows == {(1, 2, 2, False), (2, 2, 2, True), (3, 9, 3, False), (9, 9, 3, True), (5, 5, 1, True),
                    (None, 4, 2, False), (4, 4, 2, True), (7, 8, 2, False), (8, 8, 2, True)}
    kept = exact_dedup.deduplicate(edge(spark))
    assert kept.columns == ["doc_id", "text", "kept", "digest"]
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 8, 9]
    assert exact_dedup.classify(edge(spark).limit(0)).count() == 0


def test_repeated_keeper_stays_once(spark):
    df = spark.createDataFrame([(2, "t", "a", "b"), (2, "t", "a", "b"), (1, "t", "a", "b")], SCHEMA)
    assert [r.doc_id for r in exact_dedup.deduplicate(df).collect()] == [2]


def test_index_grows_by_deliveries(spark, tmp_path):
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), buckets=4)
    first = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    second = spark.createDataFrame([(3, "b"), (4, "c")], "doc_id long, text string")
    assert sorted(r.doc_id for r in exact_dedup.deduplicate(first, index).collect()) == [1, 2]
    again = exact_dedup.DigestIndex(spark, index.path, buckets=4)  # opened anew
    assert sorted(r.doc_id for r in exact_dedup.deduplicate(second, again).collect()) == [4]
    assert again.table().count() == 3


def test_exact_plan_is_native_and_does_not_shuffle_the_index(spark):
    index = exact_dedup.DigestIndex(spark, buckets=4)
    index.add(exact_dedup.digests(edge(spark)))
    plan = exact_dedup.digests(edge(spark)).join(
        index.table(), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_groups(docs, size, percent):
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k:k + size]) for k in range(max(len(w) - size + 1, 1 if w else 0))}
    low = {i: i for i in sets}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            low[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_near_brute_force_with_large_near_group(spark):
    rnd = random.Random(3)
    base = [f"w{rnd.randrange(5000)}" for _ in range(120)]
    docs = []
    for i in range(300):  # one family whose members drift apart, and others
        w = list(base)
        for _ in range(rnd.randrange(0, 9)):
            w[rnd.randrange(len(w))] = f"q{rnd.randrange(10 ** 6)}"
        docs.append((i * 3 % 301, " ".join(w)))
    docs += [(1000 + i, " ".join(f"w{rnd.randrange(300)}" for _ in range(60))) for i in range(50)]
    docs += [(2000, "One two"), (2001, "one  TWO"), (2002, "one"), (2003, None), (2004, " \t")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_groups(df, 4, 80).collect()}
    assert got == brute_groups(docs, 4, 80)


def test_near_edges(spark):
    rows = {(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_groups(edge(spark)).collect()}
    assert rows == {(1, 1, True), (2, 2, True), (3, 3, True), (9, 3, False), (5, 3, False), (None, None, True),
                    (4, 4, True), (7, 7, True), (8, 7, False)}
    assert near_dedup.near_groups(edge(spark).limit(0)).count() == 0
    kept = near_dedup.deduplicate(edge(spark))
    assert kept.columns == ["doc_id", "text", "kept", "digest"]


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(5)
    x = rng.integers(1, 2 ** 63, 1200, dtype=np.uint64)
    both = np.concatenate([np.sort(x[:1000]), np.sort(x[200:])])
    sig = near_dedup.superminhash(both, np.array([1000, 1000, 0]), 512)
    assert abs((sig[0] == sig[1]).mean() - 800 / 1200) < 0.08
    assert (sig[2] == near_dedup.EMPTY).all()


def test_superminhash_of_small_sets_like_plain_ranks():
    rng = np.random.default_rng(8)
    counts = np.array([1, 2, 10, 16, 20, 28])
    elements = np.concatenate([np.sort(rng.integers(1, 2 ** 63, n, dtype=np.uint64)) for n in counts])
    m, bits = near_dedup.LONG, 22
    got, at = near_dedup.superminhash(elements, counts, m), 0
    for k, n in enumerate(counts):
        want = [1 << 40] * m
        for e in elements[at:at + n]:
            perm = list(range(m))
            for j in range(m):
                x = int(near_dedup.mix(np.array([e]) + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))[0])
                i = j + ((x & 0xFFFFFFFF) * (m - j) >> 32)
                perm[i], perm[j] = perm[j], perm[i]
                want[perm[j]] = min(want[perm[j]], j << bits | x >> 64 - bits)
        assert got[k].tolist() == want
        at += n


def test_components_brute_force(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 360)]
    got = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    low = {x: x for e in edges for x in e}
    for _ in range(len(low)):
        for u, v in edges:
            low[u] = low[v] = min(low[u], low[v])
    assert got == {x: c for x, c in low.items() if x != c}


def test_word_slices_cut_long_texts_alike():
    import pyarrow as pa

    texts = ["", None, "A b\x0bc", "x" * 300 + " y", "é  ü " * 50]
    want = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    out = {}
    for most in (16, 1 << 20):
        h, n = [], []
        for _, _, a, b in word_slices(pa.array(texts), most):
            h += a.tolist()
            n += b.tolist()
        out[most] = h
        assert n == want
    assert out[16] == out[1 << 20]


def family(n, seed, words=24, changed=1):
    """Texts of one base, each with ``changed`` words changed: pairs around the threshold."""
    rng = random.Random(seed)
    base = [f"w{seed}x{k}" for k in range(words)]
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(changed):
            w[rng.randrange(words)] = f"n{seed}x{k}x{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("size,words,changed", [(5, 24, 1), (4, 24, 1), (5, 40, 1), (4, 60, 2), (5, 18, 1)])
def test_families_around_the_threshold(spark, monkeypatch, size, words, changed):
    """Links between members none of which need be the pivot; blocks of ten."""
    monkeypatch.setattr(near_dedup, "MEMBERS", 10)
    texts = [t for s in range(3) for t in family(40, s, words, changed)]
    docs = [(k, t) for k, t in enumerate(texts)]
    random.Random(7).shuffle(docs)
    got = near_dedup.near_groups(spark.createDataFrame(docs, "doc_id long, text string"), size, 80).collect()
    want = brute_groups(docs, size, 80)
    assert {r.doc_id: r.component_id for r in got} == {k: v[1] for k, v in want.items()}


def test_tasks_give_a_forest():
    """What leaves a comparing task grows with the members, not their pairs."""
    for n in (200, 400, 800):
        sets = []
        for t in family(n, 1):
            w = t.split()
            sets.append(np.unique([hash(tuple(w[k:k + 5])) for k in range(20)]))
        at = np.arange(n)
        loose = list(near_dedup.forest(sets, at, at, at, 55))
        assert len(loose) <= n - 1
        group = list(range(n))
        for i, j in loose:
            group = [group[i] if g == group[j] else g for g in group]
        low = list(range(n))
        for i in range(n):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 55 * (len(sets[i]) + len(sets[j]) - both) and low[i] != low[j]:
                    low = [low[i] if g == low[j] else g for g in low]
            if n > 200:
                break
        if n == 200:
            assert len(set(low)) == len(set(group))


def test_pairs_that_join_sets_grow_in_proportion(spark, monkeypatch):
    """Families just below the threshold: rows joined to sets are a few a member."""
    seen = []
    plain = near_dedup._verify

    def counted(pairs, sets, percent):
        seen[-1] += pairs.count()
        return plain(pairs, sets, percent)

    monkeypatch.setattr(near_dedup, "_verify", counted)
    for n in (200, 400, 800):
        seen.append(0)
        docs = spark.createDataFrame(list(enumerate(family(n, 5))), "doc_id long, text string")
        near_dedup.near_groups(docs, 5, 80).count()
    print(seen)
    assert seen[1] <= 2.5 * seen[0] and seen[2] <= 2.5 * seen[1]


def test_large_sets_are_sketched_in_parts(monkeypatch):
    rng = np.random.default_rng(0)
    counts = np.array([3, 5000, 0, 40, 2500])
    elements = rng.integers(0, 1 << 62, counts.sum()).astype(np.uint64)
    for m in (near_dedup.REGISTERS, near_dedup.LONG):
        want = near_dedup.superminhash(elements, counts, m)
        monkeypatch.setattr(near_dedup, "PART", 1000)
        got = np.concatenate([x for _, _, x in near_dedup.signatures(elements, counts, m)])
        assert (got == want).all()
