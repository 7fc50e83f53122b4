"""Embedding near-duplicates, the conversation trie and fill-in-middle: SQL,
brute force, edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from test_oracles import rows_of

import __spark_entry__ as E
from maskweave.llm import fill_middle, prefix_trie, vector_dedup


@pytest.mark.parametrize("name", ["op11_embedding_dedup", "op12_conversation_trie", "op13_fill_in_middle"])
def test_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck(SF_SMALL).execute(E.oracle_sql()[name])
    assert got == rows_of([d[0] for d in res.description], res.fetchall())


# ---------------------------------------------------------------- vectors

BAD = [(6001, None), (6002, []), (6003, [0.0] * 16), (6004, [None] + [1.0] * 15), (6005, [math.nan] * 16),
       (6006, [math.inf] * 16)]


def brute_vectors(rows, threshold):
    ids = [i for i, _ in rows]
    unit = [np.array(x) / np.abs(x).max() for _, x in rows]
    unit = [x / np.sqrt(x @ x) for x in unit]
    low, count = {i: i for i in ids}, [0] * len(rows)

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                count[a] += 1
                count[b] += 1
                x, y = find(ids[a]), find(ids[b])
                low[max(x, y)] = min(x, y)
    return sorted((i, n, find(i), find(i) == i) for i, n in zip(ids, count))


def test_vectors_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "LEAST_BLOCK", 40)
    rng = np.random.default_rng(0)
    base = rng.normal(size=(30, 16))
    rows = [(3 * i, (base[rng.integers(30)] + rng.normal(size=16) * rng.choice([0.05, 0.15, 0.25, 0.5])).tolist())
            for i in range(500)]
    rows += [(2 * i + 1, rows[i % 3][1]) for i in range(150)]  # copies of hot vectors; some ids have two vectors
    rows += [(5001, [1.0, 2.0]), (5002, [2.0, 4.0]), (5003, [1e200, 2e200]), (5004, [-1.0, -2.0]), (7, [1.0, 2.0]),
             (9, [1.0]), (9, [1.0])]
    df = spark.createDataFrame(rows + BAD + [(None, rows[0][1])], "vec_id long, embedding array<double>").repartition(3)
    got = [tuple(r) for r in vector_dedup.groups(df).collect()]
    odd = {i for i, _ in BAD} | {None}
    assert sorted(r for r in got if r[0] not in odd) == brute_vectors(rows, 0.95)
    assert sorted((r for r in got if r[0] in odd), key=str) == sorted(((i, 0, i, True) for i in odd), key=str)


def test_vectors_edges(spark):
    schema = "vec_id int, embedding array<float>, n_links string, kept string, digest string"
    df = spark.createDataFrame([(1, [1.0, 0.0], "a", "b", "c"), (2, [1.0, 0.1], "a", "b", "c"), (3, None, None, None, None)],
                               schema)
    got = vector_dedup.groups(df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert vector_dedup.groups(df.limit(0)).count() == 0
    assert vector_dedup.groups(df.where("vec_id = 3")).count() == 1
    with pytest.raises(ValueError):
        vector_dedup.groups(df, threshold=0)


def test_links_equal_full_products(monkeypatch):
    monkeypatch.setattr(vector_dedup, "ROWS", 16)
    monkeypatch.setattr(vector_dedup, "COLUMNS", 24)
    rng = np.random.default_rng(1)
    for dim in (3, 8, 40):
        x = vector_dedup.unit_rows(rng.normal(size=(70, dim)))
        x[20:50] = vector_dedup.unit_rows(x[20] + rng.normal(size=(30, dim)) * 0.2 / dim ** 0.5)
        axes = np.linalg.eigh(x.T @ x)[1][:, ::-1].copy()
        found = np.zeros((70, 70), bool)
        for r, c, mask in vector_dedup.links(x, x, axes, 0.9):
            found[np.ix_(r, c)] |= mask
        assert (found == (x @ x.T >= 0.9)).all()


def test_a_tile_gives_a_forest_not_all_pairs():
    """Links of a tile grow in proportion to its vectors."""
    sizes = []
    for n in (100, 200, 400):
        x = vector_dedup.unit_rows(np.ones((n, 8)) + np.random.default_rng(2).normal(size=(n, 8)) * 0.02)
        tile = pa.table({"i": [0] * n, "j": [0] * n, "own": [0] * n, "pos": range(n), "rep": range(n), "copies": [1] * n,
                         "dim": [8] * n, "vector": pa.array([v.tobytes() for v in x], pa.binary())})
        out = vector_dedup._compare(type("Axes", (), {"value": {}}), 0.9)(tile)
        sizes.append(out.num_rows)
        assert sum(v is not None for v in out["v"].to_pylist()) == n - 1
        assert out["n"].to_pylist()[:n] == [n - 1] * n
    assert sizes == [199, 399, 799]


# ---------------------------------------------------------------- conversations

def brute_trie(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append(((t is not None, t or 0), hashlib.md5(f"{len(r.encode())}:{r}{x}".encode()).hexdigest(), (r, x)))
    own = {c: [k[2] for k in sorted(v)] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:])
    members, children, leaves, saved = defaultdict(list), defaultdict(set), defaultdict(int), defaultdict(int)
    for c, s in built.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
            if d:
                children[s[:d - 1]].add(s[:d])
    for s, m in members.items():
        w = len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0
        for d in range(len(s) + 1):
            saved[s[:d]] += (len(m) - 1) * w
            leaves[s[:d]] += not children.get(s)
    return sorted(((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), len(children.get(s, ())), leaves[s],
                    saved[s], hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == len(s)))).encode())
                    .hexdigest()) for s, m in members.items()), key=str)


@pytest.mark.parametrize("least", [1 << 14, 300, 40])
def test_trie_brute_force(spark, monkeypatch, least):
    """One range, and several levels of ranges."""
    monkeypatch.setattr(prefix_trie, "LEAST", least)
    monkeypatch.setattr(prefix_trie, "MOST", least)
    monkeypatch.setattr(prefix_trie, "CHUNK", 16)
    rng, rows = random.Random(3), []
    for c in range(400):
        if c % 37:
            for t in range(rng.choice([1, 2, 3, 5, 9])):
                rows.append((c if c % 5 else -c, rng.choice([t, t, None]) if c % 11 == 0 else t,
                             rng.choice(["user", "assistant", None]), rng.choice(["a", "b c", "a  b\tc", None, "", "é x"])))
    rows += [(10_000 + i, t, "user", "same text") for i in range(100) for t in range(20)]  # copies, a hot first turn
    rows += [(20_000, t, "user", "long") for t in range(90)] + [(None, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    assert sorted((tuple(r) for r in prefix_trie.conversation_trie(df).collect()), key=str) == brute_trie(rows)


def test_trie_edges(spark):
    schema = "conv_id int, turn int, role string, text string, key string, path string"
    rows = [(1, 0, "u", "x " * 300_000, "k", "p"), (1, 0, "u", "x " * 300_000, None, "p")]
    df = spark.createDataFrame(rows, schema)
    got = prefix_trie.conversation_trie(df)
    assert sorted(tuple(r)[:7] for r in got.collect()) == [tuple(r)[:7] for r in brute_trie([r[:4] for r in rows])]
    assert prefix_trie.conversation_trie(df.limit(0)).count() == 0
    only = spark.createDataFrame([(21, 0, "u", "t")], "conv_id long, turn long, role string, text string")
    lost = [r for r in prefix_trie.conversation_trie(only).collect()]  # its turn is cut off, there is no base
    assert [tuple(r) for r in lost] == brute_trie([(21, 0, "u", "t")])


def test_extents_need_no_neighbours():
    lcp = np.array([-1, 2, 0, 3, 3, 1, 4])
    minima = prefix_trie.RangeMinima(lcp)
    for row in range(7):
        for depth in range(6):
            left, right = row, row
            while left > 0 and lcp[left] >= depth:
                left -= 1
            while right < 6 and lcp[right + 1] >= depth:
                right += 1
            assert minima.left(np.array([row]), np.array([depth]))[0] == left
            assert minima.right(np.array([row]), np.array([depth]))[0] == right


# ---------------------------------------------------------------- fill-in-middle

def brute_middle(key, text, rate, spm, seed=7):
    u = re.findall(r"[^\n]*\n|[^\n]+", text or "")
    hexes = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(hexes[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(x in text for x in fill_middle.SENTINELS) or h[2] % 100 >= rate:
        return key, len(u), "plain", None, None, text or ""
    if h[3] % 100 < spm:
        return key, len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return key, len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("rate,spm", [(100, 50), (60, 0), (0, 50), (100, 100)])
def test_middle_brute_force(spark, rate, spm):
    rng = random.Random(1)
    texts = [None, "", "a", "a\n", "\n", "\n\n", "x<P>y", "é\nü", "<\nP>\n<S", "<S", "a\r\nb", "z\n" * 200_000,
             *("".join(rng.choice("ab\n<é\U0001f600") for _ in range(rng.randint(0, 30))) for _ in range(200))]
    rows = [(k if k != 5 else None, t, "n", "f") for k, t in enumerate(texts)] + [(1, "a\nb", "n", "f")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, n string, form string")
    out = fill_middle.transform(df, rate=rate, spm=spm)
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(
        (brute_middle(k, t, rate, spm) for k, t, _, _ in rows), key=str)
    back = fill_middle.restore(out).select("doc_id", "restored").collect()
    assert sorted(map(tuple, back), key=str) == sorted(((k, t or "") for k, t, _, _ in rows), key=str)
    assert fill_middle.restore(fill_middle.transform(df.limit(0))).count() == 0


def test_middle_units_and_sentinels(spark):
    df = spark.createDataFrame([("k", "one two three four")], "doc_id string, text string")
    row = fill_middle.restore(fill_middle.transform(df, separator=" ", seed=1)).first()
    assert row.n == 4 and row.restored == "one two three four"
    for bad in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("ab", "b", "c")):
        with pytest.raises(ValueError):
            fill_middle.transform(df, sentinels=bad)
