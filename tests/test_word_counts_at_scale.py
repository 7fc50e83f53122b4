"""Words are counted before they are looked into, packed and encoded many at a time."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from maskweave.functions import text as TX
from maskweave.operators import encode as EN
from maskweave.operators import merge_rounds as R
from maskweave.operators import merges as M
from maskweave.operators import words as WD

TEXTS = ["a b  a", None, "", " ", "a\tb\n\na,b", "x y　x ", "é\U0001d538.. .é", "a b  a", "##a # ##"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(t,) for t in TEXTS], "text string").cache()


def test_stretches_between_spaces_are_counted_first(spark, rows):
    words = WD.wordpiece_words(rows)
    plan = words._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("sum(n") < plan.index("regexp_extract_all") < plan.index("count(1)")  # the scan stands last
    want = WD.count_words(rows, TX.whitespace_words("text"))
    assert {tuple(r) for r in words.collect()} == {tuple(r) for r in want.collect()}


def test_no_word_table_is_written_for_an_alphabet(spark, rows):
    model = M.learn_merges(WD.wordpiece_words(rows), "wordpiece", max_merges=0)
    assert not {"words", "pairs"} & set(vars(model.words))
    assert model.words.words.count() > 0 and model.words.pairs.count() > 0  # still there for who asks
    model.release()


@pytest.mark.parametrize("kind", M.KINDS)
def test_packed_words_are_their_symbols(spark, kind):
    words = ["a", "ab", "#", "a##", "é\U0001d538", "\U0001d538aéb", " "]
    df = spark.createDataFrame([(w, k + 1) for k, w in enumerate(words)], "word string, n bigint").coalesce(2)
    names = M.alphabet_pieces(df, kind)
    table = {r.n: r.s for r in M.word_table(df, kind).select("n", WD.symbols(F.col("sy")).alias("s")).collect()}
    if kind != "byte":
        got = {s for syms in table.values() for s in syms}
        bare = {s.removeprefix("##") for s in got if len(s) > 1}
        assert names == sorted(got | bare, key=lambda s: (s.startswith("##"), s))
    packed = R.Words(df.mapInArrow(lambda b: R.pack({s: i for i, s in enumerate(names)}, kind, "##" if kind == "wordpiece" else "")(b),
                                   "word binary, n long"))
    for r in packed.words.collect():
        assert [names[i] for i in np.frombuffer(r.word, "<i4")] == table[r.n]
    packed.release()


@pytest.mark.parametrize("table", [0, 1 << 24])
def test_wordpieces_side_by_side(monkeypatch, table):
    monkeypatch.setattr(EN, "MAX_TABLE", table)
    rng = random.Random(3)
    for _ in range(25):
        signs = "ab#é\U0001d538c."
        pieces = {"".join(rng.choice(signs) for _ in range(rng.randint(1, 4))) for _ in range(25)}
        pieces |= {"##" + p for p in pieces if rng.random() < 0.5} | {rng.choice(["##", "a", "[UNK]"])}
        m = EN.TokenModel("wordpiece", ids={p: i + 1 for i, p in enumerate(sorted(pieces))}, unk_id=0,
                          max_word_chars=rng.choice([None, 100, 5]))
        words = sorted({"".join(rng.choice("abc" if rng.random() < 0.7 else signs + "x") for _ in range(rng.choice([1, 3, 8, 130])))
                        for _ in range(150)} | {"  ", " \t", "##ab", "##"})
        ids, lens = EN.wordpieces(m, pa.array(words))
        for w, got in zip(words, np.split(ids, np.cumsum(lens)[:-1])):
            assert got.tolist() == ([] if TX.is_gap(w, "wordpiece") else m.encode_word(w)), w
    assert [len(x) for x in EN.wordpieces(m, pa.array([], pa.string()))] == [0, 0]
