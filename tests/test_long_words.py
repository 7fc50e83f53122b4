"""Long unbroken words: the heap gives the ids of the plain rule, in time."""

import random
import time

import pytest

from maskweave.operators import encode as EN


def model(rng, symbols, merges, kind="bpe"):
    ranks, known = {}, list(symbols)
    while len(ranks) < merges:
        p = (rng.choice(known), rng.choice(known))
        if p not in ranks and len(p[0] + p[1]) < 12:
            ranks[p] = len(ranks) + 1
            known.append(p[0] + p[1])
    return EN.TokenModel(kind=kind, ids={s: i for i, s in enumerate(dict.fromkeys(known))}, ranks=ranks)


@pytest.mark.parametrize("seed", range(6))
def test_heap_equals_the_plain_rule(monkeypatch, seed):
    rng = random.Random(seed)
    m = model(rng, "abc"[:2 + seed % 2], 12 + 10 * seed)
    for _ in range(150):
        w = "".join(rng.choice("aabc") for _ in range(rng.randint(1, 40)))
        monkeypatch.setattr(EN, "LONG_WORD", 1000)
        want = m.encode_word(w)
        monkeypatch.setattr(EN, "LONG_WORD", 0)
        assert m.encode_word(w) == want, w


def test_a_megabyte_without_a_break():
    rng = random.Random(1)
    m = model(rng, "abcdefgh", 500)
    w = "".join(rng.choice("abcdefgh") for _ in range(1 << 20))
    t = time.time()
    ids = m.encode_word(w)
    assert time.time() - t < 60 and len(ids) < len(w)
    names = {i: s for s, i in m.ids.items()}
    assert "".join(names[i] for i in ids) == w
