"""Pair-merge vocabulary learning.

The word-type table (one row per distinct word: packed symbol ids and count)
and the table of pair counts stay distributed.  A round takes the most
frequent pairs, sums the stretches of words that consist of them, makes
merges one at a time on these few rows, puts the results back into the words
and corrects the pair counts by what that changed (``merge_rounds``).  Words
left with one symbol are dropped as they occur; every round's tables are
written to the shared checkpoint folder.

Where so many pairs tie that their stretches are too many for one place, a
round takes pairs by the rule of ``choose_round``: walking down the ranked
pairs, stop at the first pair that can stand next to a taken one (its left
symbol is a taken right one, or its right a taken left one), is a self-pair,
would make a symbol that exists or was made this round, exceeds the budget,
or is the K+1-th.  With ``s`` the count of that pair, keep taken pairs with
n > s (always the first).  Taken pairs never overlap in a word, so none
changes another's count.  A merge of (l, r) makes new pairs (x, lr) and
(lr, y), which occur at most as often as (x, l) and (r, y) did; those can
stand next to a taken pair, so they were not taken and have n <= s, as has
every other pair.

Contract for ties (ours): higher n first, then left, then right, by code
point.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskweave.functions import text as TX
from maskweave.operators import merge_rounds as R
from maskweave.operators import vocab as V
from maskweave.operators import words as WD

KINDS = ("wordpiece", "bpe", "byte")


@dataclass
class MergeModel:
    kind: str
    merges: DataFrame   # rank, left, right, merged, n
    vocab: DataFrame    # id, piece, score, role
    words: R.Words      # words that still have pairs, and the pair counts, after all merges

    def release(self) -> "MergeModel":
        """Deletes the word and pair tables; merges and vocabulary stay."""
        self.words.release()
        return self


def merged_name(left: str, right: str, kind: str) -> str:
    if kind == "wordpiece" and right.startswith(TX.CONT):
        return left + right[len(TX.CONT):]
    return left + right


def word_table(word_counts: DataFrame, kind: str) -> DataFrame:
    return word_counts.select(WD.symbol_string(F.col("word"), kind).alias("sy"), "n")


def _marked_symbols(sy: Column) -> Column:
    """Symbols still carrying their open marker: a split on the close
    marker (a one-character literal split, cheaper than a regex)."""
    arr = F.split(sy, TX.SYM_CLOSE)
    return F.slice(arr, 1, F.size(arr) - 1)


def marked_pair_counts(w: DataFrame) -> DataFrame:
    """Adjacent symbol pairs weighted by word count: one shuffle over W.
    Symbols keep their open marker, which sorts and groups the same."""
    p = w.select(F.explode(WD.adjacent_pairs(_marked_symbols(F.col("sy")))).alias("p"), "n")
    return p.groupBy(F.col("p.l").alias("left"), F.col("p.r").alias("right")) \
            .agg(F.sum("n").cast("bigint").alias("n"))


def pair_counts(w: DataFrame) -> DataFrame:
    o = len(TX.SYM_OPEN)
    return marked_pair_counts(w).select(F.expr(f"substring(left, {o + 1})").alias("left"),
                                        F.expr(f"substring(right, {o + 1})").alias("right"), "n")


def choose_round(ranked: list, k: int, kind: str, known: set, budget: int | None,
                 min_pair_n: int) -> list:
    """The exact multi-merge rule; returns [(left, right, merged, n, is_new)]."""
    taken, lefts, rights, made = [], set(), set(), set()
    stop_n = None
    new_count = 0
    for idx, row in enumerate(ranked):
        l, r, n = row["left"], row["right"], row["n"]
        if n < min_pair_n:
            stop_n = n
            break
        m = merged_name(l, r, kind)
        is_new = m not in known and m not in made
        if taken:
            if (idx >= k or l in rights or r in lefts or l == r or taken[0][0] == taken[0][1] or not is_new
                    or (budget is not None and new_count + 1 > budget)):
                stop_n = n
                break
        elif budget is not None and is_new and budget <= 0:
            break
        taken.append((l, r, m, n, is_new))
        lefts.add(l)
        rights.add(r)
        made.add(m)
        new_count += int(is_new)
    if stop_n is None:
        return taken
    return [t for i, t in enumerate(taken) if i == 0 or t[3] > stop_n]


def alphabet_pieces(word_counts: DataFrame, kind: str) -> list[str]:
    """D3: every character in code-point order, then continuation forms
    (WordPiece); byte-level: 256 bytes.  Bounded by the number of distinct
    characters."""
    if kind == "byte":
        return [f"{b:02X}" for b in range(256)]
    cont = TX.CONT if kind == "wordpiece" else None
    syms = word_counts.select("word").mapInArrow(R.letters(cont), "s string").distinct()
    return sorted((r["s"] for r in syms.collect()), key=lambda p: (p.startswith(TX.CONT), _cp(p)))


def _cp(p: str) -> tuple:
    return tuple(ord(ch) for ch in p)


def learn_merges(word_counts: DataFrame, kind: str = "wordpiece", vocab_size: int | None = 32768,
                 max_merges: int | None = None, min_pair_n: int = 2, per_round: int = R.FIRST_PAIRS) -> MergeModel:
    """D6 (wordpiece), D7 (bpe over SentencePiece pieces), D9 (byte).

    ``word_counts``: (word, n).  Stops when the vocabulary reaches
    ``vocab_size`` (D12), after ``max_merges`` merges, or when the best
    pair occurs fewer than ``min_pair_n`` times (D2).  ``per_round`` is the
    number of pairs that the first round looks at; later rounds look at more
    as long as their stretches of words are few.  The vocabulary is assembled
    on the driver: it is bounded by ``vocab_size``.
    """
    if kind not in KINDS:
        raise ValueError(kind)
    spark = word_counts.sparkSession
    held = word_counts.storageLevel
    own = not (held.useMemory or held.useDisk)
    if own:
        word_counts.persist(StorageLevel.MEMORY_AND_DISK)
    alphabet = alphabet_pieces(word_counts, kind)
    specials = V.reserved_pieces("sentencepiece" if kind == "bpe" else "wordpiece")
    pieces = [q for q, _ in specials]
    pieces += [q for q in alphabet if q not in set(pieces)]
    known = set(pieces)
    symbols = list(alphabet)
    ids = spark.sparkContext.broadcast({s: i for i, s in enumerate(symbols)})
    cont = TX.CONT if kind == "wordpiece" else ""
    w = R.Words(word_counts.select("word", "n").mapInArrow(
        lambda batches: R.pack(ids.value, kind, cont)(batches), "word binary, n long"))
    merges = []
    k = per_round
    while True:
        budget = None if vocab_size is None else vocab_size - len(pieces)
        left = None if max_merges is None else max_merges - len(merges)
        if (budget is not None and budget <= 0) or (left is not None and left <= 0):
            break
        done, few = _round(w, symbols, kind, k, min_pair_n, left, budget, known)
        if own:  # the words are packed
            word_counts.unpersist()
            own = False
        if not done:
            break
        if few:
            k = min(2 * k, R.MAX_PAIRS)
        for l, r, m, n, is_new in done:
            merges.append((len(merges) + 1, l, r, m, int(n)))
            if is_new:
                known.add(m)
                pieces.append(m)
    if own:
        word_counts.unpersist()
    mdf = spark.createDataFrame(merges, "rank int, left string, right string, merged string, n bigint")
    roles = dict(specials)
    n_base = len(specials) + len([q for q in alphabet if q not in roles])
    rows = [(i, q, 0.0 if i < n_base else -float(i - n_base + 1), roles.get(q) if i < len(specials) else None)
            for i, q in enumerate(pieces)]
    return MergeModel(kind, mdf, spark.createDataFrame(rows, V.VOCAB_SCHEMA), w)


def _round(w: R.Words, symbols: list[str], kind: str, k: int, min_pair_n: int, left: int | None,
           budget: int | None, known: set):
    """One round: its merges, and whether it looked at few enough stretches
    for the next to look at more pairs.  Puts the merges into ``w``."""
    top = w.top(k + 1)
    if not top or top[0][0] < min_pair_n:
        return [], False
    floor = max(min_pair_n, top[k][0] + 1 if len(top) > k else 1)
    hot = [x for x in top if x[0] >= floor] or w.at_least(top[0][0], R.MAX_PAIRS)
    while hot:
        codes = np.sort(np.array([code for _, code in hot], np.int64))
        found = w.runs(codes)
        if found is not None:
            floor = min(n for n, _ in hot)
            named = lambda l, r: merged_name(l, r, kind)
            done, new = R.merge_runs(found, floor, symbols, named, left, budget, known)
            w.put_back(codes, new)
            return done, 2 * len(found) < R.MAX_RUNS
        cut = hot[len(hot) // 4][0]  # fewer pairs; those that tie stay together
        hot = [x for x in hot if x[0] > cut]
    ranked = w.ranked(top[0][0], symbols, k + 1)
    done = choose_round(ranked, k, kind, known | set(symbols), budget, min_pair_n)
    done = [(l, r, m, n, m not in known) for l, r, m, n, _ in done[:left]]
    ids = {s: i for i, s in enumerate(symbols)}
    for l, r, m, _, _ in done:
        if m not in ids:
            ids[m] = len(symbols)
            symbols.append(m)
    w.put_pairs([(ids[l], ids[r], ids[m]) for l, r, m, _, _ in done])
    return done, False


def word_vocab(word_counts: DataFrame, top: int = 500) -> DataFrame:
    """A vocabulary with an exact SQL form: specials, the WordPiece
    alphabet, then the ``top`` most frequent whole words (n desc, word)
    not already present.  ``top`` is the vocabulary-size feature."""
    spark = word_counts.sparkSession
    word_counts = word_counts.persist(StorageLevel.MEMORY_AND_DISK)
    base = learn_merges(word_counts, "wordpiece", max_merges=0)
    rows = base.vocab.collect()
    have = {r["piece"] for r in rows}
    words = [r["word"] for r in word_counts.orderBy(F.desc("n"), "word").limit(top).collect()]
    out = [tuple(r) for r in rows]
    for w in words:
        if w not in have:
            have.add(w)
            out.append((len(out), w, -float(len(out)), None))
    base.release()
    word_counts.unpersist()
    return spark.createDataFrame(out, V.VOCAB_SCHEMA)
