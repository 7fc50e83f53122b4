"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman.

Test items are taken in blocks of bounded size, each block against all
documents.  Seeds are the rare runs of an item: from each of its words the
shortest run, of SEED words at most, whose words, by their shares of all words
of the corpus, would meet by chance at most ``rate`` times a word.  The rate
is a share, so an item has the same seeds in a corpus and in many copies of
it, and hits by chance stay in proportion to the words read.  (Counts of the
run itself would not do: an item copied into thousands of documents makes its
own runs frequent.)  An item of frequent words also has its FEWEST rarest runs
of SEED words.  Tasks look up every run of every document among the seeds,
gather the hits of one item in passages, and align each passage that has two
different seeds with the item word by word (match 2, other -1, gap -1).
A document is contaminated by an item when the best local alignment reaches
``least`` of the score that the whole item has with itself.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case.  Null and empty
texts match nothing; items of fewer than SEED words are too short to tell
from chance and match nothing.  Repeated rows are judged alike; repeated
items count once each; of equal alignments of a document and an item the one
that ends first is named.  Empty tables give no matches.  Other columns are not
read by ``matches`` and kept by ``decontaminate``, whatever their names.  Texts
are never cut, and the documents are not shuffled.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskweave.llm.common import shingles, trimmed, word_slices

SEED, FEWEST = 3, 8
#: A seed's words meet by chance at most this often, a word of text.
RATE = 1e-6
MATCH, OTHER, GAP = 2, -1, -1
#: Words of test items that are held at a time, on the driver and in a task.
BLOCK_WORDS = 2_000_000
#: Parts of a block that are counted before items are collected.
PARTS = 256
#: Hits that a task holds at a time; more are handled item by item.
HELD_HITS = 4_000_000
_SIEVE = 1 << 22


class Block:
    """Items with their words; ``seeds`` sorted by hash."""

    def __init__(self, ids: list[int], texts: list[str], times: list[int]):
        words, counts = [], []
        for _, _, h, n in word_slices(pa.array(texts, pa.large_string())):
            words.append(h)
            counts.append(n)
        self.ids, self.times = ids, times
        self.words = np.concatenate(words) if words else np.empty(0, np.uint64)
        self.counts = np.concatenate(counts) if counts else np.empty(0, np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        self.vocabulary = np.unique(self.words)

    def choose(self, seen: np.ndarray, total: int, rate: float) -> None:
        """Seeds by the corpus counts of the vocabulary's words."""
        log_p = np.log(np.maximum(seen, 1) / max(total, 1))[np.searchsorted(self.vocabulary, self.words)]
        begun = np.zeros(len(self.words), bool)  # a seed begins at this word
        found = []
        for size in range(1, SEED + 1):
            h, item, pos = self._runs(size)
            at = self.first[item] + pos
            expect = sum(log_p[at + k] for k in range(size))
            rare = (expect <= math.log(rate)) & ~begun[at]
            begun[at[rare]] = True
            found.append((h[rare], item[rare], pos[rare]))
        order = np.lexsort((expect, item))
        per = np.bincount(item, minlength=len(self.counts))
        rank = np.empty(len(h), np.int64)
        rank[order] = np.arange(len(h)) - np.repeat(np.cumsum(per) - per, per)
        more = (rank < FEWEST) & ~begun[at]
        found.append((h[more], item[more], pos[more]))
        h, item, pos = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((pos, item, h))
        h, item, pos = h[order], item[order], pos[order]
        # two places of a run in an item tell as much as all of them
        third = np.zeros(len(h), bool)
        third[2:] = (h[2:] == h[:-2]) & (item[2:] == item[:-2])
        self.seed, self.item, self.pos = h[~third], item[~third], pos[~third]
        self.sieve = np.zeros(_SIEVE, bool)
        self.sieve[self.seed & np.uint64(_SIEVE - 1)] = True
        self.n_seeds = np.bincount(self.item, minlength=len(self.counts))

    def _runs(self, size: int):
        """(hash, item, position) of the items' runs of ``size`` words."""
        h, n = shingles(self.words, self.counts, size)
        item = np.repeat(np.arange(len(n)), n)
        pos = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
        ok = self.counts[item] >= SEED
        return h[ok], item[ok], pos[ok]

    def seeded(self, words: np.ndarray, counts: np.ndarray):
        """(hash, text, word) of every run of the texts that is a seed."""
        found = []
        for size in range(1, SEED + 1):
            h, n = shingles(words, counts, size)
            at = np.flatnonzero(self.sieve[h & np.uint64(_SIEVE - 1)])
            key = h[at]
            near = self.seed[np.minimum(np.searchsorted(self.seed, key), len(self.seed) - 1)]
            at, key = at[near == key], key[near == key]
            ends = np.cumsum(n)
            text = np.searchsorted(ends, at, "right")
            ok = counts[text] >= size
            found.append((key[ok], text[ok], (at - (ends - n)[text])[ok]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def hits(self, h: np.ndarray):
        """(index in h, item, position in the item) of all that have a seed of
        h, in parts of whole items that hold about HELD_HITS each."""
        lo = np.searchsorted(self.seed, h, "left")
        n = np.searchsorted(self.seed, h, "right") - lo
        parts = -(-int(n.sum()) // HELD_HITS)
        for part in range(parts):
            item, pos = self.item, self.pos
            if parts > 1:
                mine = np.flatnonzero(self.item % parts == part)
                item, pos, seed = item[mine], pos[mine], self.seed[mine]
                lo = np.searchsorted(seed, h, "left")
                n = np.searchsorted(seed, h, "right") - lo
            at = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(np.arange(len(h)), n), item[at], pos[at]


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best Smith-Waterman score of each pair and where it ends in the
    passage, all pairs at once, one item word per step."""
    rows, cols = max(map(len, items)), max(map(len, passages))
    a = np.zeros((len(items), rows), np.uint64)
    b = np.zeros((len(items), cols), np.uint64)
    in_a, in_b = np.zeros(a.shape, bool), np.zeros(b.shape, bool)
    for k, (x, y) in enumerate(zip(items, passages)):
        a[k, :len(x)], in_a[k, :len(x)], b[k, :len(y)], in_b[k, :len(y)] = x, True, y, True
    slope = np.arange(cols, dtype=np.int32) * -GAP
    prev = np.zeros((len(items), cols + 1), np.int32)
    best, end = np.zeros(len(items), np.int32), np.zeros(len(items), np.int64)
    for i in range(rows):
        same = (b == a[:, i:i + 1]) & in_b & in_a[:, i:i + 1]
        now = np.maximum(prev[:, :-1] + np.where(same, MATCH, OTHER), prev[:, 1:] + GAP)
        np.maximum(now, 0, out=now)
        now = np.maximum(now, np.maximum.accumulate(now + slope, axis=1) - slope)
        now[~in_b] = 0
        col = now.argmax(axis=1)
        top = now[np.arange(len(items)), col]
        better = (top > best) & in_a[:, i]
        best[better], end[better] = top[better], col[better]
        prev[:, 1:] = now
    return best, end


def _find(block: Block, column, least: float):
    """Rows (index in column, item, share of the item's own score, last word)."""
    if not len(block.seed):
        return
    for lo, hi, h, counts in word_slices(column):
        key, text, begins = block.seeded(h, counts)
        for at, item, pos in block.hits(key):
            for doc, *found in _passages(block, h, counts, text[at], begins[at], item, pos, least):
                yield lo + doc, *found


def _passages(block: Block, h, counts, doc, word, item, pos, least: float):
    """The hits of each text and item in passages; those that align."""
    if not len(doc):
        return
    order = np.lexsort((word, item, doc))
    doc, item, pos, word = doc[order], item[order], pos[order], word[order]
    size = block.counts[item]
    # a passage ends where the text, the item or the neighbourhood ends
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (word[1:] - word[:-1] > size[1:])
    group = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    pairs = np.unique(group * (int(block.counts.max()) + 1) + pos)
    seeds = np.bincount(pairs // (int(block.counts.max()) + 1), minlength=len(first))
    ok = seeds >= np.minimum(2, block.n_seeds[item[first]])
    begin = np.maximum(word[first] - 2 * size[first], 0)
    stop = np.minimum(word[last] + 2 * size[first] + SEED, counts[doc[first]])
    text_at = np.cumsum(counts) - counts
    todo, held = [], 0
    jobs = np.flatnonzero(ok)
    jobs = jobs[np.argsort(size[first][jobs] * 1_000_000 + (stop - begin)[jobs], kind="stable")]
    for k, g in enumerate(jobs):
        todo.append(g)
        held = max(held, int(stop[g] - begin[g]))
        if len(todo) * held > 1_000_000 or k == len(jobs) - 1:
            f = first[todo]
            items = [block.words[block.first[i]:block.first[i] + block.counts[i]] for i in item[f]]
            texts = [h[text_at[d] + x:text_at[d] + y] for d, x, y in zip(doc[f], begin[todo], stop[todo])]
            score, end = align(items, texts)
            share = score / (MATCH * size[f])
            for q in np.flatnonzero(share >= least):
                yield int(doc[f][q]), int(item[f][q]), float(share[q]), int(begin[todo][q] + end[q])
            todo, held = [], 0


def _best(found) -> dict[tuple[int, int], tuple[float, int]]:
    out: dict[tuple[int, int], tuple[float, int]] = {}
    for row, item, share, end in found:
        if (row, item) not in out or (share, -end) > (out[row, item][0], -out[row, item][1]):
            out[row, item] = (share, end)
    return out


def _matches(shared, least):
    def run(batches):
        block = shared.value
        for b in batches:
            found = sorted(_best(_find(block, b.column(1), least)).items())
            if found:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array([r for (r, _), _ in found])).cast(pa.int64()),
                     pa.array([block.ids[i] for (_, i), _ in found], pa.int64()),
                     pa.array([s for _, (s, _) in found]), pa.array([e for _, (_, e) in found], pa.int64()),
                     pa.array([block.times[i] for (_, i), _ in found], pa.int64())],
                    ["doc_id", "item_id", "score", "last_word", "times"])
    return run


def _clean(shared, least, at):
    def run(batches):
        for b in batches:
            keep = np.ones(b.num_rows, bool)
            keep[[row for row, *_ in _find(shared.value, b.column(at), least)]] = False
            yield b.filter(pa.array(keep))
    return run


def _counted(vocabulary):
    def run(batches):
        known = vocabulary.value
        seen, total = np.zeros(len(known), np.int64), 0
        for b in batches:
            for _, _, h, _ in word_slices(b.column(0)):
                total += len(h)
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                seen += np.bincount(at[known[at] == h], minlength=len(known))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], total))],
                                         ["word", "n"])
    return run


def blocks(docs: DataFrame, items: DataFrame, rate: float = RATE, block_words: int = BLOCK_WORDS):
    """The items in blocks, with seeds chosen by all of ``docs``."""
    spark = docs.sparkSession
    # a repeated item is held and aligned once
    items = (items.where(F.col("text").isNotNull())
             .select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
             .groupBy("item_id", "text").agg(F.count("*").alias("times")))
    words = F.size(F.split("text", r"\s+"))
    total = items.agg(F.sum(words)).first()[0] or 0
    # a block ends where the running count of its parts' words is full
    parts = PARTS * max(1, math.ceil(total / block_words))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    ranges, held = [], 0
    for k, n in items.groupBy(part.alias("part")).agg(F.sum(words).alias("n")).orderBy("part").collect():
        if not ranges or held + n > block_words:
            ranges.append([k, k])
            held = 0
        ranges[-1][1] = k
        held += n
    for lo, hi in ranges:
        rows = items.where(part.between(lo, hi)).collect()
        block = Block([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows])
        if not len(block.vocabulary):
            continue
        counted = (docs.select(F.col("text").cast("string"))
                   .mapInArrow(trimmed(_counted(spark.sparkContext.broadcast(block.vocabulary))), "word long, n long")
                   .groupBy("word").agg(F.sum("n").alias("n")).toArrow())
        at, n = counted.column(0).to_numpy(), counted.column(1).to_numpy()
        seen = np.zeros(len(block.vocabulary), np.int64)
        seen[at[at >= 0]] = n[at >= 0]
        block.choose(seen, int(n[at < 0].sum()), rate)
        yield spark.sparkContext.broadcast(block)


def matches(docs: DataFrame, items: DataFrame, least: float = 0.5, rate: float = RATE) -> DataFrame:
    """(doc_id, item_id, score, last_word): every document and test item that
    align; score is the share of the item's own score, last_word the number
    of the document's word where the best alignment ends."""
    schema = "doc_id long, item_id long, score double, last_word long"
    out = docs.sparkSession.createDataFrame([], schema)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for block in blocks(docs, items, rate):
        found = src.mapInArrow(trimmed(_matches(block, least)), schema + ", times long")
        out = out.union(found.withColumn("times", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("times"))
    return out


def decontaminate(docs: DataFrame, items: DataFrame, least: float = 0.5, rate: float = RATE) -> DataFrame:
    """The documents, with all their columns, that align with no item."""
    out = docs
    for block in blocks(docs, items, rate):
        out = out.mapInArrow(trimmed(_clean(block, least, docs.columns.index("text"))), docs.schema)
    return out
