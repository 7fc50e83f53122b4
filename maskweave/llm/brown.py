"""Brown class-based bigram model: training by exchange clustering, scoring.

Training tokens are the words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z in
lower case, then one end token.  All jobs run over blocks: a block holds the
tokens of some texts as numbers into the block's own list of distinct words,
so that words, and not tokens, are shuffled.

1. Counts of every training word (one row per block and word is shuffled).
2. The most frequent words, the core (CORE for each class), are clustered on
   the driver: exchange sweeps over their bigram counts move a word to the class
   that raises the likelihood of the class bigrams most, until a sweep moves
   nothing or SWEEPS are done.  The number of classes follows the vocabulary
   (``class_number``).
3. Every other word joins, on the cluster, the class under which its neighbours
   among the core words are most likely; words without such a neighbour have no
   class yet.
4. ROUNDS times, all words are moved by all their neighbours over the whole
   corpus: the core words by exchange sweeps in which the other words stand as
   one fixed item for each class, then each other word to the class under which
   the classes of its neighbours, whatever words they are, are most likely (the
   exchange gain to first order, all words at once).  A word that still has no
   neighbour with a class joins the last one.
5. Class transitions are counted over all training tokens with the classes of
   all words.

A token's probability mixes ``p(class | class before) * p(word | class)`` with
the smoothed unigram estimate ``(c + 0.1) / (N + 0.1 (V + 1))``, which alone
holds for words that training did not see.  The weight of the mixture is the
one of WEIGHTS under which the training tokens are most likely when each is
left out of the counts that predict it.  A text's score is the sum of log10
over its tokens, perplexity is ``10 ** (-score / n_tokens)``.

Null and empty texts are one end token.  A text longer than a block continues
in further blocks and its parts are summed.  Repeated rows are scored each; an
empty table gives no rows, and without training rows N and V are 0.  Words of
equal count are taken in the order of their hashes; other columns are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskweave.llm.common import HOT_SHARE, bucketed, mix, text_bytes, word_slices
from maskweave.session import discard, materialize

#: Core words for each class, and the most sweeps of an exchange.
CORE, SWEEPS = 16, 8
#: Rounds over all words and all neighbours.
ROUNDS = 1
#: Classes at most: their table of transitions is held by every task.
MOST_CLASSES = 256
#: Tokens in a block.
BLOCK = 1_000_000
#: Weights of the class bigram beside the unigram to choose from.
WEIGHTS = tuple(k / 20 for k in range(20))
ADD = 0.1

END = mix(np.array([0xE0D], np.uint64))[0]
_BLOCK = ("block long, task long, doc_ids array<long>, rows array<long>, train array<boolean>, more array<boolean>, "
          "sizes array<int>, tokens binary, words array<long>, counts array<int>")


def class_number(words: int) -> int:
    """Classes for a vocabulary: 25 for 10,000 words, 79 for a million."""
    return int(min(max(round(2.5 * words ** 0.25), 1), MOST_CLASSES))


def _draw() -> int:
    return uuid.uuid4().int >> 65


class _Blocks:
    """Gathers texts into blocks."""

    def __init__(self):
        self.task = _draw()
        self.clear()

    def clear(self):
        self.ids, self.rows, self.train, self.more, self.sizes, self.held = [], [], [], [], [], []
        self.n = 0

    def add(self, doc_id, row, train, words):
        """``more``: the text goes on in the next block, which repeats the
        last token as context."""
        at = 0
        while True:
            take = min(len(words) - at, max(BLOCK - self.n, 1))
            begin = max(at - 1, 0)
            self.ids.append(doc_id), self.rows.append(row), self.train.append(train)
            self.more.append(at > 0), self.sizes.append(at + take - begin)
            self.held.append(words[begin:at + take])
            self.n += take
            at += take
            if self.n >= BLOCK:
                yield self.flush()
            if at >= len(words):
                return

    def flush(self):
        tokens = np.concatenate(self.held)
        words, local, n = np.unique(tokens, return_inverse=True, return_counts=True)
        # frequent words get small numbers, and each byte of the numbers is
        # stored apart from the others: both pack well
        order = np.argsort(-n, kind="stable")
        place = np.empty(len(words), np.uint32)
        place[order] = np.arange(len(words))
        words, local = words[order], place[local]
        packed = np.ascontiguousarray(local.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
        # context tokens and held-out texts are not counted
        counted = np.repeat(np.array(self.train), self.sizes)
        begin = np.cumsum(self.sizes) - self.sizes
        counted[begin[np.array(self.more)]] = False
        counts = np.bincount(local[counted], minlength=len(words))
        out = pa.RecordBatch.from_arrays([
            pa.array([_draw()]), pa.array([self.task]), pa.array([self.ids], pa.list_(pa.int64())),
            pa.array([self.rows], pa.list_(pa.int64())), pa.array([self.train], pa.list_(pa.bool_())),
            pa.array([self.more], pa.list_(pa.bool_())), pa.array([self.sizes], pa.list_(pa.int32())),
            pa.array([packed], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(words.view(np.int64))),
            pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(counts.astype(np.int32)))],
            [c.split()[0] for c in _BLOCK.split(", ")])
        self.clear()
        return out


def _block(batches):
    blocks, row = _Blocks(), 0
    for b in batches:
        ids, train = b.column(0).to_pylist(), b.column(1).to_pylist()
        for lo, hi, h, counts in word_slices(b.column(2)):
            ends = np.cumsum(counts)
            for k in range(lo, hi):
                z = ends[k - lo]
                yield from blocks.add(ids[k], row, train[k], np.append(h[z - counts[k - lo]:z], END))
                row += 1
    if blocks.n:
        yield blocks.flush()


def _open(b, k):
    """Arrays of the k-th block of a batch."""
    sizes = b.column("sizes")[k].values.to_numpy()
    planes = np.frombuffer(b.column("tokens")[k].as_buffer(), np.uint8).reshape(4, -1)
    tokens = np.ascontiguousarray(planes.T).view("<u4").ravel()
    train = np.array(b.column("train")[k].as_py(), bool)
    more = np.array(b.column("more")[k].as_py(), bool)
    begin = np.cumsum(sizes) - sizes
    first = np.zeros(len(tokens), bool)
    first[begin] = True
    return sizes, tokens, train, more, begin, first


def _core_index(core, words):
    """Place of each word among the sorted core words, CORE's size if not one."""
    at = np.minimum(np.searchsorted(core, words), max(len(core) - 1, 0))
    return np.where(core[at] == words, at, len(core)) if len(core) else np.zeros(len(words), np.int64)


def _core_bigrams(core, classes):
    """Bigram counts of items: core words, then the other words by class, then
    the words that have none."""
    def run(batches):
        n = len(core.value) + classes + 1
        total = np.zeros(n * n, np.int64)
        for b in batches:
            for k in range(b.num_rows):
                sizes, tokens, train, more, begin, first = _open(b, k)
                words = b.column("words")[k].values.to_numpy().view(np.uint64)
                place = _core_index(core.value, words)
                if "known" in b.schema.names:
                    cls = _known(b, k)[1]
                    place = np.where(place < len(core.value), place, len(core.value) + np.where(cls < 0, classes, cls))
                else:
                    place = np.where(place < len(core.value), place, n - 1)
                place = place[tokens]
                ok = np.repeat(train, sizes)[1:] & ~first[1:]
                total += np.bincount(place[:-1][ok] * n + place[1:][ok], minlength=n * n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])
    return run


def exchange(pairs: np.ndarray, counts: np.ndarray, classes: int, sweeps: int = SWEEPS,
             start: np.ndarray | None = None) -> np.ndarray:
    """Classes 0.. of words by exchange clustering of their bigram counts
    ``pairs`` (words x words); ``counts`` orders the words.  ``start`` gives the
    classes to begin with; items beyond ``counts`` keep theirs."""
    n = len(pairs)
    order = np.argsort(-counts, kind="stable")
    if start is None:
        cls = np.empty(n, np.int64)
        cls[order] = np.arange(n) % classes
    else:
        cls = start.copy()

    def f(x):
        return x * np.log(np.maximum(x, 1))

    member = np.zeros((n, classes))
    member[np.arange(n), cls] = 1
    big = member.T @ pairs @ member
    for _ in range(sweeps):
        moved = 0
        for w in order:
            c = cls[w]
            member[w, c] = 0
            right, left = pairs[w] @ member, pairs[:, w] @ member
            own = pairs[w, w]
            # take the word out of its class
            big[c] -= right
            big[:, c] -= left
            big[c, c] -= own
            rows, cols, diag = big.sum(axis=1), big.sum(axis=0), np.diag(big)
            gain = (f(big + right) - f(big)).sum(axis=1) + (f(big + left[:, None]) - f(big)).sum(axis=0)
            # the cell of the class with itself gets both and the pair of the word with itself
            gain += f(diag + right + left + own) - f(diag + right) - f(diag + left) + f(diag)
            gain -= f(rows + right.sum() + own) - f(rows) + f(cols + left.sum() + own) - f(cols)
            to = int(np.argmax(gain + 1e-9 * (np.arange(classes) == c)))
            cls[w] = to
            member[w, to] = 1
            big[to] += right
            big[:, to] += left
            big[to, to] += own
            moved += to != c
        if not moved:
            break
    return cls


def _events(core, cls, classes, least):
    """Rows of words outside the core: a code for each neighbour that has a
    class, two bytes each; 0..classes-1 follow the word, classes.. precede it.
    A word of more than ``least`` training tokens (where counts are known) is
    summed over the whole task and comes with its counts, eight bytes a code."""
    kinds = 2 * classes

    def out(words, codes, off, counts=None):
        held = [None, pa.py_buffer((off * 8).astype(np.int32).tobytes()), pa.py_buffer(counts.astype("<i8").tobytes())] \
            if counts is not None else [None, pa.py_buffer(np.zeros(len(off), np.int32).tobytes()), pa.py_buffer(b"")]
        return pa.RecordBatch.from_arrays([
            pa.array(words, pa.int64()),
            pa.Array.from_buffers(pa.binary(), len(words), [
                None, pa.py_buffer((off * 2).astype(np.int32).tobytes()), pa.py_buffer(codes.astype("<u2").tobytes())]),
            pa.Array.from_buffers(pa.binary(), len(words), held)], ["word", "codes", "counts"])

    def run(batches):
        names = np.append(cls.value, -1)
        hot: dict[int, np.ndarray] = {}
        for b in batches:
            for k in range(b.num_rows):
                sizes, tokens, train, more, begin, first = _open(b, k)
                words = b.column("words")[k].values.to_numpy()
                place = _core_index(core.value, words.view(np.uint64))
                count, kind = np.zeros(len(words), np.int64), names[place]
                if "known" in b.schema.names:
                    count, other = _known(b, k)
                    kind = np.where(place < len(core.value), kind, other)
                outside = (place == len(core.value))[tokens]
                kind = kind[tokens]
                ok = np.repeat(train, sizes)[1:] & ~first[1:]
                a, z = tokens[:-1][ok], tokens[1:][ok]  # times kinds they fit 32 bits: a block has few words
                ka, kz, oa, oz = kind[:-1][ok], kind[1:][ok], outside[:-1][ok], outside[1:][ok]
                after, before = oa & (kz >= 0), oz & (ka >= 0)
                event = np.concatenate([a[after] * np.uint32(kinds) + kz[after].astype(np.uint32),
                                        z[before] * np.uint32(kinds) + (ka[before] + classes).astype(np.uint32)])
                event.sort()
                word = event // np.uint32(kinds)
                often = count[word] > least
                many = event[often]
                for w, at in _runs(word[often]):
                    got = np.bincount(many[at] % kinds, minlength=kinds)
                    hot[words[w]] = hot.get(words[w], 0) + got
                event, word = event[~often], word[~often]
                start = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.empty(0, np.int64)
                yield out(words[word[start]], event % np.uint32(kinds), np.append(start, len(event)))
        if hot:
            codes = [np.flatnonzero(v) for v in hot.values()]
            yield out(np.array(list(hot)), np.concatenate(codes), np.cumsum([0, *map(len, codes)]),
                      np.concatenate([v[c] for v, c in zip(hot.values(), codes)]))
    return run


def _runs(sorted_values):
    """(value, slice) of the runs of equal values."""
    if not len(sorted_values):
        return
    cut = np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1
    for lo, hi in zip(np.append(0, cut), np.append(cut, len(sorted_values))):
        yield int(sorted_values[lo]), slice(lo, hi)


def _assign(log_p):
    """Rows sorted by word: the class of each word, by all its events."""
    def run(batches):
        table = log_p.value  # codes x classes
        kinds = len(table)
        word, total = None, None
        for b in batches:
            if not b.num_rows:
                continue
            off, codes = text_bytes(b.column(1))
            codes, off = codes[off[0]:off[-1]].view("<u2").astype(np.int64), (off - off[0]) // 2
            count_off, counts = text_bytes(b.column(2))
            # a code counts once, or as often as its row says
            often = np.repeat(np.diff(count_off) > 0, np.diff(off))
            n = np.ones(len(codes), np.int64)
            n[often] = counts[count_off[0]:count_off[-1]].view("<i8")
            words = b.column(0).to_numpy()
            first = np.append(True, words[1:] != words[:-1])
            names = words[first]
            # how often each word has each code, times what a code says
            at = np.repeat(np.cumsum(first) - 1, np.diff(off)) * kinds + codes
            sums = np.bincount(at, n, len(names) * kinds).reshape(-1, kinds) @ table
            if word is not None:
                if names[0] == word:
                    sums[0] += total
                else:
                    names, sums = np.append(word, names), np.vstack([total, sums])
            word, total = names[-1], sums[-1]
            yield _classes(names[:-1], sums[:-1])
        if word is not None:
            yield _classes(np.array([word]), total[None])

    def _classes(words, sums):
        return pa.RecordBatch.from_arrays([pa.array(words), pa.array(sums.argmax(axis=1).astype(np.int16))]
                                          if len(words) else [pa.array([], pa.int64()), pa.array([], pa.int16())],
                                          ["word", "class"])
    return run


def _known(b, k):
    """c and class by the block's word numbers (0 and -1 for unseen words)."""
    n = b.column("n_words")[k].as_py()
    c, cls = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    if b.column("known")[k].is_valid:
        at = b.column("place")[k].values.to_numpy()
        known = b.column("known")[k].values.to_numpy()
        c[at], cls[at] = known >> 15, (known & 0x7FFF) - 1
    return c, cls


def _context(cls, first, more, begin, classes):
    """Class before each token: ``classes`` at the start, classes + 1 after an
    unseen word."""
    before = np.append(0, cls[:-1])
    before = np.where(before < 0, classes + 1, before)
    before[first] = classes
    return before


def _transitions(classes):
    def run(batches):
        total = np.zeros((classes + 2) * classes, np.int64)
        for b in batches:
            for k in range(b.num_rows):
                sizes, tokens, train, more, begin, first = _open(b, k)
                cls = _known(b, k)[1][tokens]
                ok = np.repeat(train, sizes) & (cls >= 0)
                ok[begin[more]] = False
                before = _context(cls, first, more, begin, classes)
                total += np.bincount(before[ok] * classes + cls[ok], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])
    return run


def _left_out(model):
    """Sum of log10 over training tokens for each weight, every token left out
    of its own counts."""
    def run(batches):
        n, v, seen, prior = model.value
        classes = seen.shape[1]
        size, after = np.append(seen.sum(axis=0), 0), seen.sum(axis=1)
        total = np.zeros(len(WEIGHTS))
        for b in batches:
            for k in range(b.num_rows):
                sizes, tokens, train, more, begin, first = _open(b, k)
                c, cls = _known(b, k)
                token_cls = cls[tokens]
                before = _context(token_cls, first, more, begin, classes)
                ok = np.repeat(train, sizes) & (token_cls >= 0)
                ok[begin[more]] = False
                c, cls, before = c[tokens][ok], token_cls[ok], before[ok]
                base = (c - 1 + ADD) / max(n - 1 + ADD * (v + 1), ADD)
                follow = (seen[before, cls] - 1 + prior[cls]) / after[before]
                follow *= (c - 1) / np.maximum(size[cls] - 1, 1)
                for i, w in enumerate(WEIGHTS):
                    total[i] += np.log10(w * follow + (1 - w) * base).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(WEIGHTS))), pa.array(total)], ["weight", "sum"])
    return run


def _score(model):
    def run(batches):
        n, v, transition, size, mixed = model.value
        classes = transition.shape[1]
        for b in batches:
            for k in range(b.num_rows):
                sizes, tokens, train, more, begin, first = _open(b, k)
                c, cls = _known(b, k)
                base = (c + ADD) / (n + ADD * (v + 1))
                emit = np.where(cls >= 0, c / np.maximum(size[cls], 1), 0)
                token_cls = cls[tokens]
                before = _context(token_cls, first, more, begin, classes)
                follow = np.where(token_cls >= 0, transition[before, token_cls], 0) * emit[tokens]
                base, seen = base[tokens], c[tokens] > 0
                score = np.log10(mixed * follow + (1 - mixed) * base)
                own = np.ones(len(tokens))
                own[begin[more]] = 0  # context only
                yield pa.RecordBatch.from_arrays([
                    b.column("task").take(pa.array([k] * len(sizes))),
                    b.column("rows")[k].values, b.column("doc_ids")[k].values, pa.array(~train),
                    pa.array(np.add.reduceat(own, begin).astype(np.int64)),
                    pa.array(np.add.reduceat(own * seen, begin).astype(np.int64)),
                    pa.array(np.add.reduceat(own * np.log10(base), begin)),
                    pa.array(np.add.reduceat(own * score, begin))],
                    ["task", "row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])
    return run


def _sum_pairs(df: DataFrame, n: int) -> np.ndarray:
    got = df.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n)
    out[got.column(0).to_numpy()] = got.column(1).to_numpy()
    return out


def _log_p(pairs: np.ndarray, cls: np.ndarray, classes: int) -> np.ndarray:
    """Log probability of each code (row) for a word of each class (column),
    from bigram counts of items in classes ``cls``."""
    member = np.zeros((len(cls), classes))
    member[np.arange(len(cls)), cls] = 1
    big = member.T @ pairs @ member + 0.01
    return np.log(np.vstack([(big / big.sum(axis=1, keepdims=True)).T, big / big.sum(axis=0)]))


def _with_classes(blocks: DataFrame, by_word: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks with c and class of their words (two lists: numbers of the words
    in the block; c, and class + 1 in the lowest 15 bits), and the table to
    discard.  Neither the blocks nor their word rows move."""
    known = F.shiftleft("c", 15).bitwiseOR(F.col("class").cast("long") + 1)
    placed = bucketed(by_word.join(words, "word").groupBy("block")
                      .agg(F.collect_list(known).alias("known"), F.collect_list("place").alias("place")),
                      "block-classes", "block")
    return blocks.join(placed.hint("shuffle_hash"), "block", "left"), placed


def train_and_score(docs: DataFrame, train, core_words: int | None = None, classes: int | None = None,
                    mixed: float | None = None, rounds: int = ROUNDS) -> DataFrame:
    """Scores of all rows of ``docs`` by the model of the rows for which the
    column ``train`` is true: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score.  ``classes`` and ``core_words`` follow the
    vocabulary unless given, ``mixed`` fixes the mixture's weight."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    blocks = bucketed(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"),
                    F.col("text").cast("string").alias("text")).mapInArrow(_block, _BLOCK), "token-blocks", "block")
    by_word = bucketed(blocks.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "x")).select(
        "block", "place", F.col("x.words").alias("word"), F.col("x.counts").alias("n")), "block-words", "word", dealt=True)
    counts = bucketed(by_word.where("n > 0").groupBy("word").agg(F.sum("n").alias("c")), "word-counts", "word")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    classes = classes or class_number(v)

    top = sorted(counts.orderBy(F.desc("c"), "word").limit(core_words or CORE * classes).collect(),
                 key=lambda r: np.int64(r[0]).view(np.uint64))
    core = np.array([r[0] for r in top], np.int64).view(np.uint64)
    core_counts = np.array([r[1] for r in top], np.int64)
    items = len(core) + classes  # the other words of a class are one item
    shared = share(core)

    def item_pairs(tokens):
        found = _sum_pairs(tokens.mapInArrow(_core_bigrams(shared, classes), "pair long, n long"), (items + 1) ** 2)
        return found.reshape(items + 1, items + 1)[:-1, :-1]

    def assigned(tokens, cls, pairs, fixed):
        """Classes of all words."""
        log_p = _log_p(pairs, np.append(cls, fixed), classes)
        others = (tokens.mapInArrow(_events(shared, share(cls), classes, n // HOT_SHARE),
                                    "word long, codes binary, counts binary")
                  .repartition("word").sortWithinPartitions("word")
                  .mapInArrow(_assign(share(log_p)), "word long, class short"))
        known_core = spark.createDataFrame(pa.table({
            "word": pa.array(core.view(np.int64), pa.int64()), "class": pa.array(cls.astype(np.int16), pa.int16())}))
        return bucketed(counts.join(known_core.unionByName(others), "word", "left")
                        .select("word", "c", F.coalesce("class", F.lit(-1)).cast("short").alias("class")),
                        "word-classes", "word")

    plain = blocks.withColumn("n_words", F.size("words"))
    fixed = np.arange(classes)
    pairs = item_pairs(plain)
    cls = exchange(pairs[:len(core), :len(core)], core_counts, classes)
    words = assigned(plain, cls, pairs, fixed)
    for _ in range(rounds):
        full, placed = _with_classes(plain, by_word, words)
        pairs = item_pairs(full)
        cls = exchange(pairs, core_counts, classes, start=np.append(cls, fixed))[:len(core)]
        before, words = words, assigned(full, cls, pairs, fixed)
        discard(before, placed)
    # words that no neighbour with a class stands beside
    last = F.when(F.col("class") < 0, classes - 1).otherwise(F.col("class"))
    full, placed = _with_classes(plain.drop("words", "counts"), by_word, words.withColumn("class", last))
    discard(counts, words, by_word)
    seen = _sum_pairs(full.mapInArrow(_transitions(classes), "pair long, n long"), (classes + 2) * classes)
    seen = seen.reshape(classes + 2, classes)
    in_class = seen.sum(axis=0)
    prior = (in_class + ADD) / (in_class.sum() + ADD * classes)
    transition = (seen + prior) / (seen.sum(axis=1, keepdims=True) + 1)
    if mixed is None:
        sums = (full.mapInArrow(_left_out(share((n, v, seen, prior))), "weight long, sum double")
                .groupBy("weight").agg(F.sum("sum").alias("sum")).collect())
        mixed = WEIGHTS[max(sums, key=lambda r: (r["sum"], -r["weight"]))["weight"]] if sums else 0.0
    parts = full.mapInArrow(
        _score(share((n, v, transition, np.append(in_class, 0), mixed))),
        "task long, row long, doc_id long, held_out boolean, n_tokens long, n_known long, "
        "base_score double, score double")
    # a long text's parts meet again: same task, same row
    return (parts.groupBy("task", "row")
            .agg(F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"),
                 F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
                 F.sum("base_score").alias("base_score"), F.sum("score").alias("score"))
            .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(n)).cast("long").alias("train_tokens"),
                    "base_score", "score"))
