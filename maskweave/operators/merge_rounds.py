"""Rounds of exact pair merging over a distributed word table.

Words are packed symbol ids (little-endian 32 bits) with their count; pair
counts are a table of their own, kept up to date by what a round changes.
A round takes a floor and the *hot* pairs, those with at least that count:

* Tasks cut the *runs* out of their words: maximal stretches in which every
  pair of neighbours is hot.  Equal runs are summed before and after the
  shuffle, so what is left is few rows, however many words there are.
* On the runs alone, merges are made one at a time, best first, as long as
  the best pair reaches the floor (``merge_runs``).
* Tasks put the merged runs back and give, for the words they changed, the
  pairs lost and won; these go into the pair counts.

The result is that of one merge at a time over all words.  A pair of two
symbols that exist when the round begins can only become rarer: merging never
makes two old symbols neighbours that were none.  A pair with a new symbol at
the edge of a run, (x, lr) say, stands where (x, l) stood, so it occurs at
most as often as (x, l), which is not hot.  So nothing outside the runs
reaches the floor.  The argument needs merged symbols to be new: a merge that
gives a symbol that exists ends the round before it, or is a round of its own.
"""

from __future__ import annotations

import heapq
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskweave.session import discard, materialize

#: Distinct runs, and bytes of them, that a round brings to the driver at most.
MAX_RUNS, MAX_RUN_BYTES = 150_000, 16 << 20
#: Hot pairs of the first round, and of any.
FIRST_PAIRS, MAX_PAIRS = 256, 1 << 16
#: Rows that a task sums before it hands them on.
HELD = 500_000

_WORD = pa.binary()


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of a column of packed words."""
    off = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1 + column.offset)[column.offset:] // 4
    data = column.buffers()[2]
    ids = np.frombuffer(data, "<i4", len(data) // 4) if data is not None else np.empty(0, np.int32)
    return ids[off[0]:off[-1]], (off - off[0]).astype(np.int64)


def _pairs(ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, inside): each symbol with the next one as one number, and
    whether both belong to one word."""
    code = ids[:-1].astype(np.int64) << 32 | ids[1:]
    inside = np.ones(len(code), bool)
    ends = off[1:-1]
    inside[ends[(ends > 0) & (ends < len(ids))] - 1] = False
    return code, inside


def _sums(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes with the sums of their counts, none of them zero."""
    names, of = np.unique(code, return_inverse=True)
    out = np.zeros(len(names), np.int64)
    np.add.at(out, of, n)
    return names[out != 0], out[out != 0]


def _word_pairs(ids, off, n) -> tuple[np.ndarray, np.ndarray]:
    """(code, n) of all pairs, weighted by the words' counts."""
    code, inside = _pairs(ids, off)
    weight = np.repeat(n, np.diff(off))[:-1] if len(ids) else n[:0]
    return code[inside], weight[inside]


def runs(ids: np.ndarray, off: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end of each maximal stretch whose pairs are all in ``hot``
    (sorted codes)."""
    code, inside = _pairs(ids, off)
    at = np.minimum(np.searchsorted(hot, code), len(hot) - 1)
    hit = np.concatenate([[False], (hot[at] == code) & inside, [False]])
    return np.flatnonzero(hit[1:] & ~hit[:-1]), np.flatnonzero(hit[:-1] & ~hit[1:]) + 1


# ---------------------------------------------------------------- in tasks

def _characters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets) of a column of words."""
    words = pc.fill_null(words, "")
    off = np.append(0, np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False), dtype=np.int64))
    at, data = _bytes(words)
    return np.frombuffer(data[at[0]:at[-1]].tobytes().decode().encode("utf-32-le"), np.uint32), off


def _bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    at = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1 + words.offset)[words.offset:]
    data = words.buffers()[2]
    return at, np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)


def _heads(off: np.ndarray) -> np.ndarray:
    """Places of the words' first symbols."""
    return off[:-1][np.diff(off) > 0]


def letters(cont: str | None):
    """The characters of words; with ``cont`` also the continuation forms of
    those that follow another."""
    def run(batches):
        seen = np.empty(0, np.uint32)
        later = np.empty(0, np.uint32)
        for b in batches:
            points, off = _characters(b.column(0))
            seen = np.union1d(seen, points)
            if cont is not None:
                later = np.union1d(later, np.delete(points, _heads(off)))
        yield pa.RecordBatch.from_arrays([pa.array([*map(chr, seen.tolist())] + [cont + chr(c) for c in later.tolist()],
                                                   pa.string())], ["s"])
    return run


def pack(ids_of: dict[str, int], kind: str, cont: str):
    """Words -> packed ids of their characters (byte: of their bytes); those
    after the first have ids of their own with ``cont`` before them."""
    def run(batches):
        place = (lambda s: int(s, 16)) if kind == "byte" else ord
        first = np.full(256 if kind == "byte" else 0x110000, -1, "<i4")
        later = first.copy() if cont else first
        for s, i in ids_of.items():
            if cont and len(s) > 1:
                later[place(s[len(cont):])] = i
            else:
                first[place(s)] = i
        for b in batches:
            if kind == "byte":
                at, data = _bytes(pc.fill_null(b.column(0), ""))
                symbols, off = data[at[0]:at[-1]], (at - at[0]).astype(np.int64)
            else:
                symbols, off = _characters(b.column(0))
            ids = later[symbols]
            ids[_heads(off)] = first[symbols[_heads(off)]]
            words = pa.Array.from_buffers(_WORD, b.num_rows, [None, pa.py_buffer((4 * off).astype(np.int32).tobytes()),
                                                              pa.py_buffer(ids.tobytes())])
            yield pa.RecordBatch.from_arrays([words, b.column(1)], ["word", "n"])
    return run


def _count_pairs(batches):
    held = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for b in batches:
        held.append(_sums(*_word_pairs(*_flat(b.column(0)), b.column(1).to_numpy())))
        if sum(len(c) for c, _ in held) > HELD:
            yield pa.RecordBatch.from_arrays(_joined(held), ["code", "n"])
            held = held[:1]
    yield pa.RecordBatch.from_arrays(_joined(held), ["code", "n"])


def _joined(held) -> list[pa.Array]:
    return [pa.array(x) for x in _sums(*(np.concatenate([h[k] for h in held]) for k in (0, 1)))]


def _cut(hot):
    def run(batches):
        found: dict[bytes, int] = {}
        for b in batches:
            ids, off = _flat(b.column(0))
            first, end = runs(ids, off, hot.value)
            raw = ids.tobytes()
            weight = b.column(1).to_numpy()[np.searchsorted(off, first, "right") - 1]
            for a, z, n in zip((4 * first).tolist(), (4 * end).tolist(), weight.tolist()):
                key = raw[a:z]
                found[key] = found.get(key, 0) + n
            if len(found) > HELD:
                yield _found(found)
                found = {}
        yield _found(found)
    return run


def _found(found: dict[bytes, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(found), _WORD), pa.array(list(found.values()), pa.int64())], ["run", "n"])


def replace(ids: np.ndarray, off: np.ndarray, hot: np.ndarray, new: dict[bytes, bytes]):
    """(ids, offsets, changed): the words with their runs replaced."""
    first, end = runs(ids, off, hot)
    raw = ids.tobytes()
    parts, at, shorter = [], 0, np.zeros(len(off) - 1, np.int64)
    word = np.searchsorted(off, first, "right") - 1
    for a, z, w in zip((4 * first).tolist(), (4 * end).tolist(), word.tolist()):
        got = new.get(raw[a:z])
        if got is not None:
            parts += (raw[at:a], got)
            at = z
            shorter[w] += (z - a - len(got)) >> 2
    parts.append(raw[at:])
    size = np.diff(off) - shorter
    return np.frombuffer(b"".join(parts), "<i4"), np.append(0, np.cumsum(size)), shorter > 0


def _some(ids, off, keep):
    """The words of ``keep``."""
    size = np.diff(off)
    return ids[np.repeat(keep, size)], np.append(0, np.cumsum(size[keep]))


def _put_back(hot, new):
    """Rows (word, n) of the words that still have pairs, and rows (code,
    change) of the pairs lost and won."""
    def run(batches):
        none = (np.empty(0, np.int64), np.empty(0, np.int64))
        held = [none]
        for b in batches:
            n = b.column(1).to_numpy()
            ids, off = _flat(b.column(0))
            after, ends, changed = replace(ids, off, hot.value, new.value)
            for sign, old in ((-1, _some(ids, off, changed)), (1, _some(after, ends, changed))):
                code, weight = _word_pairs(*old, n[changed])
                held.append((code, sign * weight))
            if sum(len(c) for c, _ in held) > HELD:
                yield _changes(held)
                held = [none]
            rest, off = _some(after, ends, np.diff(ends) > 1)
            keep = n[np.diff(ends) > 1]
            words = pa.Array.from_buffers(_WORD, len(keep), [None, pa.py_buffer((4 * off).astype(np.int32).tobytes()),
                                                             pa.py_buffer(rest.astype("<i4").tobytes())])
            yield pa.RecordBatch.from_arrays([words, pa.array(keep), pa.nulls(len(keep), pa.int64())], ["word", "n", "code"])
        yield _changes(held)
    return run


def _changes(held) -> pa.RecordBatch:
    code, n = _joined(held)
    return pa.RecordBatch.from_arrays([pa.nulls(len(n), _WORD), n, code], ["word", "n", "code"])


# ---------------------------------------------------------------- on the cluster

class Words:
    """The word table (word, n) and the pair counts (code, n) of a learner,
    written when they are first asked for."""

    def __init__(self, packed: DataFrame):
        self.spark = packed.sparkSession
        self.packed = packed

    @cached_property
    def words(self) -> DataFrame:
        return materialize(self.packed, "merge-words")

    @cached_property
    def pairs(self) -> DataFrame:
        return self._sum(self.words.mapInArrow(_count_pairs, "code long, n long"))

    @staticmethod
    def _sum(rows: DataFrame) -> DataFrame:
        return materialize(rows.groupBy("code").agg(F.sum("n").alias("n")).where("n > 0"), "merge-pairs")

    def top(self, k: int) -> list[tuple[int, int]]:
        """(n, code) of the ``k`` most frequent pairs (k rows a partition, merged)."""
        return [(r.n, r.code) for r in self.pairs.orderBy(F.desc("n"), "code").limit(k).collect()]

    def at_least(self, floor: int, most: int) -> list[tuple[int, int]]:
        """All pairs of that count, or none when they are more than ``most``."""
        got = [(r.n, r.code) for r in self.pairs.where(F.col("n") >= floor).limit(most + 1).collect()]
        return got if len(got) <= most else []

    def ranked(self, n: int, names: list[str], k: int) -> list[dict]:
        """The first ``k`` pairs of count ``n`` by their symbols' names."""
        name = self.spark.createDataFrame(list(enumerate(names)), "id int, name string")
        rows = (self.pairs.where(F.col("n") == n)
                .withColumn("l", F.shiftright("code", 32).cast("int"))
                .withColumn("r", F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"))
                .join(name.select(F.col("id").alias("l"), F.col("name").alias("left")), "l")
                .join(name.select(F.col("id").alias("r"), F.col("name").alias("right")), "r"))
        return [{"left": x.left, "right": x.right, "n": x.n}
                for x in rows.orderBy("left", "right").limit(k).collect()]

    def runs(self, hot: np.ndarray) -> list[tuple[bytes, int]] | None:
        """The distinct runs with their counts; None when they are too many."""
        hot = self.spark.sparkContext.broadcast(hot)
        found = materialize(self.words.mapInArrow(_cut(hot), "run binary, n long")
                            .groupBy("run").agg(F.sum("n").alias("n")), "merge-runs")
        rows, size = found.agg(F.count("*"), F.coalesce(F.sum(F.length("run")), F.lit(0))).first()
        got = None
        if rows <= MAX_RUNS and size <= MAX_RUN_BYTES:
            t = found.toArrow()
            got = list(zip(t["run"].to_pylist(), t["n"].to_pylist()))
        discard(found)
        return got

    def put_back(self, hot: np.ndarray, new: dict[bytes, bytes]) -> None:
        sc = self.spark.sparkContext
        step = materialize(self.words.mapInArrow(_put_back(sc.broadcast(hot), sc.broadcast(new)),
                                                 "word binary, n long, code long"), "merge-words")
        old = self.words, self.pairs
        self.pairs = self._sum(self.pairs.union(step.where("code is not null").select("code", "n")))
        self.words = step.where("code is null").select("word", "n")
        self.words._maskweave_path = step._maskweave_path
        discard(*old)

    def put_pairs(self, merges: list[tuple[int, int, int]]) -> None:
        """Applies merges (left, right, merged) of pairs that never overlap."""
        to = {l << 32 | r: m for l, r, m in merges}
        hot = np.sort(np.array(list(to), np.int64))
        pairs = {np.array([c >> 32, c & 0xFFFFFFFF], "<i4").tobytes(): np.array([m], "<i4").tobytes()
                 for c, m in to.items()}
        self.put_back(hot, _Pairs(pairs))

    def release(self) -> None:
        discard(*(self.__dict__[t] for t in ("words", "pairs") if t in self.__dict__))


class _Pairs(dict):
    """What becomes of a run of pairs that never overlap: a pair, or a
    symbol of a pair with itself several times, taken from the left."""

    def get(self, run: bytes):
        if len(run) == 8:
            return super().get(run)
        made = super().get(run[:8])
        return made * (len(run) // 8) + run[len(run) // 8 * 8:]


def merge_runs(found: list[tuple[bytes, int]], floor: int, symbols: list[str], merged_name, most: int | None,
               room: int | None, known: set[str]):
    """(merges, new): merges one at a time over runs, and what becomes of the
    runs that change.  ``symbols`` grows by the new ones; ``most`` merges and
    ``room`` pieces outside ``known`` at most.  A merge is (left, right,
    merged, n, whether the piece is new)."""
    ids_of = {s: i for i, s in enumerate(symbols)}
    lists = [np.frombuffer(r, "<i4").tolist() for r, _ in found]
    weight = [n for _, n in found]
    count: dict[tuple, int] = {}
    where: dict[tuple, set] = {}
    for i, s in enumerate(lists):
        for pair in zip(s, s[1:]):
            count[pair] = count.get(pair, 0) + weight[i]
            where.setdefault(pair, set()).add(i)
    heap = [(-n, symbols[a], symbols[b], (a, b)) for (a, b), n in count.items()]
    heapq.heapify(heap)
    merges, made, touched = [], set(), set()
    while heap and (most is None or len(merges) < most) and (room is None or len(made) < room):
        n, left, right, pair = heapq.heappop(heap)
        if count.get(pair) != -n:
            continue  # counted anew since
        if -n < floor:
            break
        name = merged_name(left, right)
        exists = name in ids_of
        if exists and merges:
            break
        if not exists:
            ids_of[name] = len(symbols)
            symbols.append(name)
        is_new = name not in known and name not in made
        if is_new:
            made.add(name)
        merges.append((left, right, name, -n, is_new))
        change: dict[tuple, int] = {}
        a, b, to = *pair, ids_of[name]
        for i in where.pop(pair):
            s, w = lists[i], weight[i]
            out, k, last = [], 0, len(s) - 1
            while k <= last:
                if s[k] == a and k < last and s[k + 1] == b:
                    out.append(to)
                    k += 2
                else:
                    out.append(s[k])
                    k += 1
            if len(out) == len(s):
                continue  # the pair went with an earlier merge
            for q in zip(s, s[1:]):
                change[q] = change.get(q, 0) - w
            for q in zip(out, out[1:]):
                change[q] = change.get(q, 0) + w
                where.setdefault(q, set()).add(i)
            lists[i] = out
            touched.add(i)
        for q, d in change.items():
            if d:
                count[q] = count.get(q, 0) + d
                if count[q] > 0:
                    heapq.heappush(heap, (-count[q], symbols[q[0]], symbols[q[1]], q))
        if exists:
            break
    return merges, {found[i][0]: np.array(lists[i], "<i4").tobytes() for i in touched}
