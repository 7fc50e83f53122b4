"""Prefix trie of conversations by range minima over sorted common prefixes.

Every conversation is a sequence of turns, each named by the MD5 of its role
and text, and every distinct sequence of first turns is a node.  The trie is
never built as one: sequences are sorted on the cluster, and nodes are
intervals of the sorted order.

1. Texts are read once, for a digest and a word count per turn; only these
   move.  Conversations may take their first turns from another one
   (``rebuild``).
2. Equal sequences collapse to one row with their number and smallest id.
   The ids of a sequence are hashed in ascending order as a stream of joined
   chunks, so that a sequence of very many conversations is held by no task.
3. Sequences are range-partitioned and sorted; a task holds one range.  It
   takes the longest common prefix (LCP) of neighbours and a sparse table of
   its range minima.  A candidate prefix is a sequence and a depth beyond the
   LCP with the one before.  Each candidate binary-searches its left and
   right extent by itself: the furthest rows between which no LCP is less
   than the depth.  There is no stack and no walk over the trie.
4. Nodes whose interval lies inside the range are final.  The others are
   prefixes of the range's first or last sequence; these two rows alone, with
   the sums so far for each depth, are the input of the next level, where the
   same step runs on them.  A level has two rows for each range of the one
   before; the last one is one task of LEAST entries, or of 16 sequences.

Defined results: turns are ordered by turn, null first, those of equal turn
by the MD5 of role and text; a null role or text is empty; rows without a
conversation id belong to no conversation; rows that repeat are turns of
their own; an empty table has no nodes, not even a root.  Extra columns are
not read.  A conversation is one row of 24 bytes for each turn, whatever the
length of its texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskweave.llm.common import attach_group, trimmed
from maskweave.session import discard, materialize

#: Entries (a sequence and a depth) of a range: a 64th of the table, between these.
LEAST, MOST = 1 << 14, 1 << 18
#: Ids in a chunk of joined ids.
CHUNK = 4096
WORD = r"[^\x20\x09-\x0D]+"
_NONE = np.iinfo(np.int64).max
EMPTY = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- sequences

def sequences(df: DataFrame) -> DataFrame:
    """(conv_id, turns): per conversation its turns in order, each with ``d``,
    the MD5 of role and text, and ``w``, the words of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = df.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("d"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("w"))
    return (turns.where("conv_id is not null").groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("turn", "d", "w"))).alias("turns"))
            .withColumn("turns", F.transform("turns", lambda x: F.struct(x.d.alias("d"), x.w.alias("w")))))


def rebuild(seqs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversation c starts with the first h turns of conversation
    c - c % every, then has its own after its first h; h is crc32(c) % most."""
    base = F.col("conv_id") - F.col("conv_id") % every
    heads = seqs.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    none = F.slice("turns", 1, 0)
    return (seqs.withColumn("base", base).withColumn("h", h).join(heads, "base", "left")
            .select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
                                        F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns")))


def _chunks(batches):
    """Neighbouring ids of one sequence joined, CHUNK at most."""
    key, ids = None, []

    def row():
        return pa.RecordBatch.from_arrays(
            [pa.array([key], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([len(ids)], pa.int64()),
             pa.array([",".join(map(str, ids))])], ["key", "first", "n", "ids"])

    for b in batches:
        for k, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if k != key or len(ids) == CHUNK:
                if ids:
                    yield row()
                key, ids = k, []
            ids.append(i)
    if ids:
        yield row()


def _hashes(batches):
    """(key, conv_id, n, ends): smallest id, number and hash of the joined ids
    of each sequence, from its chunks in order."""
    out, key, low, n, sha = [], None, 0, 0, None
    for b in batches:
        for k, first, m, ids in zip(*(c.to_pylist() for c in b.columns)):
            if k != key:
                if sha is not None:
                    out.append((key, low, n, sha.hexdigest()))
                key, low, n, sha = k, first, 0, hashlib.sha256()
            sha.update((("," if n else "") + ids).encode())
            n += m
        yield _sequences(out)
        out = []
    if sha is not None:
        yield _sequences([(key, low, n, sha.hexdigest())])


def _sequences(rows):
    cols = list(zip(*rows)) or [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.int64(), pa.string()))],
        ["key", "conv_id", "n", "ends"])


def distinct_sequences(seqs: DataFrame) -> DataFrame:
    """(path, words, conv_id, n, ends): one row per distinct sequence."""
    path = F.coalesce(F.unhex(F.array_join("turns.d", "")), F.lit(b""))
    named = materialize(seqs.select("conv_id", path.alias("path"), F.col("turns.w").alias("words"))
                        .withColumn("key", F.unhex(F.md5("path"))), "sequences")
    chunks = (named.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
              .mapInArrow(trimmed(_chunks), "key binary, first long, n long, ids string"))
    ends = (chunks.repartition("key").sortWithinPartitions("key", "first")
            .mapInArrow(trimmed(_hashes), "key binary, conv_id long, n long, ends string"))
    out = materialize(named.select("conv_id", "path", "words").join(ends.drop("key"), "conv_id"), "distinct-sequences")
    discard(named)
    return out


# ---------------------------------------------------------------- one range

class RangeMinima:
    """Sparse table: ``level[k][j]`` is the least of 2^k values from j on."""

    def __init__(self, values: np.ndarray):
        self.level, step = [values], 1
        while 2 * step <= len(values):
            v = self.level[-1]
            self.level.append(np.minimum(v[:-step], v[step:]))
            step *= 2

    def right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last row that shares ``depth`` turns with row ``at``;
        ``values[j]`` is what rows j - 1 and j share."""
        out, n = at.copy(), len(self.level[0])
        for k in range(len(self.level) - 1, -1, -1):
            fits = out + (1 << k) < n
            fits[fits] = self.level[k][out[fits] + 1] >= depth[fits]
            out[fits] += 1 << k
        return out

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first row that shares ``depth`` turns with row ``at``."""
        out = at.copy()
        for k in range(len(self.level) - 1, -1, -1):
            fits = out >= 1 << k
            fits[fits] = self.level[k][out[fits] - (1 << k) + 1] >= depth[fits]
            out[fits] -= 1 << k
        return out


def common_prefixes(turn: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Turns that each row shares with the one before; -1 for the first."""
    out = np.minimum(length, np.append(-1, length[:-1]))
    both = out[1:]
    pair = np.repeat(np.arange(len(both)), both)
    k = np.arange(len(pair)) - np.repeat(np.cumsum(both) - both, both)
    differ = np.flatnonzero((turn[start[pair] + k] != turn[start[pair + 1] + k]).any(axis=1))
    rows, at = np.unique(pair[differ], return_index=True)
    out[rows + 1] = k[differ[at]]
    return out


def _prefix_keys(path: bytes) -> list[bytes]:
    """MD5 of the first 0, 1, ... turns."""
    h, out = hashlib.md5(), []
    out.append(h.digest())
    for i in range(0, len(path), 16):
        h.update(path[i:i + 16])
        out.append(h.digest())
    return out


class Range:
    """The nodes of a sorted range of distinct sequences.

    An entry is a row and a depth from 0 to the row's length; entries are kept
    row after row.  ``parts`` has the sums so far of each entry: conversations
    ``n``, smallest id ``conv``, and of the final nodes below: ``children``,
    ``leaves``, ``saved``; ``ends`` is the place of a hash in ``hashes``."""

    def __init__(self, paths, words, parts: dict[str, np.ndarray], hashes: list[str]):
        self.paths, self.parts, self.hashes = paths, parts, hashes
        self.length = np.array([len(p) // 16 for p in paths], np.int64)
        turn = np.frombuffer(b"".join(paths), np.uint64).reshape(-1, 2)
        start = np.cumsum(self.length) - self.length
        self.lcp = common_prefixes(turn, start, self.length)
        rows = len(paths)
        self.first = start + np.arange(rows)  # entry of depth 0 of each row
        self.words = np.zeros(len(turn) + rows, np.int64)
        self.words[np.setdiff1d(np.arange(len(self.words)), self.first, assume_unique=True)] = words
        self._nodes(rows)

    def _nodes(self, rows: int) -> None:
        # candidates: a row and a depth that the row before does not share
        new = self.length - self.lcp
        row = np.repeat(np.arange(rows), new)
        depth = np.arange(len(row)) - np.repeat(np.cumsum(new) - new, new) + self.lcp[row] + 1
        minima = RangeMinima(self.lcp)
        left, right = minima.left(row, depth), minima.right(row, depth)
        # entries by depth, then row: those of a node lie side by side there
        of = np.repeat(np.arange(rows), self.length + 1)
        order = np.lexsort((of, np.arange(len(of)) - self.first[of]))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        begin = place[self.first[left] + depth]
        by = np.argsort(begin)
        node = np.empty(len(order), np.int64)  # node of each entry
        node[order] = np.repeat(by, np.diff(np.append(begin[by], len(order))))

        def over(name, how):
            out = np.empty(len(row), np.int64)
            out[by] = how.reduceat(self.parts[name][order], begin[by])
            return out

        self.row, self.depth, self.node, self.left, self.right = row, depth, node, left, right
        self.n, self.conv = over("n", np.add), over("conv", np.minimum)
        self.ends = over("ends", np.maximum)
        self.below = {k: over(k, np.add) for k in ("children", "leaves", "saved")}
        self.parent = np.where(depth > 0, node[self.first[row] + np.maximum(depth - 1, 0)], -1)
        self.w = self.words[self.first[row] + depth]
        self.after = np.cumsum(new)[right]  # nodes up to the last row of the interval, in this order

    def settle(self, whole: bool) -> np.ndarray:
        """Completes the sums; which nodes are final.  Where the range is the
        ``whole`` table all are, else those that touch neither end."""
        final = np.ones(len(self.row), bool) if whole else (self.left > 0) & (self.right < len(self.length) - 1)
        counted = final & (self.parent >= 0)
        self.children = self.below["children"] + np.bincount(self.parent[counted], minlength=len(final))
        own = {"leaves": final & (self.children == 0), "saved": np.where(final, (self.n - 1) * self.w, 0)}
        for name, value in own.items():
            total = np.append(0, np.cumsum(value))
            setattr(self, name, self.below[name] + total[self.after] - total[:-1])
        return final

    def edge(self, row: int, beyond: int) -> dict:
        """The sums of a row's nodes, nothing up to depth ``beyond``."""
        at = self.node[self.first[row]:self.first[row] + self.length[row] + 1]
        out = {k: getattr(self, k)[at].copy() for k in ("n", "conv", "children", "leaves", "saved", "ends")}
        for k, v in out.items():
            v[:beyond + 1] = {"conv": _NONE, "ends": -1}.get(k, 0)
        return out


_NODE = [("key", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_key", pa.binary()),
         ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
         ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string())]
_EDGE = [("path", pa.binary()), ("words", pa.list_(pa.int64())),
         *((k, pa.list_(pa.int64())) for k in ("n", "conv", "children", "leaves", "saved")),
         ("hashes", pa.list_(pa.string()))]
_SCHEMA = ("key binary, depth long, conv_id long, parent_key binary, parent_conv_id long, n_convs long, "
           "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, path binary, words array<long>, "
           "n array<long>, conv array<long>, children array<long>, leaves array<long>, saved array<long>, "
           "hashes array<string>")


def _read(t: pa.Table, level: int) -> Range:
    paths = t["path"].to_pylist()
    words = t["words"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    size = np.array([len(p) // 16 + 1 for p in paths])
    if level == 0:  # one hash a row, at its full depth
        n, conv = (np.repeat(t[k].to_numpy(), size) for k in ("n", "conv_id"))
        ends = np.full(size.sum(), -1)
        ends[np.cumsum(size) - 1] = np.arange(len(paths))
        none = np.zeros(size.sum(), np.int64)
        return Range(paths, words, {"n": n, "conv": conv, "children": none, "leaves": none, "saved": none, "ends": ends},
                     t["ends"].to_pylist())
    parts = {k: t[k].combine_chunks().flatten().to_numpy(zero_copy_only=False)
             for k in ("n", "conv", "children", "leaves", "saved")}
    hashes = t["hashes"].combine_chunks().flatten()
    parts["ends"] = np.where(hashes.is_valid().to_numpy(zero_copy_only=False), np.arange(len(hashes)), -1)
    return Range(paths, words, parts, hashes.to_pylist())


def _write(r: Range, final: np.ndarray, level: int):
    """Final nodes, then the rows of the next level."""
    at = np.flatnonzero(final)
    parent = r.parent[at]
    open_ = (parent >= 0) & ~final[parent]
    known = (parent >= 0) & ~open_
    wanted = {}  # prefix keys by row: of the edges, and from level 1 on of all, which lower levels ask for
    for row in ({0, len(r.paths) - 1} if level == 0 else range(len(r.paths))):
        wanted[row] = _prefix_keys(r.paths[row])
    of = lambda x: wanted[int(r.row[x])][int(r.depth[x])] if int(r.row[x]) in wanted else wanted[len(r.paths) - 1][int(r.depth[x])]
    yield from _rows({
        "key": [of(x) for x in at] if level else [None] * len(at), "depth": r.depth[at], "conv_id": r.conv[at],
        "parent_key": [of(p) if o else None for p, o in zip(parent, open_)],
        "parent_conv_id": pa.array(r.conv[parent], mask=~known), "n_convs": r.n[at], "n_children": r.children[at],
        "n_leaves": r.leaves[at], "saved_tokens": r.saved[at],
        "ends_sha256": [r.hashes[e] if e >= 0 else EMPTY for e in r.ends[at].tolist()]}, _NODE, len(at))
    if final.all():
        return
    last = len(r.paths) - 1
    for row, beyond in [(0, -1)] + [(last, int(r.lcp[1:].min()))] * (last > 0):
        sums = r.edge(row, beyond)
        ends = sums.pop("ends").tolist()
        words = r.words[r.first[row] + 1:r.first[row] + r.length[row] + 1]
        yield from _rows({"path": [r.paths[row]], "words": [words], **{k: [v] for k, v in sums.items()},
                          "hashes": [[r.hashes[e] if e >= 0 else None for e in ends]]}, _EDGE, 1)


def _rows(cols: dict, kinds: list, n: int):
    if n:
        arrays = {k: v if isinstance(v, pa.Array) else pa.array(v, t) for (k, t), v in
                  ((kind, cols[kind[0]]) for kind in kinds)}
        yield pa.RecordBatch.from_arrays([arrays.get(k, pa.nulls(n, t)) for k, t in _NODE + _EDGE],
                                         [k for k, _ in _NODE + _EDGE])


def _level(level: int, whole: bool):
    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if batches:
            r = _read(pa.Table.from_batches(batches), level)
            for b in _write(r, r.settle(whole), level):
                for lo in range(0, b.num_rows, 1 << 16):
                    yield b.slice(lo, 1 << 16)
    return run


# ---------------------------------------------------------------- the trie

def trie(seqs: DataFrame) -> DataFrame:
    """The nodes of the trie of sequences (conv_id, turns): conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows, level, found, before = distinct_sequences(seqs), 0, [], None
    while True:
        n, entries = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("path") / 16 + 1), F.lit(0))).first()
        # eight rows a range at least, so that each level is a quarter of the one before, however long its rows
        whole = entries <= LEAST or n <= 16 or n == before
        if whole:
            ranges = rows.coalesce(1)
        else:
            parts = min(-(-entries // max(LEAST, min(MOST, entries // 64))), n // 8)
            ranges = rows.repartitionByRange(int(parts), "path")
        before = n
        out = materialize(ranges.sortWithinPartitions("path").mapInArrow(trimmed(_level(level, whole)), _SCHEMA), "trie")
        found.append(out.where("path is null").select(*[k for k, _ in _NODE]))
        if whole:
            break
        rows, level = out.where("path is not null").select(*[k for k, _ in _EDGE]), level + 1
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    nodes = found[0]
    for more in found[1:]:
        nodes = nodes.union(more)
    done = nodes.where("parent_key is null").select(*names)
    if not level:
        return done
    heads = found[1]
    for more in found[2:]:
        heads = heads.union(more)
    heads = heads.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"),
                         F.col("n_children").alias("_children"))
    rest = attach_group(nodes.where("parent_key is not null").drop("key", "parent_conv_id"), heads, "parent_key", "_children")
    return done.union(rest.withColumnRenamed("above", "parent_conv_id").select(*names))


def conversation_trie(df: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """The trie of the rebuilt conversations of a table (conv_id, turn, role, text)."""
    return trie(rebuild(sequences(df), every, most))
