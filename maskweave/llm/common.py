"""Shared pieces of the operators: reading tables, hashing words inside
tasks, attaching group results without a hot task, connected components."""

from __future__ import annotations

import contextlib
import ctypes
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskweave.session import discard, materialize, scratch_path

#: A group is hot when it holds more than one row in HOT_SHARE; there are at
#: most HOT_SHARE such groups, whatever the size of the table.
HOT_SHARE = 10_000

#: Text bytes that one step of a Python task holds at a time.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def attach_group(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` left-joined with the one-row-per-key table ``groups``.

    ``groups`` has ``key``, the number of rows of the key as ``size`` and
    any other columns.  Rows of hot groups meet a broadcast of at most
    HOT_SHARE group rows, so they are never shuffled to one task; the rest
    is a shuffle join.  Keys are not null.
    """
    total = groups.agg((F.sum(size) / F.lit(HOT_SHARE)).alias("_least"))
    hot = groups.crossJoin(F.broadcast(total)).where(F.col(size) > F.col("_least")).drop("_least")
    extra = [c for c in groups.columns if c != key]
    marked = rows.join(F.broadcast(hot.select(key, F.struct(*extra).alias("_hot"))), key, "left")
    in_hot = marked.where("_hot is not null").select(
        *rows.columns, *[F.col("_hot")[c].alias(c) for c in extra])
    rest = marked.where("_hot is null").select(*rows.columns).join(groups, key, "left")
    return in_hot.unionByName(rest.select(*in_hot.columns))


def bucketed(df: DataFrame, name: str, key: str, dealt: bool = False) -> DataFrame:
    """``df`` written to the shared folder as a table in buckets of ``key``:
    joins and groups on ``key`` do not move its rows.  Each task writes its
    own rows and nothing is shuffled for it; ``dealt`` rows are shuffled once
    before, which leaves one file for each bucket."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    known = f"mw_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if dealt:
        df = df.repartition(n, key)
    (df.write.mode("errorifexists").format("parquet").option("compression", "zstd").option("path", path)
     .bucketBy(n, key).sortBy(key).saveAsTable(known))
    out = spark.table(known)
    out._maskweave_path, out._maskweave_table = path, known
    return out


def trimmed(run):
    """``run`` for ``mapInArrow``; when a task ends, its Python worker, which
    goes on to other tasks, gives freed memory back to the system."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(AttributeError, OSError):
                ctypes.CDLL(None).malloc_trim(0)
    return task


# ---------------------------------------------------------------- words

_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (the public SplitMix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95  # odd, so that powers have inverses
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[0x41:0x5B] += 32
_BYTE_HASH = mix((_BYTES.astype(np.uint64) + np.uint64(1)) * _GOLD)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _powers[name] = np.multiply.accumulate(a)
    return _powers["up"][:n], _powers["down"][:n]


def _hash_words(buf: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start offsets of the words in ``buf``; a word also ends
    where a text begins (``firsts``)."""
    n = len(buf)
    if n == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    word = ~_SPACES[buf]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    inner = firsts[firsts < n]
    begins[inner] = word[inner]
    start = np.flatnonzero(begins)
    ends = word.copy()
    ends[:-1] &= ~word[1:] | begins[1:]
    stop = np.flatnonzero(ends) + 1
    up, down = _power(n)
    total = np.cumsum(_BYTE_HASH[buf] * up)
    h = total[stop - 1]
    h[start > 0] -= total[start[start > 0] - 1]
    h *= down[start]
    return mix(h + (stop - start).astype(np.uint64) * _GOLD), start


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of an Arrow string column, nulls as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    bufs = column.buffers()
    kind = np.int64 if wide else np.int32
    off = np.frombuffer(bufs[1], kind, len(column) + 1 + column.offset)[column.offset:].astype(np.int64) \
        if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and len(bufs[2]) else np.empty(0, np.uint8)
    return off, data


def slices(off: np.ndarray, most: int = SLICE_BYTES):
    """Ranges (lo, hi) of texts of at most ``most`` bytes together; a longer
    text is a range of its own."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi
        lo = hi


def word_slices(column, most: int = SLICE_BYTES):
    """Yields (lo, hi, hashes, counts): the 64-bit hashes of the words
    ``[^\\x20\\x09-\\x0D]+`` of texts lo..hi with A-Z in lower case, text
    after text, and the number of words of each text.  A text longer than
    ``most`` is hashed piece by piece, cut at white space."""
    off, data = text_bytes(column)
    for lo, hi in slices(off, most):
        a, b = int(off[lo]), int(off[hi])
        if b - a <= most:
            h, start = _hash_words(data[a:b], off[lo:hi] - a)
            cuts = np.searchsorted(start, off[lo:hi + 1] - a)
            yield lo, hi, h, np.diff(cuts)
            continue
        parts = []
        while a < b:
            z = min(a + most, b)
            while z < b:  # back to white space, or on to the end of a word longer than a piece
                gap = np.flatnonzero(_SPACES[data[a:z]])
                if len(gap):
                    z = a + int(gap[-1]) + 1
                    break
                z = min(z + most, b)
            parts.append(_hash_words(data[a:z], np.zeros(1, np.int64))[0])
            a = z
        h = np.concatenate(parts)
        yield lo, hi, h, np.array([len(h)])


def shingles(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words of each text, in order, and their
    number per text; a text of fewer words is one run, one of none has none."""
    ends = np.cumsum(counts)
    begins = ends - counts
    runs = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    if len(hashes) == 0:
        return hashes, runs
    doc = np.repeat(np.arange(len(counts)), runs)
    first = begins[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs)
    out = np.full(len(doc), np.uint64(size), np.uint64)
    short = counts[doc] < size
    out[short] = counts[doc][short].astype(np.uint64)
    last = len(hashes) - 1
    for k in range(size):
        more = mix(out * _GOLD + hashes[np.minimum(first + k, last)])
        out = np.where(k < counts[doc], more, out) if short.any() else more
    return out, runs


def distinct_per_text(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each text, sorted, and their number per text."""
    doc = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((values, doc))
    values, doc = values[order], doc[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    return values[keep], np.bincount(doc[keep], minlength=len(counts))


# ---------------------------------------------------------------- graph

def _compress(batches):
    """Union-find over one partition's edges: each node and its smallest."""
    root: dict[int, int] = {}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            root.setdefault(u, u)
            root.setdefault(v, v)
            x, y = find(u), find(v)
            if x != y:
                root[max(x, y)] = min(x, y)
    pairs = [(u, find(u)) for u in root]
    pairs = [p for p in pairs if p[0] != p[1]]
    for i in range(0, len(pairs), 100_000):
        part = pairs[i:i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in part], pa.int64()),
                                          pa.array([p[1] for p in part], pa.int64())], ["u", "v"])


def components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """(node, comp): each node of the links ``edges(u, v)`` that reaches a
    smaller one, with the smallest that it reaches.  Nodes that are the
    smallest themselves, or have no links, are not in the result.

    Each partition first shrinks its links with union-find; then alternating
    large-star and small-star rounds run on the cluster, each written to the
    shared folder, until a round changes nothing.
    """
    e = (edges.select(F.col("u").cast("long"), F.col("v").cast("long"))
         .where("u is not null and v is not null and u != v")
         .mapInArrow(_compress, "u long, v long").distinct())
    e = materialize(e, name)

    def print_of(df):
        r = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(r)

    last = print_of(e)
    if last[0] == 0:
        return e.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
        large = materialize(large, name)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v")))
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .where("u != v").distinct())
        after = materialize(small, name)
        discard(e, large)
        e, now = after, print_of(after)
        if now == last:
            return e.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        last = now
    raise RuntimeError(f"components: no fixed point after {max_rounds} rounds")
