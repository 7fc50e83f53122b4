"""Removal of repeated byte strings by column-wise construction.

Every byte of a document that is covered by a string of ``length`` bytes which
also starts in a document with a smaller doc_id is removed; strings are judged
on the input and never cross documents.

1. Equal texts collapse by digest: only the row with the smallest doc_id is
   judged, its copies are covered whole (if ``length`` bytes long at all).
2. Tasks pick anchors: of the GRAM-byte grams inside a string of ``length``
   bytes the one (or, of equal ones, all) with the least hash.  Equal strings
   have equal anchors, so only strings at an anchor that two documents share
   can repeat.  Distinct anchor hashes of each block of texts are compared
   bucket by bucket.
3. Around each shared anchor stands a context that holds all strings with this
   anchor.  The distinct contexts of a block go to the bucket of their anchor,
   with the smallest doc_id that has them.  There the collection is built
   column by column: every round puts one symbol before the suffix of each
   context, and a pass over the order of the suffixes (the transform) and
   their common prefixes gives the next order and prefixes.  Where neighbours
   share ``length`` symbols, the strings are equal, and the smallest doc_id of
   each such run is known.
4. Blocks get back which strings of which contexts have an earlier document,
   mark the bytes, and give what is left.

Bucket state is bounded by the number of buckets, which grows with the corpus,
and stays in arrays; only the shuffles are external files.  Null texts count as
empty; a null doc_id comes after all others.  Texts shorter than ``length``
lose nothing.  Rows that repeat a doc_id do not cover one another.  Texts are
never cut short; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskweave.llm.common import attach_group, bucketed, mix, text_bytes, trimmed
from maskweave.session import materialize

LENGTH, GRAM = 50, 16
#: Bytes of text in a block, and of a step inside it.
BLOCK, STEP = 1 << 22, 1 << 20
#: Bytes of text whose anchors share a bucket; several buckets make a task.
BUCKET = 4 << 20
#: Up to so many copies (40 bytes each) are broadcast to drop them; more are
#: dropped by a shuffle join.
FEW_COPIES = 200_000
NOBODY = np.int64(np.iinfo(np.int64).max)
PAD = 0xFF  # never a byte of UTF-8

_BLOCK_COLUMNS = "block long, ids array<long>, digests binary, sizes array<int>, body binary"
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _blocks(batches):
    held, size = [], 0
    for b in batches:
        ids = b.column(0).to_pylist()
        off, data = text_bytes(b.column(1))
        digests = b.column(2).to_pylist()
        for k, doc in enumerate(ids):
            held.append((NOBODY if doc is None else doc, digests[k], data[off[k]:off[k + 1]].tobytes()))
            size += len(held[-1][2])
            if size >= BLOCK or len(held) >= 100_000:
                yield _pack(held)
                held, size = [], 0
    if held:
        yield _pack(held)


def _pack(held):
    return pa.RecordBatch.from_arrays([
        pa.array([uuid.uuid4().int >> 65]), pa.array([[h[0] for h in held]], pa.list_(pa.int64())),
        pa.array([b"".join(h[1] for h in held)]), pa.array([[len(h[2]) for h in held]], pa.list_(pa.int32())),
        pa.array([b"".join(h[2] for h in held)])], [c.split()[0] for c in _BLOCK_COLUMNS.split(", ")])


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each ``width`` neighbours of x."""
    have = 1
    while have < width:
        more = min(have, width - have)
        x = pick(x[:len(x) - more], x[more:])
        have += more
    return x


class Block:
    """Texts of a block with the places of their anchors."""

    def __init__(self, b, k: int, length: int):
        self.ids = b.column("ids")[k].values.to_numpy()
        self.sizes = b.column("sizes")[k].values.to_numpy().astype(np.int64)
        self.digests = b.column("digests")[k].as_py()
        self.data = np.frombuffer(b.column("body")[k].as_buffer(), np.uint8)
        self.ends = np.cumsum(self.sizes)
        self.begins = self.ends - self.sizes
        self.length = length
        self.at, self.gram = self._anchors()
        self.doc = np.searchsorted(self.ends, self.at, "right")

    def _anchors(self):
        n, length = len(self.data), self.length
        width = length - GRAM + 1
        places, grams = [], []
        starts = np.zeros(max(n - length + 1, 0), bool)  # where a string of one document starts
        for b, e in zip(self.begins, self.ends):
            if e - b >= length:
                starts[b:e - length + 1] = True
        for a in range(0, len(starts), STEP):
            z = min(a + STEP, len(starts))
            raw = np.ascontiguousarray(self.data[a:z + length - 1])
            if not starts[a:z].any():
                continue
            word = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,)).astype(np.uint64)
            h = mix(mix(word[:-8] * _GOLD) + word[8:])
            least = _slide(h, width, np.minimum)
            least[~starts[a:z]] = 0
            wall = np.zeros(width - 1, np.uint64)
            most = _slide(np.concatenate([wall, least, wall]), width, np.maximum)
            at = np.flatnonzero((most == h) & (h > 0))
            places.append(at + a)
            grams.append(h[at])
        if not places:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        at, first = np.unique(np.concatenate(places), return_index=True)
        return at, np.concatenate(grams)[first]

    def contexts(self, shared: np.ndarray):
        """Places of shared anchors, their distinct contexts (a matrix padded
        outside the document), the context of each place, and the smallest
        doc_id of each context."""
        keep = np.isin(self.gram, shared, kind="sort")
        at, gram, doc = self.at[keep], self.gram[keep], self.doc[keep]
        before = self.length - GRAM
        width = before + self.length
        print1, print2 = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
        rows = []
        for a in range(0, len(at), 1 << 16):
            where = at[a:a + (1 << 16), None] + np.arange(-before, self.length)
            d = doc[a:a + (1 << 16), None]
            inside = (where >= self.begins[d]) & (where < self.ends[d])
            got = np.where(inside, self.data[np.where(inside, where, 0)], np.uint8(PAD))
            rows.append(got)
            wide = np.zeros((len(got), -(-width // 8) * 8), np.uint8)
            wide[:, :width] = got
            for column in wide.view("<u8").astype(np.uint64).T:
                print1[a:a + len(got)] = mix(print1[a:a + len(got)] * _GOLD + column)
        matrix = np.concatenate(rows) if rows else np.empty((0, width), np.uint8)
        _, first, of = np.unique(print1, return_index=True, return_inverse=True)
        least = np.full(len(first), NOBODY)
        np.minimum.at(least, of, self.ids[doc])
        return at, gram[first], doc, matrix[first], of, least


def _list(value, kind):
    return pa.array([value], pa.list_(kind))


def _anchor_rows(length: int, buckets: int):
    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                block = Block(b, k, length)
                order = np.lexsort((block.doc, block.gram))
                gram, doc = block.gram[order], block.doc[order]
                if not len(gram):
                    continue
                new = np.ones(len(gram), bool)
                new[1:] = (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])
                gram, n = np.unique(gram[new], return_counts=True)
                # a gram that two documents of the block have is shared already
                bucket = (gram >> np.uint64(20)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                gram, n, bucket = gram[order], n[order], bucket[order]
                names, first = np.unique(bucket, return_index=True)
                for name, part, many in zip(names, np.split(gram, first[1:]), np.split(n > 1, first[1:])):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([int(name)], pa.int64()), b.column("block").slice(k, 1),
                        pa.array([part[~many].tobytes()]), pa.array([part[many].tobytes()])],
                        ["bucket", "block", "once", "often"])
    return run


def _shared(batches):
    """Per bucket: which grams of each block stand in another document."""
    for b in batches:
        for parts in b.column("parts"):
            rows = [(r["block"], np.frombuffer(r["once"], "<u8"), np.frombuffer(r["often"], "<u8"))
                    for r in parts.as_py()]
            every = np.sort(np.concatenate([x for _, once, often in rows for x in (once, often, often)]))
            found = np.unique(every[1:][every[1:] == every[:-1]])
            for block, once, often in rows:
                got = np.concatenate([np.intersect1d(once, found, assume_unique=True), often])
                if len(got):
                    yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([got.tobytes()])],
                                                     ["block", "grams"])


def _grams(b, k):
    parts = b.column("grams")[k].as_py() or []
    return np.frombuffer(b"".join(parts), "<u8")


def _context_rows(length: int, buckets: int):
    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                shared = _grams(b, k)
                if not len(shared):
                    continue
                at, gram, doc, matrix, of, least = Block(b, k, length).contexts(shared)
                bucket = (gram >> np.uint64(20)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                names, first = np.unique(bucket[order], return_index=True)
                for name, rows in zip(names, np.split(order, first[1:])):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([int(name)], pa.int64()), b.column("block").slice(k, 1),
                        pa.array([rows.astype("<u4").tobytes()]), pa.array([least[rows].tobytes()]),
                        pa.array([matrix[rows].tobytes()])], ["bucket", "block", "places", "least", "symbols"])
    return run


def columns(matrix: np.ndarray, length: int):
    """Column-wise construction over equally long contexts, last column first.

    Yields (column, order, prefix) for the columns at which a string of
    ``length`` symbols fits: ``order`` sorts the suffixes that begin there,
    ``prefix[i]`` is the common prefix of the suffixes at i and i - 1, counted
    up to ``length``.
    """
    n, width = matrix.shape
    order = np.arange(n)
    prefix = np.zeros(n, np.int32)
    prefix[1:] = length  # empty suffixes are equal as far as they go
    for column in range(width - 1, -1, -1):
        symbol = matrix[order, column]
        next_ = np.argsort(symbol, kind="stable")  # the symbols before the sorted suffixes
        s = symbol[next_]
        new = np.zeros(n, np.int32)
        if n > 1:
            same = np.flatnonzero(s[1:] == s[:-1]) + 1
            if len(same):
                # least common prefix between the two places in the order before
                cut = np.empty(2 * len(same), np.int64)
                cut[::2], cut[1::2] = next_[same - 1] + 1, next_[same] + 1
                padded = np.append(prefix, length).astype(np.int32)
                new[same] = np.minimum(np.minimum.reduceat(padded, cut)[::2] + 1, length)
        if column == width - 1:
            new = np.minimum(new, 1)
        else:
            new = np.minimum(new, width - column)
        order, prefix = order[next_], new
        if column <= width - length:
            yield column, order, prefix


def _judge(length: int):
    """Per bucket: for each context the strings that an earlier document has."""
    before = length - GRAM

    def run(batches):
        for b in batches:
            for parts in b.column("parts"):
                rows = parts.as_py()
                places = [np.frombuffer(r["places"], "<u4") for r in rows]
                least = np.concatenate([np.frombuffer(r["least"], np.int64) for r in rows])
                matrix = np.concatenate([np.frombuffer(r["symbols"], np.uint8).reshape(-1, before + length)
                                         for r in rows])
                earlier = np.zeros(len(least), np.uint64)
                for column, order, prefix in columns(matrix, length):
                    run_of = np.cumsum(prefix < length) - 1
                    first = np.full(run_of[-1] + 1, NOBODY)
                    np.minimum.at(first, run_of, least[order])
                    whole = (matrix[order, column] != PAD) & (matrix[order, column + length - 1] != PAD)
                    hit = order[(first[run_of] < least[order]) & whole]
                    earlier[hit] |= np.uint64(1) << np.uint64(column)
                at = 0
                for r, p in zip(rows, places):
                    bits = earlier[at:at + len(p)]
                    at += len(p)
                    if bits.any():
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([r["block"]]), pa.array([p[bits > 0].tobytes()]),
                             pa.array([bits[bits > 0].tobytes()])], ["block", "places", "bits"])
    return run


def _remove(length: int):
    """Per text of a block: spans removed and the bytes left."""
    before = length - GRAM

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                block, shared = Block(b, k, length), _grams(b, k)
                hit = np.zeros(len(block.data), bool)  # where a removed string starts
                if len(shared):
                    at, _, doc, matrix, of, least = block.contexts(shared)
                    bits = np.zeros(len(least), np.uint64)
                    for r in b.column("judged")[k].as_py() or []:
                        bits[np.frombuffer(r["places"], "<u4")] = np.frombuffer(r["bits"], "<u8")
                    all_ = block.ids[doc] > least[of]  # the block itself has an earlier document
                    for column in range(before + 1):
                        s = at - before + column
                        ok = (s >= block.begins[doc]) & (s + length <= block.ends[doc])
                        ok &= all_ | (bits[of] >> np.uint64(column) & np.uint64(1) > 0)
                        hit[s[ok]] = True
                seen = np.cumsum(hit, dtype=np.int32)
                seen[length:] -= seen[:-length].copy()
                gone = seen > 0
                starts, ends, kept = [], [], []
                for x, y in zip(block.begins, block.ends):
                    g = np.diff(np.concatenate([[False], gone[x:y], [False]]).astype(np.int8))
                    starts.append(np.flatnonzero(g == 1)), ends.append(np.flatnonzero(g == -1))
                    kept.append(block.data[x:y][~gone[x:y]].tobytes())
                for a in range(0, len(kept), 1000):
                    z = min(a + 1000, len(kept))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([block.digests[32 * i:32 * i + 32] for i in range(a, z)], pa.binary()),
                        pa.array(starts[a:z], pa.list_(pa.int64())), pa.array(ends[a:z], pa.list_(pa.int64())),
                        pa.array(kept[a:z], pa.binary())], ["digest", "starts", "ends", "kept"])
    return run


def _digest(text):
    return F.unhex(F.sha2(text.cast("binary"), 256))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """For each distinct text, judged as the document with the smallest doc_id
    that has it: digest (SHA-256 of the text), starts and ends of the removed
    runs in bytes, and the bytes ``kept``.  Rows that repeat this document
    repeat its row."""
    if not GRAM <= length <= GRAM + 63:
        raise ValueError(f"length must be {GRAM} to {GRAM + 63}")
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), _digest(text).alias("digest"))
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows"))
    narrow = rows.select("digest", "doc_id").distinct()
    copies = materialize(narrow.join(first.where("rows > 1"), "digest").where("not (doc_id <=> first)")
                         .select(F.col("digest").alias("d"), F.col("doc_id").alias("i")), "copies")
    if copies.count() <= FEW_COPIES:
        copies = F.broadcast(copies)
    judged = rows.join(copies, (rows["digest"] == copies["d"]) & rows["doc_id"].eqNullSafe(copies["i"]), "left_anti")
    blocks = bucketed(judged.select("doc_id", "text", "digest").mapInArrow(trimmed(_blocks), _BLOCK_COLUMNS), "blocks", "block")
    total = blocks.agg(F.sum(F.length("body"))).first()[0] or 0
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET)

    anchors = (blocks.mapInArrow(trimmed(_anchor_rows(length, buckets)), "bucket long, block long, once binary, often binary")
               .groupBy("bucket").agg(F.collect_list(F.struct("block", "once", "often")).alias("parts"))
               .select("parts").mapInArrow(trimmed(_shared), "block long, grams binary"))
    grams = materialize(anchors.groupBy("block").agg(F.collect_list("grams").alias("grams")), "shared-grams")
    known = blocks.join(grams, "block", "left")
    contexts = (known.mapInArrow(trimmed(_context_rows(length, buckets)),
                                 "bucket long, block long, places binary, least binary, symbols binary")
                .groupBy("bucket").agg(F.collect_list(F.struct("block", "places", "least", "symbols")).alias("parts"))
                .select("parts").mapInArrow(trimmed(_judge(length)), "block long, places binary, bits binary"))
    found = materialize(contexts.groupBy("block").agg(
        F.collect_list(F.struct("places", "bits")).alias("judged")), "judged")
    return known.join(found, "block", "left").mapInArrow(
        trimmed(_remove(length)), "digest binary, starts array<long>, ends array<long>, kept binary")


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _digest(text).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes")), "digests")
    found = remove_repeats(docs, length).select(
        "digest", F.size("starts").cast("long").alias("spans"), F.sha2("kept", 256).alias("sha"),
        F.length("kept").cast("long").alias("left")).dropDuplicates(["digest"])
    sizes = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows"))
    groups = materialize(sizes.join(found, "digest"), "removed")
    whole = (F.col("n_bytes") >= length) & ~F.col("doc_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull()
    empty = hashlib.sha256(b"").hexdigest()
    return attach_group(rows, groups, "digest", "rows").select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.col("n_bytes") - F.col("left")).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.col("spans")).alias("n_spans"),
        F.when(whole, F.lit(empty)).otherwise(F.col("sha")).alias("kept_sha256"))
