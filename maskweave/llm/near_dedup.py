"""Near-duplicate groups by SuperMinHash, banding, verification on full
shingle sets and union-find grouping.

A document's set holds the distinct runs of ``size`` words (64-bit hashes);
a text with fewer words is one run, a text without words (or null) has an
empty set and no links.  Documents are linked when
``100 * intersection >= percent * union`` holds for their full sets, and a
group is everything that links reach.  Steps, all as Spark jobs:

1. Tasks sketch each text: one permutation of the registers per element,
   drawn step by step, so that registers receive correlated ranks of lower
   variance; drawing stops early, once every register of a text is filled.
2. Documents with equal sets collapse to the smallest doc_id before any
   pair is made, so exact copies never meet.
3. Band keys of the representatives meet in buckets.  In each bucket every
   member is paired with one pivot only; pairs are verified on full sets, and
   the links found are grouped.  The first pivot is the bucket's smallest
   member; in the rounds after it, where a bucket still holds several groups,
   the smallest member outside the group that has the smallest one.
4. Buckets whose members then are one group, however large, are done.  In the
   others all members are compared by longer signatures, block against block
   of MEMBERS members, so that no task holds more than two blocks.  A task
   names the members that have a partner in another group whose signature
   agrees within four standard deviations of the threshold, not the pairs.
5. Named members of a bucket meet again with their full sets, block against
   block.  A task counts the common elements of members of different groups
   and gives a spanning forest of the links, so that what leaves it grows with
   the members, whatever the number of pairs near the threshold.

With 128 registers in 32 bands of 4, a pair at similarity 0.8 shares no
bucket with probability 5e-8, and fails the comparison of signatures with at
most 3e-5.  Rows with a null doc_id take part in no link and stay; rows that
repeat a doc_id are one node of the graph.  Equal similarities need no order:
groups depend on links alone.  An empty table gives no rows; columns other
than doc_id and text are not read (``deduplicate`` keeps them).  The sets of
long texts are sketched in parts of PART elements, whose registers are joined
by minimum: 40 bytes for each word of the longest text, besides some 60 MB.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskweave.llm.common import bucketed, components, distinct_per_text, mix, shingles, trimmed, word_slices
from maskweave.session import discard, materialize

REGISTERS, BANDS = 128, 32
#: Registers of the second comparison, a byte of each.
LONG = 512
#: Members of a bucket that are compared with each other at a time.
MEMBERS = 1000
#: Rounds of pivots, and elements of the sets of a block.
PIVOTS, BLOCK_ELEMENTS = 2, 1 << 20
#: Elements sketched at a time.
PART = 50_000
EMPTY = np.int32(np.iinfo(np.int32).max)


def superminhash(elements: np.ndarray, counts: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """Signatures (texts x m) of sets given as distinct 64-bit elements, text
    after text.  A register holds the rank above as many bits of the draw as
    31 bits leave for ranks below m; EMPTY for empty sets."""
    bits = 31 - (m - 1).bit_length()
    out = np.full((len(counts), m), EMPTY, np.int32)
    flat = out.ravel()
    doc = np.repeat(np.arange(len(counts)), counts)
    perm = np.empty((len(elements), m), np.uint8 if m <= 256 else np.uint16)
    perm[:] = np.arange(m, dtype=perm.dtype)
    live = np.arange(len(elements))
    for j in range(m):
        if not len(live):
            break
        x = mix(elements[live] + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        k = j + (((x & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64)
        got = perm[live, k]
        perm[live, k] = perm[live, j]
        perm[live, j] = got
        value = (np.int64(j) << bits | (x >> np.uint64(64 - bits)).astype(np.int64)).astype(np.int32)
        np.minimum.at(flat, doc[live] * m + got, value)
        open_ = (out == EMPTY).any(axis=1)
        live = live[open_[doc[live]]]
    return out


def signatures(elements: np.ndarray, counts: np.ndarray, m: int = REGISTERS):
    """Yields (lo, hi, signatures) of texts lo..hi, PART elements at a time.  A
    larger set is sketched part by part: a register is the minimum over them."""
    ends = np.cumsum(counts)
    lo = 0
    while lo < len(counts):
        base = ends[lo] - counts[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, base + PART, "right")))
        if counts[lo] > PART:
            out = np.full((1, m), EMPTY, np.int32)
            for a in range(base, ends[lo], PART):
                part = elements[a:min(a + PART, ends[lo])]
                np.minimum(out, superminhash(part, np.array([len(part)]), m), out=out)
        else:
            out = superminhash(elements[base:ends[hi - 1]], counts[lo:hi], m)
        yield lo, hi, out
        lo = hi


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per text and band."""
    n, m = signatures.shape
    rows = m // bands
    s = signatures[:, :bands * rows].reshape(n, bands, rows).astype(np.uint64)
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (n, bands)).copy()
    for r in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + s[:, :, r])
    return key.view(np.int64)


def _sketch(size: int, bands: int):
    def run(batches):
        for b in batches:
            ids = b.column(0)
            for lo, hi, h, counts in word_slices(b.column(1)):
                e, n = distinct_per_text(*shingles(h, counts, size))
                cut = np.append(0, np.cumsum(n))
                sums = np.append(np.uint64(0), np.cumsum(mix(e.copy())))
                also = np.append(np.uint64(0), np.cumsum(mix(e ^ np.uint64(0x5BD1E995))))
                for a, z, signature in signatures(e, n):
                    keys = band_keys(signature, bands)
                    yield pa.RecordBatch.from_arrays([
                        ids.slice(lo + a, z - a).cast(pa.int64()), pa.array(n[a:z].astype(np.int64)),
                        pa.array((sums[cut[a + 1:z + 1]] - sums[cut[a:z]]).view(np.int64)),
                        pa.array((also[cut[a + 1:z + 1]] - also[cut[a:z]]).view(np.int64)),
                        pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), bands).cast(pa.list_(pa.int64()))],
                        ["doc_id", "n_shingles", "s1", "s2", "keys"])
    return run


def _sets(size: int):
    def run(batches):
        for b in batches:
            ids = b.column(0)
            for lo, hi, h, counts in word_slices(b.column(1)):
                e, n = distinct_per_text(*shingles(h, counts, size))
                off = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo).cast(pa.int64()),
                     pa.ListArray.from_arrays(pa.array(off), pa.array(e.view(np.int64)))], ["id", "elements"])
    return run


def _compare(percent: int):
    """Members of two blocks of a bucket that may have a link to a member of
    another group.  A pair that shares several buckets counts in the one of
    its first shared band only."""
    share = percent / 100
    least = LONG * share - 4 * (LONG * share * (1 - share)) ** 0.5

    def run(batches):
        for b in batches:
            for key, band, i, j, members in zip(*(b.column(k).to_pylist() for k in range(4)), b.column(4)):
                x = members.values.field("x")
                own = members.values.field("own").to_numpy()
                rep, comp, n = (x.field(k).to_numpy() for k in ("rep", "comp", "n"))
                keys = x.field("keys").flatten().to_numpy().reshape(len(rep), -1)
                sig = np.frombuffer(b"".join(x.field("signature").to_pylist()), np.uint8).reshape(len(rep), -1)
                left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
                named = np.zeros(len(rep), bool)
                for k in range(0, len(left), 16):
                    q = left[k:k + 16]
                    near = (sig[q][:, None] == sig[right][None]).sum(axis=2) >= least
                    near &= comp[q][:, None] != comp[right][None]
                    near &= 100 * np.minimum(n[q][:, None], n[right]) >= percent * np.maximum(n[q][:, None], n[right])
                    f, g = np.nonzero(near)
                    first = (keys[q[f]] == keys[right[g]]).argmax(axis=1) == band
                    named[q[f[first]]] = named[right[g[first]]] = True
                if named.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(named.sum(), key)), pa.array(rep[named])], ["key", "rep"])
    return run


def common_elements(query: np.ndarray, elements: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """Elements that the set ``query`` shares with each of ``owners`` sets,
    given as sorted ``elements`` with their owners."""
    lo, hi = np.searchsorted(elements, query, "left"), np.searchsorted(elements, query, "right")
    n = hi - lo
    at = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
    return np.bincount(owner[at], minlength=owners)


def forest(sets: list[np.ndarray], group: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int):
    """Links (i, j), i of ``left`` and j of ``right``, that join groups: a
    spanning forest of all links between members of different groups."""
    group = group.copy()
    size = np.array([len(x) for x in sets])
    names, first, counts = np.unique(group[left], return_index=True, return_counts=True)
    large = names[counts.argmax()]
    for mine in (True, False):  # the largest group needs only what lies outside it
        rows = left[(group[left] == large) == mine] if mine else rest
        if mine:
            rest = np.setdiff1d(left, rows)
        against = right[group[right] != large] if mine else right
        if not len(rows) or not len(against):
            continue
        elements = np.concatenate([sets[j] for j in against])
        owner = np.repeat(np.arange(len(against)), size[against])
        order = np.argsort(elements, kind="stable")
        elements, owner = elements[order], owner[order]
        for i in rows:
            if (group[against] == group[i]).all():
                continue
            both = common_elements(sets[i], elements, owner, len(against))
            held = (100 * both >= percent * (size[i] + size[against] - both)) & (group[against] != group[i])
            for j in against[held]:
                if group[j] != group[i]:
                    yield i, j
                    group[group == group[j]] = group[i]


def _confirm(percent: int):
    """Forests of the links between two blocks of members with full sets."""
    def run(batches):
        for b in batches:
            for i, j, members in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                own, rep, comp = (members.values.field(k).to_numpy() for k in ("own", "rep", "comp"))
                lists = members.values.field("elements")
                off, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
                sets = [flat[a:z] for a, z in zip(off[:-1], off[1:])]
                pairs = list(forest(sets, comp, np.flatnonzero(own == i), np.flatnonzero(own == j), percent))
                if pairs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rep[[p[0] for p in pairs]]), pa.array(rep[[p[1] for p in pairs]])], ["u", "v"])
    return run


def _long_signatures(batches):
    """(rep, signature) of sets."""
    for b in batches:
        off = b.column(1).offsets.to_numpy().astype(np.int64)
        e = b.column(1).flatten().to_numpy().view(np.uint64)
        for lo, hi, got in signatures(e, np.diff(off), LONG):
            raw = pa.py_buffer(got.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, hi - lo),
                 pa.Array.from_buffers(pa.binary(LONG), hi - lo, [None, raw]).cast(pa.binary())], ["rep", "signature"])


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that hold on full sets."""
    both = F.size(F.array_intersect("a", "b")).cast("long")
    return (pairs.join(sets.select(F.col("id").alias("u"), F.col("elements").alias("a")), "u")
            .join(sets.select(F.col("id").alias("v"), F.col("elements").alias("b")), "v")
            .where((100 * both >= percent * (F.size("a") + F.size("b") - both)) & (F.size("a") > 0))
            .select("u", "v"))


def _mixed(members: DataFrame, groups: DataFrame) -> DataFrame:
    """The members of buckets that hold several groups, with their group
    ``comp`` and the smallest group of their bucket, ``low``."""
    placed = materialize(members.select("key", "band", "rep", "n")
                         .join(groups.withColumnRenamed("node", "rep"), "rep", "left")
                         .withColumn("comp", F.coalesce("comp", "rep")), "placed")
    several = (placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
               .where("low != high").select("key", "low"))
    out = materialize(placed.join(several, "key"), "mixed")
    discard(placed)
    return out


def _joined(groups: DataFrame, links: DataFrame) -> DataFrame:
    """The groups that further links make of ``groups``."""
    links = materialize(links, "links")
    if links.isEmpty():
        return groups
    out = components(groups.select(F.col("node").alias("u"), F.col("comp").alias("v")).union(links), "groups")
    discard(groups, links)
    return out


def _blocks(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """``rows`` with their block of their bucket (``own``), once for each
    pair of blocks i <= j that it is in."""
    return (rows.join(blocks, "key").withColumn("own", F.expr("cast(pmod(xxhash64(rep), blocks) as int)"))
            .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
            .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
            .drop("blocks", "other"))


def near_groups(docs: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the smallest
    doc_id that links reach, itself included) and ``kept``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = materialize(texts.mapInArrow(
        trimmed(_sketch(size, bands)), "doc_id long, n_shingles long, s1 long, s2 long, keys array<long>"), "sketch")
    full = sketch.where("n_shingles > 0 and doc_id is not null")
    same = ["n_shingles", "s1", "s2"]
    reps = materialize(full.groupBy(*same).agg(F.min_by("keys", "doc_id").alias("keys"),
                                               F.min("doc_id").alias("rep")), "reps")
    copies = full.join(reps.select(*same, "rep"), same).where("doc_id != rep").select(
        F.col("rep").alias("u"), F.col("doc_id").alias("v"))

    rows = reps.select(F.posexplode("keys").alias("band", "key"), "rep", F.col("n_shingles").alias("n"))
    shared = rows.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("low"), F.max("rep").alias("high")) \
        .where("low.rep < high").select("key", F.col("low.rep").alias("u"), F.col("low.n").alias("un"))
    members = materialize(rows.join(shared, "key"), "members")
    fits = f"100 * least(n, un) >= {percent} * greatest(n, un)"
    stars = materialize(members.where("rep != u").where(fits).select("u", F.col("rep").alias("v")).distinct(), "stars")
    ids = members.select(F.col("rep").alias("id")).distinct()
    sets = bucketed(texts.withColumnRenamed("doc_id", "id").join(ids, "id", "left_semi")
                    .mapInArrow(trimmed(_sets(size)), "id long, elements array<long>"), "sets", "id", dealt=True)
    links = materialize(_verify(stars, sets, percent), "links")

    groups = components(links.union(copies), "groups")
    mixed = _mixed(members, groups)
    discard(members, stars, links)
    for _ in range(1, PIVOTS):
        pivots = (mixed.where("comp != low").groupBy("key").agg(F.min(F.struct("rep", "n", "comp")).alias("p"))
                  .select("key", F.col("p.rep").alias("u"), F.col("p.n").alias("un"), F.col("p.comp").alias("uc")))
        stars = (mixed.join(pivots, "key").where("comp != uc").where(fits)
                 .select("u", F.col("rep").alias("v")).distinct())
        groups = _joined(groups, _verify(stars, sets, percent))
        mixed, old = _mixed(mixed, groups), mixed
        discard(old)
    signed = (sets.join(mixed.select(F.col("rep").alias("id")).distinct(), "id", "left_semi")
              .mapInArrow(trimmed(_long_signatures), "rep long, signature binary"))
    sized = mixed.groupBy("key").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("blocks"))
    rows = (_blocks(mixed.join(signed, "rep").join(reps.select("rep", "keys"), "rep"), sized)
            .select("key", "band", "i", "j", "own", F.struct("rep", "comp", "n", "signature", "keys").alias("x"))
            .groupBy("key", "band", "i", "j").agg(F.collect_list(F.struct("own", "x")).alias("members")))
    named = materialize(rows.mapInArrow(trimmed(_compare(percent)), "key long, rep long").distinct(), "named")
    met = mixed.join(named, ["key", "rep"], "left_semi")
    sized = met.groupBy("key").agg(F.ceil(F.greatest(F.count("*") / MEMBERS, F.sum("n") / BLOCK_ELEMENTS))
                                   .cast("int").alias("blocks"))
    rows = (_blocks(met.join(sets.select(F.col("id").alias("rep"), "elements"), "rep"), sized)
            .groupBy("key", "i", "j").agg(F.collect_list(F.struct("own", "rep", "comp", "elements")).alias("members"))
            .select("i", "j", "members"))
    groups = _joined(groups, rows.mapInArrow(trimmed(_confirm(percent)), "u long, v long").distinct())
    discard(mixed, named, sets, reps)
    return (sketch.select("doc_id", "n_shingles")
            .join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("comp", "doc_id").alias("component_id"),
                    F.col("doc_id").eqNullSafe(F.coalesce("comp", "doc_id")).alias("kept")))


def deduplicate(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stay, one of each group, with all their columns."""
    drop = near_groups(docs, size, percent).where("not kept").select(F.col("doc_id").alias("_mw_id")).distinct()
    return docs.join(drop, docs["doc_id"].cast("long") == drop["_mw_id"], "left_anti")
