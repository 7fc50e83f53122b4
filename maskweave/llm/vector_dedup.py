"""Embedding near-duplicates by a PCA-ordered tiled comparison.

Two vectors are linked when their cosine, in double precision, is at least
the threshold.  No link is lost and none is made up.  Steps:

1. Vectors are checked and reduced to bytes; equal ones collapse to the
   smallest id, so copies never meet.
2. The second moments of all unit vectors are summed on the cluster; their
   eigenvectors are the principal axes, strongest first (one matrix per
   number of components; the driver sees only these matrices).
3. Vectors are ordered by their first principal component and cut into blocks
   of equal size by position, so that no value, however frequent, makes a
   block larger.  A block's box (least and greatest of the leading
   components and of the norm left after them) tells which pairs of blocks
   can hold a link at all; each such pair is a tile, and one task's work.
4. In a tile, products of the leading components are accumulated first.  With
   the product of the suffix norms they bound the cosine from above; pairs
   whose bound is below the threshold stop there, the others go on to more
   components, and what is left is confirmed with the given components in
   double precision.
5. A tile gives the number of links of each of its vectors and a spanning
   forest of its links, never the pairs themselves.  Counts are summed, the
   forests are joined by connected components.

The number of tiles grows with the square of the number of blocks where the
boxes do not tell blocks apart; blocks grow with the table up to BLOCK_BYTES,
so that each vector is sent to few of them.

Defined results: vectors that are null, empty, zero, or hold a null or a
component that is not finite link with nothing, nor do rows with a null id;
vectors of different lengths are not linked.  Rows that repeat an id are
vectors of their own for the counts and one node for the components.  Extra
columns are not carried; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskweave.llm.common import attach_group, components, trimmed
from maskweave.operators.position import with_position
from maskweave.session import materialize

#: Bytes of a block's vectors as doubles, at most, and blocks that a table has
#: at least (a block holds LEAST_BLOCK vectors or more).
BLOCK_BYTES, MIN_BLOCKS, LEAST_BLOCK = 16 << 20, 8, 256
#: Components after which the bound is taken; the first is the boxes' too.
STEPS = (8, 16, 32)
#: Rows and columns of a tile that are multiplied at a time.
ROWS, COLUMNS = 512, 2048
#: Bytes of principal axes that are broadcast, at most.
AXES_BYTES = 64 << 20


# ---------------------------------------------------------------- vectors

def _matrix(column, dim: int) -> np.ndarray:
    """(rows x dim) doubles of packed vectors of equal length."""
    return np.frombuffer(b"".join(column), "<f8").reshape(-1, dim)


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _pack(batches):
    """(id, vector): the components as little-endian doubles; null for a
    vector that can have no links."""
    for b in batches:
        col = b.column(1)
        if col.type.value_type != pa.float64():
            col = col.cast(pa.list_(pa.float64()))
        off = col.offsets.to_numpy().astype(np.int64)
        flat = col.values
        bad = ~np.isfinite(flat.to_numpy(zero_copy_only=False)) if not flat.null_count else \
            flat.is_null().to_numpy(zero_copy_only=False) | ~np.isfinite(flat.fill_null(0).to_numpy())
        values = flat.fill_null(0).to_numpy(zero_copy_only=False) + 0.0  # -0.0 becomes 0.0
        wrong = np.append(0, np.cumsum(bad))
        some = np.append(0, np.cumsum(values != 0))
        fine = (wrong[off[1:]] == wrong[off[:-1]]) & (some[off[1:]] > some[off[:-1]])
        if col.null_count:
            fine &= col.is_valid().to_numpy(zero_copy_only=False)
        packed = [values[a:z].astype("<f8").tobytes() if ok else None
                  for a, z, ok in zip(off[:-1].tolist(), off[1:].tolist(), fine.tolist())]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed, pa.binary())], ["id", "vector"])


def _moments(dims):
    """(dim, i, row): sums of products of unit vectors, a row of the matrix each."""
    def run(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            raw = b.column(0).to_pylist()
            for dim in {len(v) // 8 for v in raw} & dims:
                u = unit_rows(_matrix([v for v in raw if len(v) == 8 * dim], dim))
                total[dim] = total.get(dim, 0) + u.T @ u
        for dim, m in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()),
                 pa.array(list(m), pa.list_(pa.float64()))], ["dim", "i", "row"])
    return run


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per number of components the axes as columns, strongest first, of all
    packed ``vector`` values.  The matrices alone come to the driver, at most
    AXES_BYTES of them: lengths in order of their number of vectors.  Vectors
    of a length beyond that keep their components as they are, which costs
    time and changes no result; nor does rounding in the sums."""
    sizes = vectors.groupBy((F.length("vector") / 8).cast("int").alias("dim")).count().collect()
    dims, room = set(), AXES_BYTES
    for r in sorted(sizes, key=lambda r: (-r["count"], r.dim)):
        if 8 * r.dim ** 2 <= room:
            dims.add(r.dim)
            room -= 8 * r.dim ** 2
    parts = vectors.select("vector").mapInArrow(trimmed(_moments(dims)), "dim int, i int, row array<double>")
    sums = (parts.select("dim", "i", F.posexplode("row").alias("j", "x")).where("j >= i")
            .groupBy("dim", "i", "j").agg(F.sum("x").alias("x")))
    out: dict[int, np.ndarray] = {}
    for r in sums.groupBy("dim", "i").agg(F.sort_array(F.collect_list(F.struct("j", "x"))).alias("row")).collect():
        m = out.setdefault(r.dim, np.zeros((r.dim, r.dim)))
        m[r.i, [c.j for c in r.row]] = [c.x for c in r.row]
    for dim, m in out.items():
        out[dim] = np.linalg.eigh(m + np.triu(m, 1).T)[1][:, ::-1].copy()
    return out


def _firsts(axes):
    """(first, lead): the first principal component, and the leading ones
    with the norm of the rest."""
    def run(batches):
        for b in batches:
            raw = b.column("vector").to_pylist()
            lead: list = [None] * len(raw)
            for dim in {len(v) // 8 for v in raw}:
                at = [i for i, v in enumerate(raw) if len(v) == 8 * dim]
                r = unit_rows(_matrix([raw[i] for i in at], dim))
                if dim in axes.value:
                    r = r @ axes.value[dim]
                k = min(STEPS[0], dim)
                rest = np.sqrt(np.maximum(np.einsum("ij,ij->i", r[:, k:], r[:, k:]), 0))
                box = np.zeros((len(at), STEPS[0] + 1))
                box[:, :k], box[:, -1] = r[:, :k], rest
                for i, row in zip(at, box):
                    lead[i] = row
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([len(v) // 8 for v in raw], pa.int32()),
                 pa.array([v[0] for v in lead], pa.float64()), pa.array(lead, pa.list_(pa.float64()))],
                [*b.schema.names, "dim", "first", "lead"])
    return run


# ---------------------------------------------------------------- tiles

def links(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float):
    """Yields (rows, columns, mask) of the links between the unit vectors
    ``a`` and ``b``: a mask over the named rows of ``a`` and columns of ``b``."""
    dim = a.shape[1]
    margin = 2e-7 * dim + 2e-6  # of single precision, in which bounds are taken
    ra, rb = (a, b) if axes is None else (a @ axes, b @ axes)
    steps = [k for k in STEPS if k < dim]
    rest = [[np.sqrt(np.maximum(1 - np.einsum("ij,ij->i", r[:, :k], r[:, :k]), 0)).astype(np.float32) for k in steps]
            for r in (ra, rb)]
    ra, rb = np.ascontiguousarray(ra, np.float32), np.ascontiguousarray(rb, np.float32)
    for lo in range(0, len(a), ROWS):
        for left in range(0, len(b), COLUMNS):
            rows, cols = np.arange(lo, min(lo + ROWS, len(a))), np.arange(left, min(left + COLUMNS, len(b)))
            done, product = 0, None
            for k, sa, sb in zip(steps, *rest):
                more = ra[rows, done:k] @ rb[cols, done:k].T
                product = more if product is None else product + more
                open_ = product + sa[rows][:, None] * sb[cols] >= threshold - margin
                keep_r, keep_c = open_.any(axis=1), open_.any(axis=0)
                if not keep_r.any():
                    break
                rows, cols = rows[keep_r], cols[keep_c]
                product, open_ = product[np.ix_(keep_r, keep_c)], open_[np.ix_(keep_r, keep_c)]
                done = k
                if open_.sum() * 16 < open_.size:  # few pairs: one by one from here
                    r, c = np.nonzero(open_)
                    held = np.einsum("ij,ij->i", a[rows[r]], b[cols[c]]) >= threshold
                    mask = np.zeros(open_.shape, bool)
                    mask[r[held], c[held]] = True
                    yield rows, cols, mask
                    break
            else:
                yield rows, cols, a[rows] @ b[cols].T >= threshold


def _forest(mask: np.ndarray, rows: np.ndarray, cols: np.ndarray, tree: np.ndarray):
    """The links of ``mask`` that join two trees; ``tree`` names the tree of
    every vector of the tile and is kept up to date."""
    for i in np.flatnonzero(mask.any(axis=1)):
        c = cols[mask[i]]
        mine, theirs = tree[rows[i]], tree[c]
        if (theirs == mine).all():
            continue
        names, at = np.unique(theirs, return_index=True)
        for j in c[at[names != mine]]:
            yield rows[i], j
        tree[np.isin(tree, names)] = mine


def _compare(axes, threshold: float):
    """One tile: (u, v, n) rows; the ``n`` links of the vector at position
    ``u`` where ``v`` is null, else a link of the forest between two ids."""
    def run(tile: pa.Table) -> pa.Table:
        i, j = tile["i"][0].as_py(), tile["j"][0].as_py()
        own = tile["own"].to_numpy()
        pos, rep, copies, dims = (tile[k].to_numpy() for k in ("pos", "rep", "copies", "dim"))
        raw = tile["vector"].to_pylist()
        count = np.zeros(len(rep), np.int64)
        us, vs, tree = [], [], np.arange(len(rep))
        for dim in np.unique(dims):
            left, right = (np.flatnonzero((own == k) & (dims == dim)) for k in (i, j))
            if not len(left) or not len(right):
                continue
            a = unit_rows(_matrix([raw[k] for k in left], dim))
            b = a if i == j else unit_rows(_matrix([raw[k] for k in right], dim))
            for r, c, mask in links(a, b, axes.value.get(int(dim)), threshold):
                if i == j:  # a vector with itself is counted with its copies
                    mask &= r[:, None] != c
                if not mask.any():
                    continue
                r, c = left[r], right[c]
                count[r] += mask @ copies[c]
                if i != j:
                    count[c] += copies[r] @ mask
                for x, y in _forest(mask, r, c, tree):
                    us.append(rep[x]), vs.append(rep[y])
        some = np.flatnonzero(count)
        return pa.table({"u": np.concatenate([pos[some], np.array(us, np.int64)]),
                         "v": pa.array([None] * len(some) + [int(v) for v in vs], pa.int64()),
                         "n": pa.array(count[some].tolist() + [None] * len(us), pa.int64())})
    return run


def _partners(boxes: np.ndarray, dims: np.ndarray, threshold: float):
    """(i, j): for each block i the blocks j >= i that can hold a link with
    it.  ``boxes`` has least and greatest leading components and suffix norms:
    unit vectors with a cosine of t are at a distance of sqrt(2 - 2 t), and
    suffix norms differ by no more than the distance of the suffixes."""
    low, high = boxes[:, 0], boxes[:, 1]

    def run(batches):
        for b in batches:
            for i in b.column(0).to_pylist():
                gap = np.maximum(0, np.maximum(low[i] - high[i:], low[i:] - high[i]))
                near = (gap ** 2).sum(axis=1) <= 2 - 2 * threshold + 1e-6
                near &= (dims[i:, 0] <= dims[i, 1]) & (dims[i:, 1] >= dims[i, 0])
                j = (i + np.flatnonzero(near)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(j), i, np.int32)), pa.array(j)], ["i", "j"])
    return run


def _tiles(placed: DataFrame, blocks: int, threshold: float) -> DataFrame:
    """(i, j): the pairs of blocks to compare.  A block holds up to
    BLOCK_BYTES, so the boxes, 160 bytes each, are few; the pairs stay on the
    cluster."""
    got = (placed.select("block", "dim", F.posexplode("lead").alias("k", "x")).groupBy("block", "k")
           .agg(F.min("x").alias("low"), F.max("x").alias("high"), F.min("dim").alias("d0"), F.max("dim").alias("d1")))
    boxes, dims = np.zeros((blocks, 2, STEPS[0] + 1)), np.zeros((blocks, 2))
    for r in got.toLocalIterator():
        boxes[r.block, :, r.k] = r.low, r.high
        dims[r.block] = r.d0, r.d1
    spark = placed.sparkSession
    ids = spark.range(0, blocks, 1, max(1, min(blocks, 200))).select(F.col("id").cast("int"))
    return materialize(ids.mapInArrow(_partners(boxes, dims, threshold), "i int, j int"), "tiles")


def groups(df: DataFrame, threshold: float = 0.95, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, n_links, component_id, kept) of every row: the other vectors that
    its vector is linked with, the smallest id that links reach, and whether
    that is its own.  ``threshold`` lies above 0."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold is above 0 and at most 1")
    src = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    packed = src.mapInArrow(trimmed(_pack), "id long, vector binary")
    packed = materialize(packed.select("id", "vector", F.sha2("vector", 256).alias("digest")), "vectors")
    valid = packed.where("vector is not null and id is not null")
    reps = materialize(valid.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("copies"),
                                                   F.first("vector").alias("vector")), "distinct-vectors")
    total, held = reps.agg(F.count("*"), F.coalesce(F.sum(F.length("vector")), F.lit(0))).first()
    alone = packed.where("vector is null or id is null").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    if total:
        linked = _linked(valid, reps, total, held, threshold)
        alone = attach_group(valid.select("id", "digest"), linked, "digest", "copies").select(
            "id", F.col("n").alias("n_links"), F.col("low").alias("component_id")).union(alone)
    return alone.select(F.col("id").alias(key), "n_links", "component_id",
                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _linked(valid: DataFrame, reps: DataFrame, total: int, held: int, threshold: float) -> DataFrame:
    """(digest, copies, n, low) of the distinct vectors."""
    axes = valid.sparkSession.sparkContext.broadcast(principal_axes(reps))
    size = max(LEAST_BLOCK, min(BLOCK_BYTES * total // held, -(-total // MIN_BLOCKS)))
    firsts = reps.select("digest", "rep", "copies", "vector").mapInArrow(
        trimmed(_firsts(axes)), "digest string, rep long, copies long, vector binary, dim int, first double, "
                                "lead array<double>")
    placed = (with_position(firsts, ("dim", "first", "digest"), name="vector-order")
              .withColumn("block", F.floor(F.col("pos") / size).cast("int")))
    tiles = _tiles(placed, -(-total // size), threshold)
    sent = tiles.select(F.explode(F.array_distinct(F.array("i", "j"))).alias("block"), "i", "j")
    found = (placed.select("block", "pos", "rep", "copies", "dim", "vector").join(sent, "block")
             .withColumnRenamed("block", "own").repartition(max(1, min(tiles.count(), 1 << 16)), "i", "j")
             .groupBy("i", "j").applyInArrow(_compare(axes, threshold), "u long, v long, n long"))
    found = materialize(found, "tile-links")
    # an id with several vectors is one node: it is linked with each of their ids
    several = valid.groupBy("id").agg(F.min("digest").alias("a"), F.max("digest").alias("z")).where("a != z").select("id")
    own = valid.join(several, "id", "left_semi").join(reps.select("digest", "rep"), "digest").select(
        F.col("rep").alias("u"), F.col("id").alias("v"))
    nodes = components(found.where("v is not null").select("u", "v").union(own), "vector-components")
    counts = found.where("v is null").groupBy(F.col("u").alias("pos")).agg(F.sum("n").alias("n"))
    return (placed.select("digest", "pos", "rep", "copies").join(counts, "pos", "left")
            .join(nodes.withColumnRenamed("node", "rep"), "rep", "left")
            .select("digest", "copies", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"),
                    F.coalesce("comp", "rep").alias("low")))
