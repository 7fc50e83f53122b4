"""Collation and masking.

Masking is an Arrow UDF over the rows' id lists: one md5 per row seeds the
three draws of every token (select, action, random id), which are integer
arithmetic on its position, in numpy over slices of many rows; so there is no
explode and no shuffle, and the rows keep their partitions.  Padding needs the batch's longest row: a window over the
batch key, which rides on the shuffle's partitioning when batches never
straddle shuffle blocks (buffer a multiple of the batch size).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskweave.operators.encode import flat_ids, id_slices

IGNORE = -100
MASK_SHARE = 0.8     # selected tokens replaced by [MASK]
RANDOM_CUT = 0.9    # draws in [0.8, 0.9) take a random id; the rest stay


STEP = 1630279
CHUNK = 1 << 17      # tokens that are drawn at a time
PRIME = 2147483647   # draws are whole numbers below it


def turn(x):
    """A one-to-one map of 0..PRIME-1 (fifth power, then a line), whose
    products fit in 64 bits; the same formula in SQL and numpy."""
    y = x * x % PRIME
    y = y * y % PRIME
    return (y * x % PRIME * 48271 + 11) % PRIME


def cut(share):
    """Draws below it make up ``share`` of all."""
    return F.ceil(share * F.lit(float(PRIME))).cast("bigint")


def draw_prefix(seed: int, keys: list[str]) -> Column:
    return F.concat_ws(":", F.lit(str(seed)), F.lit("mlm"), *[F.col(k).cast("string") for k in keys])


def mlm_mask(df: DataFrame, specials: list[int], mask_id: int, vocab_size: int, seed: int = 42,
             p: str = "p", keys: tuple[str, ...] = ("epoch", "phase", "split", "doc_id")) -> DataFrame:
    """Select non-special tokens with probability ``p`` (per-row
    column, so it follows the phase); of those 80 % become [MASK], 10 %
    a random id in [0, |V|), 10 % stay.  ``labels`` keep the original id
    where selected, else -100.  The special-token mask is recomputed from
    the vocabulary roles (G1)."""
    h = F.md5(draw_prefix(seed, list(keys)))
    seeds = [F.conv(F.substring(h, 1 + 7 * k, 7), 16, 10).cast("bigint") * 8 for k in range(3)]  # 28 bits each
    draw = _masker(specials, mask_id, vocab_size)
    out = df.withColumn("_masked", draw("input_ids", cut(F.col(p)), *seeds))
    return (out.withColumn("labels", F.col("_masked.labels"))
               .withColumn("input_ids", F.col("_masked.input_ids"))
               .withColumn("attention_mask", F.array_repeat(F.lit(1).cast("bigint"), F.size("input_ids")))
               .drop("_masked"))


def _places(at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, place in the flat ids), CHUNK places at a time: a long row is no
    larger step than many short ones."""
    for lo in range(int(at[0]), int(at[-1]), CHUNK):
        hi = min(lo + CHUNK, int(at[-1]))
        first, last = np.searchsorted(at, lo, "right") - 1, np.searchsorted(at, hi, "left")
        sizes = np.diff(np.clip(at[first:last + 1], lo, hi))
        yield np.repeat(np.arange(first, last), sizes), np.arange(lo, hi)


def _masker(specials: list[int], mask_id: int, vocab_size: int):
    act_cuts = [math.ceil(share * float(PRIME)) for share in (MASK_SHARE, RANDOM_CUT)]

    @F.arrow_udf("input_ids array<bigint>, labels array<bigint>")
    def draw(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ids, *rest in id_slices(batches, lambda b: b[0]):
            below, s0, s1, s2 = (x.to_numpy(zero_copy_only=False) for x in rest)
            at, old = flat_ids(ids)
            new, labels = old.copy(), np.full(len(old), IGNORE, np.int64)
            for row, place in _places(at):
                z = turn((s0[row] + (place - at[row] + 1) * STEP) % PRIME)
                hit = np.flatnonzero(z < below[row])
                t = old[place[hit]]
                kept = ~np.isin(t, specials)
                hit, t = hit[kept], t[kept]
                row, place, z = row[hit], place[hit], z[hit]
                act = turn((z + s1[row]) % PRIME)
                other = turn((act + s2[row]) % PRIME) * vocab_size // PRIME
                labels[place] = t
                new[place] = np.where(act < act_cuts[0], mask_id, np.where(act < act_cuts[1], other, t))
            lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x), mask=ids.is_null()) for x in (new, labels)]
            yield pa.StructArray.from_arrays(lists, ["input_ids", "labels"])

    return draw


def with_longest(df: DataFrame, batch_keys: list[str], length: Column | None = None) -> DataFrame:
    """Adds ``_max``, the ids of the longest row of the batch: masking does
    not change it, so it may be taken where the rows lie by batch.  Rows
    without their ids bring their ``length``."""
    length = F.size("input_ids") if length is None else length
    return df.withColumn("_max", F.max(length).over(Window.partitionBy(*batch_keys)))


def pad_batches(df: DataFrame, pad_id: int, batch_keys: list[str]) -> DataFrame:
    """Pad ids with [PAD], the attention mask and token types with 0 and
    labels with -100 up to the longest row of the batch."""
    b = (df if "_max" in df.columns else with_longest(df, batch_keys)).withColumn("_len", F.size("input_ids"))
    gap = (F.col("_max") - F.col("_len")).cast("int")

    def pad(c, v):
        return F.concat(F.col(c), F.array_repeat(F.lit(v).cast("bigint"), gap))

    out = b.withColumn("input_ids", pad("input_ids", pad_id)) \
           .withColumn("attention_mask", pad("attention_mask", 0))
    for column, filler in (("labels", IGNORE), ("token_type_ids", 0)):
        if column in df.columns:
            out = out.withColumn(column, pad(column, filler))
    return out.drop("_len", "_max")


def shape_batch(df: DataFrame, columns: tuple[str, ...] = ("input_ids", "attention_mask", "token_type_ids")) -> DataFrame:
    """G4/G5 over a batch: every nested column of ``columns`` that is there
    becomes a list of 64-bit integers."""
    for c in columns:
        if c in df.columns:
            df = df.withColumn(c, as_int64(squeeze_leading(F.col(c), c)))
    return df


def squeeze_leading(nested: Column, name: str = "input_ids") -> Column:
    """A [1, n] value becomes [n]; any other leading size is an error
    (the reference rejects rank > 2 unless the leading dimension is 1)."""
    return F.when(F.size(nested) == 1, F.element_at(nested, 1)).otherwise(
        F.raise_error(F.concat(F.lit(f"{name}: one inner list expected, found "),
                               F.size(nested).cast("string"))))


def as_int64(c: str | Column) -> Column:
    """Ids as 64-bit integers."""
    return (F.col(c) if isinstance(c, str) else c).cast("array<bigint>")
