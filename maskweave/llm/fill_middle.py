"""Fill-in-middle transformation as a pipeline of Arrow kernels.

A text is cut into units that end with a separator (lines by default; what
follows the last separator is a unit too).  Two draws choose the cuts between
units; prefix, middle and suffix are then arranged with sentinels as
``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle), or the
text stays ``plain``.  The draws are the first four 8-digit groups of the
SHA-256 of ``seed:key``, computed in the JVM, so a row is cut in the same way
wherever and whenever its task runs.

Each slice of a batch goes through the same kernels, no row by itself: split
to list arrays, flatten with parent indices, ordinals within the parent,
filter by role, rebuild one list per text and role, join the pieces.  Nothing
is shuffled; a task holds a slice of at most 1 MB of text, or one longer text.

Defined results: a null text counts as empty; an empty text, and one that
contains a sentinel, stays plain; a null key draws like the empty string;
repeated rows are cut alike, each stays a row; an empty table gives no rows.
Other columns of the input are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskweave.llm.common import slices, text_bytes, trimmed

#: Sentinels of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
FORMS = ("plain", "psm", "spm")
_WIDE = pa.large_string()


def _text(value: str) -> pa.Scalar:
    return pa.scalar(value, _WIDE)


def units(texts: pa.Array, separator: str):
    """(unit, parent, ordinal, n): all units of the texts one after another,
    the text that each belongs to, its place there, and units per text."""
    lists = pc.split_pattern(texts, separator)
    flat = pc.list_flatten(lists)
    parent = pc.list_parent_indices(lists).to_numpy()
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    ordinal = np.arange(len(parent)) - (np.cumsum(size) - size)[parent]
    ends = pa.array(ordinal < size[parent] - 1)  # the separator belongs to the unit that it ends
    unit = pc.binary_join_element_wise(flat, pc.if_else(ends, _text(separator), _text("")), _text(""))
    some = pc.not_equal(pc.binary_length(unit), 0)
    keep = some.to_numpy(zero_copy_only=False)
    parent, ordinal = parent[keep], ordinal[keep]
    return pc.filter(unit, some), parent, ordinal, np.bincount(parent, minlength=len(texts))


def pieces(unit: pa.Array, parent: np.ndarray, role: np.ndarray, count: int) -> list[pa.Array]:
    """For each of the roles 0 to 2, the units of that role of each text, joined."""
    out = []
    for r in range(3):
        mine = role == r
        ends = np.cumsum(np.bincount(parent[mine], minlength=count))
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pc.filter(unit, pa.array(mine)))
        out.append(pc.binary_join(lists, _text("")))
    return out


def _join(*parts) -> pa.Array:
    return pc.binary_join_element_wise(*[_text(p) if isinstance(p, str) else p for p in parts], _text(""))


def arrange(texts: pa.Array, draws: list[np.ndarray], separator: str, rate: int, spm: int, sentinels) -> dict:
    """The columns of one slice; ``draws`` are four numbers per text."""
    p, s, m = sentinels
    unit, parent, ordinal, n = units(texts, separator)
    one, two = draws[0] % (n + 1), draws[1] % (n + 1)
    role = (ordinal >= np.minimum(one, two)[parent]).astype(np.int8) + (ordinal >= np.maximum(one, two)[parent])
    prefix, middle, suffix = pieces(unit, parent, role, len(texts))
    plain = (n == 0) | (draws[2] % 100 >= rate)
    for sentinel in sentinels:
        plain |= pc.match_substring(texts, sentinel).to_numpy(zero_copy_only=False)
    form = np.where(plain, 0, np.where(draws[3] % 100 < spm, 2, 1))
    output = pc.choose(pa.array(form), texts, _join(p, prefix, s, suffix, m, middle),
                       _join(s, suffix, p, prefix, m, middle))
    length = lambda a: pc.if_else(pa.array(plain), pa.scalar(None, pa.int64()), pc.cast(pc.utf8_length(a), pa.int64()))
    return {"n": pa.array(n.astype(np.int64)), "form": pc.take(pa.array(FORMS), pa.array(form)),
            "prefix_chars": length(prefix), "middle_chars": length(middle), "output": output.cast(pa.string())}


def original(output: pa.Array, form: pa.Array, sentinels=SENTINELS) -> pa.Array:
    """The texts again, from outputs and forms alone."""
    p, s, m = sentinels
    out = output
    for name, first, second in (("psm", p, s), ("spm", s, p)):
        mine = pc.equal(form, name)
        body = pc.utf8_slice_codeunits(pc.filter(output, mine), len(first))
        if not len(body):
            continue
        halves = pc.split_pattern(body, second, max_splits=1)
        rest = pc.split_pattern(pc.list_element(halves, 1), m, max_splits=1)
        a, b, middle = pc.list_element(halves, 0), pc.list_element(rest, 0), pc.list_element(rest, 1)
        prefix, suffix = (a, b) if name == "psm" else (b, a)
        out = pc.replace_with_mask(out, mine, _join(prefix, middle, suffix))
    return out


def _check(sentinels) -> tuple[str, str, str]:
    """A sentinel's first character may stand nowhere else in a sentinel:
    then none can begin inside another or across the end of a piece."""
    if len(set(sentinels)) != 3 or not all(sentinels):
        raise ValueError("three different sentinels that are not empty are needed")
    if any(a[0] in b[1:] for a in sentinels for b in sentinels):
        raise ValueError("a sentinel holds the first character of a sentinel")
    return tuple(sentinels)


def transform(df: DataFrame, key: str = "doc_id", text: str = "text", separator: str = "\n", rate: int = 100,
              spm: int = 50, seed: int = 7, sentinels=SENTINELS) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) of each row: units,
    plain / psm / spm, code points of prefix and middle (null if plain) and
    the arranged text.  ``rate`` percent of the texts are arranged, ``spm``
    percent of these suffix first."""
    sentinels = _check(sentinels)
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i}") for i in range(4)]
    src = df.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), *draws)

    def run(batches):
        for b in batches:
            off, _ = text_bytes(b.column(1))
            for lo, hi in slices(off):
                part = b.slice(lo, hi - lo)
                got = arrange(part.column(1).cast(_WIDE), [part.column(i).to_numpy() for i in range(2, 6)],
                              separator, rate, spm, sentinels)
                yield pa.RecordBatch.from_arrays([part.column(0), *got.values()], ["key", *got])

    kind = src.schema["key"].dataType.simpleString()
    return src.mapInArrow(
        trimmed(run), f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    ).withColumnRenamed("key", key)


def restore(df: DataFrame, output: str = "output", form: str = "form", sentinels=SENTINELS) -> DataFrame:
    """``df`` with the column ``restored``: the exact text, rebuilt from the
    arranged text and its form."""
    sentinels = _check(sentinels)
    names = df.columns

    def run(batches):
        for b in batches:
            out = b.column(names.index(output))
            off, _ = text_bytes(out)
            for lo, hi in slices(off):
                part = b.slice(lo, hi - lo)
                got = original(part.column(names.index(output)).cast(_WIDE), part.column(names.index(form)), sentinels)
                yield pa.RecordBatch.from_arrays([*part.columns, got.cast(pa.string())], [*names, "restored"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(trimmed(run), f"{fields}, restored string")
