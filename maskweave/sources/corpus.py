"""Corpus sources (A1) and the three text-choice modes (A2-A5, B1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_MODES = ("schema", "key", "truthy")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def read_corpus(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A1: the corpus as a lazy DataFrame (Parquet scan; filters and
    projections applied later are pushed into it).  Its partitions are the
    scan's; ``spark.sql.files.maxPartitionBytes`` sizes them.  A caller on a
    few small files with many cores may ask for more partitions with the
    setting ``maskweave.sourcePartitions``."""
    df = read_table(spark, sf_dir, name)
    want = spark.conf.get("maskweave.sourcePartitions", None)
    return df.repartition(int(want)) if want else df


def text_column(df: DataFrame, mode: str = "schema", strict: bool = True) -> Column:
    """The text expression chosen by ``mode`` (see README, text modes).

    ``schema``: the ``text`` column if the frame has one, else ``content``.
    ``key``:    ``text`` if present (even when empty), else ``content``,
                else the empty string; rows are dropped later by B1.
    ``truthy``: first non-empty of ``text`` and ``content``; with
                ``strict`` a row with neither raises an error at run time,
                otherwise its text is null.
    """
    cols = set(df.columns)
    if mode == "schema":
        return F.col("text") if "text" in cols else F.col("content")
    if mode == "key":
        if "text" in cols:
            return F.col("text")
        if "content" in cols:
            return F.col("content")
        return F.lit("")
    if mode == "truthy":
        options = [F.nullif(F.col(c), F.lit("")) for c in ("text", "content") if c in cols]
        if strict:
            options.append(F.raise_error(F.lit("row without a value in 'text' and in 'content'")))
        return F.coalesce(*options, F.lit(None).cast("string"))
    raise ValueError(f"unknown text mode {mode!r}; expected one of {TEXT_MODES}")


def nonempty(df: DataFrame, c: str = "text") -> DataFrame:
    """B1: drop null or empty text (pushed to the Parquet scan as
    IsNotNull / Not(EqualTo))."""
    return df.filter(F.col(c).isNotNull() & (F.col(c) != F.lit("")))


def resolve_text(df: DataFrame, mode: str = "schema", keys: tuple[str, ...] = ("doc_id",),
                 strict: bool = True) -> DataFrame:
    """A2-A5: keep the order keys and one ``text`` column; every other
    source column is removed (column pruning reaches the scan).  Mode
    ``key`` also applies B1, as the reference's generator does."""
    out = df.select(*keys, text_column(df, mode, strict).alias("text"))
    if mode == "key":
        out = nonempty(out)
    return out


def training_corpus(df: DataFrame, limit: int | None = None, batch_size: int = 1000,
                    key: str = "doc_id") -> DataFrame:
    """Text by ``key`` mode, empties dropped (B1), the first ``limit``
    non-empty rows (B2), grouped into lists of ``batch_size`` (B5).
    Returns (batch_id, text array) in stream order."""
    from maskweave.operators import position as P

    rows = resolve_text(df, "key", keys=(key,))
    if limit:
        rows = P.first_rows(rows, limit, key)
    pos = P.with_position(rows.select(key), order=(key,), name="keys")  # the text is not sorted
    return P.batch_lists(rows.join(pos, key), batch_size, "text")
