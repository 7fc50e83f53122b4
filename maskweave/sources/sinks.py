"""Sinks and artefact handling."""

from __future__ import annotations

import json
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskweave.functions.text import flatten_newlines
from maskweave.session import scratch_path

log = logging.getLogger(__name__)


def write_corpus_lines(df: DataFrame, path: str | None = None, text: str = "text") -> str:
    """One document per line, newlines flattened to spaces.  Written in
    parallel (one file per partition); returns the folder."""
    path = path or scratch_path(df.sparkSession, "corpus-lines")
    df.select(flatten_newlines(text).alias("value")).write.mode("overwrite").option("lineSep", "\n").text(path)
    return path


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def prepare_output_dir(spark: SparkSession, path: str, overwrite: bool = False) -> None:
    """Overwrite -> delete; exists and non-empty -> error; exists and
    empty -> fine; parents created.  Uses the Hadoop file system of the
    path, so it works the same on shared storage."""
    p, fs = _fs(spark, path)
    if fs.exists(p):
        if overwrite:
            fs.delete(p, True)
        elif len(fs.listStatus(p)) > 0:
            raise FileExistsError(f"{path} is not empty (pass overwrite=True to empty it)")
    fs.mkdirs(p)


_MANIFEST = "manifest-"


def _versions(spark: SparkSession, out_dir: str) -> list[int]:
    p, fs = _fs(spark, out_dir)
    if not fs.exists(p):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    return sorted(int(n[len(_MANIFEST):]) for n in names if n.startswith(_MANIFEST) and n[len(_MANIFEST):].isdigit())


def vocab_dir(spark: SparkSession, out_dir: str) -> str:
    """The folder of the last committed version in ``out_dir``; ``out_dir``
    itself where none has been committed."""
    got = _versions(spark, out_dir)
    return f"{out_dir}/version-{got[-1]}" if got else out_dir


def write_vocab(vocab: DataFrame, out_dir: str, merges: DataFrame | None = None,
                special_tokens: dict[str, str] | None = None) -> str:
    """The vocabulary as Parquet plus a two-column text file
    (piece TAB score, in id order), the merges as Parquet, and the
    special-token map as one JSON row.  V is bounded by the vocabulary
    size, so the single text file is small.

    All of it goes into a folder of its own, which a manifest names once
    everything is written; the manifest appears by a rename.  A write that
    stops before leaves the version before it to be read.  Returns the folder."""
    spark = vocab.sparkSession
    n = max(_versions(spark, out_dir), default=0) + 1
    path = f"{out_dir}/version-{n}"
    vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    (vocab.orderBy("id")
          .select(F.concat_ws("\t", "piece", F.coalesce(F.col("score").cast("string"), F.lit("0")))
                  .alias("value"))
          .coalesce(1).write.mode("overwrite").text(f"{path}/vocab_text"))
    if merges is not None:
        merges.write.mode("overwrite").parquet(f"{path}/merges")
    if special_tokens:
        spark.createDataFrame([special_tokens]).coalesce(1).write.mode("overwrite").json(
            f"{path}/special_tokens")
    _commit(spark, out_dir, n)
    return path


def _commit(spark: SparkSession, out_dir: str, n: int) -> None:
    held, fs = _fs(spark, f"{out_dir}/_{_MANIFEST}{n}")
    fs.create(held, True).close()
    if not fs.rename(held, _fs(spark, f"{out_dir}/{_MANIFEST}{n}")[0]):
        raise FileExistsError(f"version {n} of {out_dir} was committed by another writer")


def read_vocab(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(f"{vocab_dir(spark, out_dir)}/vocab")


def read_merges(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(f"{vocab_dir(spark, out_dir)}/merges")


def read_corpus_lines(spark: SparkSession, path: str) -> DataFrame:
    """A6 read back: only the line feed ends a line, a document's carriage
    returns stay in it."""
    return spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("line"))


def read_vocab_text(spark: SparkSession, out_dir: str) -> DataFrame:
    """(piece, score) from the text form."""
    parts = F.split(F.col("line"), "\t")
    return read_corpus_lines(spark, f"{vocab_dir(spark, out_dir)}/vocab_text").select(
        parts[0].alias("piece"), parts[1].cast("double").alias("score"))


def read_special_tokens(spark: SparkSession, out_dir: str) -> dict[str, str]:
    """The special-token map from its JSON form."""
    return json.loads(spark.read.text(f"{vocab_dir(spark, out_dir)}/special_tokens").first()[0])


def load_vocab(spark: SparkSession, path: str | None, default: DataFrame) -> tuple[DataFrame, bool]:
    """A10: the vocabulary saved at ``path`` if it loads and has the columns
    of one, else ``default``.  Whatever reading raises is logged.  Returns
    (vocab, loaded_custom)."""
    if path:
        try:
            v = read_vocab(spark, path)
            missing = {"id", "piece", "score", "role"} - set(v.columns)
            if missing:
                raise ValueError(f"no column {sorted(missing)}")
            v.agg(F.max("id"), F.max("piece")).collect()  # reads every file: a corrupt one fails here
            return v, True
        except Exception as exc:  # noqa: BLE001 - any fault means the default (A10)
            log.warning("vocabulary at %s does not load, using the default: %s", path, str(exc)[:200])
    return default, False


def log_metrics(metrics: DataFrame, path: str, once: bool = False) -> None:
    """Append (run, step, name, value) rows.  With ``once`` a run logs a
    name once a step: rows that are there already, and repeats, add nothing,
    so a log that is replayed after a failure stays as it was."""
    rows = metrics.select("run", F.col("step").cast("bigint").alias("step"), "name",
                          F.col("value").cast("double").alias("value"))
    if once:
        keys = ["run", "step", "name"]
        rows = rows.groupBy(*keys).agg(F.min("value").alias("value"))
        p, fs = _fs(metrics.sparkSession, path)
        if fs.exists(p):
            rows = rows.join(metrics.sparkSession.read.parquet(path), keys, "left_anti")
    rows.write.mode("append").parquet(path)
