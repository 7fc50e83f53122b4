"""Streaming forms (K1, K2): the reference's corpus source is a lazy
stream, so the stateless encode and the word counts also run as
Structured Streaming queries.

Sinks are files on shared storage and checkpoints live under the shared
checkpoint folder, so a restarted query resumes exactly once.  Nothing
is collected into the driver (no memory sink).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskweave.operators import encode as EN
from maskweave.operators import words as WD
from maskweave.operators.position import first_rows
from maskweave.session import scratch_path
from maskweave.sources import corpus as C
from maskweave.sources import sinks as S


def stream_table(spark: SparkSession, sf_dir: str, name: str = "documents",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A1 streaming form: a Parquet stream over the table's files.  The
    source needs a directory: a table of many files is one, a table that is a
    single file is picked from its directory with a glob filter."""
    schema = C.read_table(spark, sf_dir, name).schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    path, fs = S._fs(spark, C.table_path(sf_dir, name))
    if fs.exists(path) and fs.getFileStatus(path).isDirectory():
        return r.parquet(C.table_path(sf_dir, name))
    return r.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _run(writer, until_done: bool = True):
    q = writer.trigger(availableNow=True).start() if until_done else writer.start()
    if until_done:
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    return q


def stream_encode(stream: DataFrame, vocab: DataFrame, kind: str = "wordpiece", text_mode: str = "key",
                  sink: str | None = None, checkpoint: str | None = None, merges: DataFrame | None = None,
                  key: str = "doc_id", limit: int | None = None) -> str:
    """K1: stream -> text choice -> encode -> Parquet.  Returns the sink.

    With ``limit`` the stream ends after so many rows: how many came before a
    micro-batch is counted in the sink, so a query that starts again in the
    middle, or replays a batch, ends with the same rows.  The batch that
    reaches the limit gives its first rows by ``key``; those after it are not
    read.

    Each micro-batch is encoded as a batch DataFrame and written with an
    idempotent overwrite into ``batch_id=<n>``: a replayed batch after a
    failure replaces its own output, so the sink stays exactly-once."""
    spark = stream.sparkSession
    sink = sink or scratch_path(spark, "stream-encode")
    checkpoint = checkpoint or scratch_path(spark, "stream-encode-ckpt")
    model = EN.token_model(vocab, kind, merges)   # collected once, broadcast per batch
    specials = EN.special_ids(vocab)
    text = C.resolve_text(stream, text_mode, keys=(key,))

    def publish(batch: DataFrame, batch_id: int) -> None:
        if limit:
            left = limit - _rows_before(spark, sink, batch_id)
            if left <= 0:
                return
            batch = first_rows(batch, left, key)
        words = batch.select(key, F.col("text").alias("_text"))
        enc = EN.with_masks(EN.encode_words(words, "_text", model, [key]), specials)
        enc.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    _run(text.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint))
    return sink


def _folders(spark: SparkSession, sink: str, name: str) -> dict[int, str]:
    """The folders ``name=<n>`` of a sink that were written whole."""
    p, fs = S._fs(spark, sink)
    if not fs.exists(p):
        return {}
    paths = [f.getPath().toString() for f in fs.listStatus(p)]
    found = {int(x.rsplit("=", 1)[1]): x for x in paths if x.rsplit("/", 1)[1].startswith(f"{name}=")}
    return {n: x for n, x in found.items() if fs.exists(S._fs(spark, f"{x}/_SUCCESS")[0])}


def _rows_before(spark: SparkSession, sink: str, batch_id: int) -> int:
    paths = [x for n, x in _folders(spark, sink, "batch_id").items() if n < batch_id]
    return spark.read.parquet(*paths).count() if paths else 0


def stream_word_counts(stream: DataFrame, text_mode: str = "key", sink: str | None = None,
                       checkpoint: str | None = None) -> str:
    """K2: running word counts (state in the distributed state store).  Each
    trigger writes the words it changed into ``epoch=<n>``; a replayed epoch
    replaces its own output, and earlier epochs stay readable meanwhile.
    ``read_word_counts`` merges them."""
    spark = stream.sparkSession
    sink = sink or scratch_path(spark, "stream-words")
    checkpoint = checkpoint or scratch_path(spark, "stream-words-ckpt")
    counts = WD.wordpiece_words(C.resolve_text(stream, text_mode))

    def publish(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")

    _run(counts.writeStream.outputMode("update").foreachBatch(publish)
               .option("checkpointLocation", checkpoint))
    return sink


def compact_word_counts(spark: SparkSession, sink: str) -> int:
    """K2: merges the epochs so far into one folder beside the sink and
    deletes them; returns the last of them.  Readers take the last folder that
    was written whole and the epochs after it, so a merge that stops half-way
    changes nothing, and a second merge of the same epochs neither."""
    epochs, whole = _folders(spark, sink, "epoch"), _folders(spark, f"{sink}-merged", "upto")
    last = max([*epochs, *whole], default=-1)
    if last >= 0 and last not in whole:
        read_word_counts(spark, sink).withColumn("epoch", F.lit(last).cast("bigint")) \
            .write.mode("overwrite").parquet(f"{sink}-merged/upto={last}")
    for n, path in [*epochs.items(), *whole.items()]:
        if n < last or path in epochs.values():
            p, fs = S._fs(spark, path)
            fs.delete(p, True)
    return last


def read_word_counts(spark: SparkSession, sink: str) -> DataFrame:
    """K2 read: the latest count of every word."""
    whole = _folders(spark, f"{sink}-merged", "upto")
    upto = max(whole, default=-1)
    parts = [spark.read.parquet(whole[upto]).select("word", "n", "epoch")] if whole else []
    later = {n: x for n, x in _folders(spark, sink, "epoch").items() if n > upto}
    parts += [spark.read.parquet(x).select("word", "n", F.lit(n).cast("bigint").alias("epoch")) for n, x in later.items()]
    if not parts:
        return spark.createDataFrame([], "word string, n bigint")
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.union(more)
    return rows.groupBy("word").agg(F.max_by("n", "epoch").alias("n"))
