"""Batch scoring and evaluation aggregates (H1-H4).

The built-in score is SQL: the mean negative log corpus frequency of the
original token at masked positions.  It explodes only masked labels,
joins the frequency table (bounded by the vocabulary size, which the
encoder checked; broadcast) and aggregates partially before the shuffle on the batch key.  A user
score function runs per batch, many batches to a Python call; a batch holds
at most ``batch`` rows.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskweave.operators.collate import IGNORE

BATCH_KEYS = ["epoch", "phase", "split", "micro_step"]
ROW_MARK = -1   # never a token id


def token_logp(encoded: DataFrame, ids: str = "input_ids") -> DataFrame:
    """(id, nll): -ln of each id's share of all corpus tokens."""
    counts = encoded.select(F.explode(ids).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("c"))
    total = counts.agg(F.sum("c").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(
        "id", (-F.log(F.col("c") / F.col("total"))).alias("nll"))


def score_batches(masked: DataFrame, nll: DataFrame, keys: list[str] = BATCH_KEYS,
                  failed=None) -> DataFrame:
    """H1/H2: (keys, n_rows, n_masked, loss, error).  A batch with no
    masked token, or one the ``failed`` rule marks, has a null loss and
    an error text; callers skip those (H2)."""
    # one pass: a sentinel element per row counts rows; the rest are the
    # masked labels (partial aggregation before the shuffle on the keys)
    marked = F.concat(F.array(F.lit(ROW_MARK).cast("bigint")), F.array_remove("labels", IGNORE))
    toks = (masked.select(*keys, F.explode(marked).alias("id"))
                  .join(F.broadcast(nll), "id", "left")
                  .groupBy(*keys).agg(F.count_if(F.col("id") == ROW_MARK).alias("n_rows"),
                                      F.count_if(F.col("id") != ROW_MARK).alias("n_masked"),
                                      F.avg("nll").alias("_loss")))
    out = toks
    bad = failed(F.col("phase"), F.col("micro_step")) if failed else F.lit(False)
    err = F.when(bad, F.lit("injected failure")).when(F.col("n_masked") == 0, F.lit("no masked tokens"))
    return (out.withColumn("error", err)
               .withColumn("loss", F.when(F.col("error").isNull(), F.col("_loss")))
               .drop("_loss"))


def score_with(masked: DataFrame, fn, keys: list[str] = BATCH_KEYS, per_call: int = 256) -> DataFrame:
    """H1 user surface: ``fn(pandas batch) -> float`` per batch.  An
    exception becomes (loss null, error text) instead of failing the job;
    a None loss is an error too.  One Python call takes ``per_call``
    consecutive micro-steps of a phase and split."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in masked.schema.fields if f.name in keys)
    schema += ", loss double, error string"

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        head = {k: [pdf[k].iloc[0]] for k in keys}
        try:
            loss = fn(pdf)
            if loss is None:
                raise ValueError("the score function gave None")
            return pd.DataFrame({**head, "loss": [float(loss)], "error": [None]})
        except Exception as exc:  # noqa: BLE001 - reported per batch (H2)
            return pd.DataFrame({**head, "loss": [None], "error": [f"{type(exc).__name__}: {exc}"]})

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([score(batch) for _, batch in pdf.groupby(keys, sort=False)])

    lead = [k for k in keys if k != "micro_step"]
    call = F.floor(F.col("micro_step") / per_call)
    return masked.withColumn("_call", call).groupBy(*lead, "_call").applyInPandas(run, schema)


def eval_mean(scores: DataFrame, by: list[str] = ("epoch", "phase")) -> DataFrame:
    """H3: unweighted mean of successful eval batch losses; +inf when
    there is none (Q8: a short last batch weighs the same)."""
    ev = scores.filter(F.col("split") == "eval")
    return ev.groupBy(*by).agg(*_mean_cols())


def _mean_cols() -> list[Column]:
    return [F.count(F.lit(1)).cast("bigint").alias("n_batches"),
            F.count_if(F.col("error").isNotNull()).cast("bigint").alias("n_failed"),
            F.coalesce(F.avg("loss"), F.lit(math.inf)).alias("mean_loss")]


def overall_mean(scores: DataFrame) -> DataFrame:
    """H3 without grouping: exactly one row, +inf on no rows."""
    return scores.agg(*_mean_cols())


def train_loss_log(scores: DataFrame, steps: DataFrame) -> DataFrame:
    """H4: at each optimizer step, the loss of the micro-batch that
    completed it."""
    st = steps.filter("stepped").select("epoch", "phase", "micro_step", "global_step")
    tr = scores.filter(F.col("split") == "train").select("epoch", "phase", "micro_step", "loss")
    return st.join(tr, ["epoch", "phase", "micro_step"]).select("global_step", "loss")
