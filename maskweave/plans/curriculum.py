"""Curriculum slicing, shuffle, micro-batches, optimizer steps and the
schedule tables (F2-F9, A11).

Slices are arithmetic on the global position: phase i's eval slice is
[iC, iC+E) and its train slice [iC+E, iC+E+C) (with ``overlap``, into
the next eval slice, Q1) or [iC+E, (i+1)C) (without).  A row
finds its phase by division, then joins the phase table (one row per phase
and split, broadcast) by key: O(N), no range join, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from maskweave.functions.draws import bits_from_hex, hash_key
from maskweave.operators.position import running_sum, with_position
from maskweave.plans.config import Curriculum, numbers
from maskweave.session import scratch_path

SPLITS = ("train", "eval")


def phase_table(spark: SparkSession, cfg: Curriculum, n_rows: int) -> DataFrame:
    """F2 + plan bounds: one row per (epoch, phase, split)."""
    c, e, p = numbers(cfg, n_rows).chunk, cfg.eval_rows, len(cfg.shares)
    rows = []
    for epoch in range(cfg.epochs):
        for i, prob in enumerate(cfg.shares):
            t_hi = i * c + e + c if cfg.overlap else (i + 1) * c
            rows.append((epoch, i, float(prob), epoch * p + i, "train", i * c + e, t_hi))
            rows.append((epoch, i, float(prob), epoch * p + i, "eval", i * c, i * c + e))
    return spark.createDataFrame(
        rows, "epoch int, phase int, p double, run_index int, split string, lo bigint, hi bigint")


def slices(positioned: DataFrame, cfg: Curriculum, n_rows: int, pos: str = "pos") -> DataFrame:
    """rows of each phase's train and eval slice, with
    ``phase_rank`` = position inside the slice."""
    c, e, p = numbers(cfg, n_rows).chunk, cfg.eval_rows, len(cfg.shares)
    x = F.col(pos)
    if cfg.overlap:
        ti = F.floor((x - e) / c)
        t_ok = (x >= e) & (ti < p)
    else:
        ti = F.floor(x / c)
        t_ok = (x - ti * c >= e) & (ti < p)
    ei = F.floor(x / c)
    e_ok = (x - ei * c < e) & (ei < p)
    cands = F.array(
        F.when(t_ok, F.struct(F.lit("train").alias("split"), ti.cast("int").alias("phase"))),
        F.when(e_ok, F.struct(F.lit("eval").alias("split"), ei.cast("int").alias("phase"))))
    hits = (positioned.withColumn("_c", F.explode(F.filter(cands, lambda s: s.isNotNull())))
                      .withColumn("split", F.col("_c.split")).withColumn("phase", F.col("_c.phase"))
                      .drop("_c"))
    ph = phase_table(positioned.sparkSession, cfg._replace(epochs=1), n_rows).drop("epoch", "run_index")
    return (hits.join(F.broadcast(ph), ["phase", "split"])
                .withColumn("phase_rank", F.col(pos) - F.col("lo"))
                .drop("lo", "hi"))


def clustered(positioned: DataFrame, pos: str = "pos", name: str = "clustered", block_bytes: int | None = None) -> DataFrame:
    """``positioned`` written in order of position: range-partitioned and
    sorted, so that files and row groups hold ranges of positions."""
    path = scratch_path(positioned.sparkSession, name)
    w = positioned.repartitionByRange(pos).sortWithinPartitions(pos).write.option("compression", "zstd")
    if block_bytes:
        w = w.option("parquet.block.size", block_bytes)
    w.parquet(path)
    return positioned.sparkSession.read.parquet(path)


def phase_slice(positioned: DataFrame, cfg: Curriculum, n_rows: int, phase: int, split: str, pos: str = "pos") -> DataFrame:
    """F3/F4 of one phase: its range of positions as a filter, which on a
    ``clustered`` table leaves out the files and row groups of other phases."""
    c, e = numbers(cfg, n_rows).chunk, cfg.eval_rows
    if split not in SPLITS or not 0 <= phase < len(cfg.shares):
        raise ValueError(f"no {split!r} slice of phase {phase}")
    lo = phase * c + (e if split == "train" else 0)
    hi = phase * c + e if split == "eval" else lo + c if cfg.overlap else (phase + 1) * c
    return positioned.where((F.col(pos) >= lo) & (F.col(pos) < hi)).withColumn("phase_rank", F.col(pos) - lo)


def with_epochs(df: DataFrame, cfg: Curriculum) -> DataFrame:
    """Every row once per epoch, with ``epoch`` and ``run_index``.  Epochs
    share slices and order (Q5), so they are added after the shuffle."""
    p = len(cfg.shares)
    epochs = F.array(*[F.lit(k) for k in range(cfg.epochs)])
    return (df.withColumn("epoch", F.explode(epochs))
              .withColumn("run_index", F.col("epoch") * p + F.col("phase")))


def shuffle_draw(cfg: Curriculum, key: str = "doc_id") -> Column:
    """Q5: the draw depends on seed, phase and row, not on the epoch."""
    return bits_from_hex(hash_key(cfg.seed, "shuffle", F.col("phase"), F.col(key)))


MODES = ("block", "global")


def shuffled(sl: DataFrame, cfg: Curriculum, key: str = "doc_id", mode: str = "block") -> DataFrame:
    """seeded shuffle of train slices; eval keeps slice order.

    Mode ``block``: rows are ordered by draw inside consecutive blocks of
    ``block`` rows: every window holds at most one buffer, and
    blocks run in parallel.

    Mode ``global``: rows are ordered by draw in the whole phase.  They are
    range-partitioned by (phase, draw, key), so a phase takes as many tasks
    as its share of the rows; a row's place follows from the sizes of the
    partitions and of the phases before it.  No window covers a phase."""
    if mode not in MODES:
        raise ValueError(f"unknown shuffle mode {mode!r}; expected one of {MODES}")
    buf = cfg.block
    if mode == "global":
        train = sl.where(F.col("split") == "train").withColumn("_draw", shuffle_draw(cfg, key))
        placed = with_position(train, ("phase", "_draw", key), "_at", name="phase-order")
        sizes = train.groupBy("phase").agg(F.count(F.lit(1)).alias("_rows"))
        before = Window.orderBy("phase").rowsBetween(Window.unboundedPreceding, -1)  # a row per phase
        firsts = sizes.select("phase", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
        placed = placed.join(F.broadcast(firsts), "phase").withColumn("seq", (F.col("_at") - F.col("_first")).cast("bigint"))
        rest = sl.where(F.col("split") != "train").withColumn("seq", F.col("phase_rank").cast("bigint"))
        out = placed.select(*sl.columns, "seq").union(rest.select(*sl.columns, "seq"))
        return out.withColumn("block", F.floor(F.col("seq") / buf).cast("bigint"))
    block = F.floor(F.col("phase_rank") / buf).cast("bigint")
    s = sl.withColumn("block", block).withColumn("_draw", shuffle_draw(cfg, key))
    w = Window.partitionBy("phase", "split", "block").orderBy("_draw", key)
    rank = F.row_number().over(w) - 1
    order = F.when(F.col("split") == "train", F.col("block") * buf + rank) \
             .otherwise(F.col("phase_rank"))
    return s.withColumn("seq", order.cast("bigint")).drop("_draw")


def micro_batches(sh: DataFrame, cfg: Curriculum) -> DataFrame:
    """micro-steps of ``batch`` rows, counted from 1 in each
    phase and split; the last one may be partial."""
    ms = (F.floor(F.col("seq") / cfg.batch) + 1).cast("bigint")
    return sh.withColumn("micro_step", ms) \
             .withColumn("is_boundary", (ms % cfg.accumulate) == 0)


def fixture_failures(phase: Column, micro_step: Column) -> Column:
    """FIXTURES failed_steps: micro-steps with phase*1000 + step divisible by 7."""
    return ((phase * 1000 + micro_step) % 7) == 0


def global_steps(mb: DataFrame, cfg: Curriculum, failed=None) -> DataFrame:
    """one row per train micro-step with the optimizer-step counter.

    ``global_step``: counter after the micro-step (a step happens at a
    successful boundary, Q3).  ``contributes_to``: the optimizer step whose
    update includes this micro-batch's gradients -- the next successful
    boundary, possibly in the next phase (Q4); null for a failed
    micro-step or leftovers never applied at the end of the run."""
    p = len(cfg.shares)
    # micro-steps follow from how many each phase has: no row of data is sorted
    ends = (mb.filter(F.col("split") == "train").groupBy("epoch", "phase", "p")
              .agg(F.max("micro_step").alias("_last")))
    steps = (ends.withColumn("micro_step", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_last"))))
                 .withColumn("is_boundary", F.col("micro_step") % cfg.accumulate == 0)
                 .withColumn("run_index", F.col("epoch") * p + F.col("phase")).drop("_last"))
    bad = failed(F.col("phase"), F.col("micro_step")) if failed else F.lit(False)
    steps = steps.withColumn("failed", bad) \
                 .withColumn("_sb", (F.col("is_boundary") & ~F.col("failed")).cast("bigint"))
    steps = running_sum(steps, ["run_index", "micro_step"], "_sb", "global_step")
    total = steps.agg(F.coalesce(F.sum("_sb"), F.lit(0)).alias("_total"))
    before = F.col("global_step") - F.col("_sb")
    contrib = F.when(F.col("failed"), F.lit(None)) \
               .when(before + 1 <= F.col("_total"), before + 1)
    return (steps.crossJoin(F.broadcast(total))
                 .withColumn("contributes_to", contrib.cast("bigint"))
                 .withColumn("stepped", F.col("_sb") == 1)
                 .drop("_sb", "_total"))


def event_markers(gs: DataFrame, cfg: Curriculum, n_rows: int, save_every: int) -> DataFrame:
    """F8: eval and save events at optimizer steps, plus one final save."""
    ev = numbers(cfg, n_rows).eval_every
    st = gs.filter("stepped")
    evals = st.filter(F.col("global_step") % ev == 0).withColumn("event", F.lit("eval"))
    saves = st.filter(F.col("global_step") % save_every == 0).withColumn("event", F.lit("save"))
    cols = ["global_step", "event", "epoch", "phase", "p"]
    final = gs.sparkSession.createDataFrame(
        [(None, "final", cfg.epochs - 1, None, 0.0)],
        "global_step bigint, event string, epoch int, phase int, p double")
    return evals.select(*cols).unionByName(saves.select(*cols)).unionByName(final)


def checkpoint_manifest(events: DataFrame, cfg: Curriculum, run: str) -> DataFrame:
    """Checkpoint names and messages for every save."""
    saves = events.filter(F.col("event").isin("save", "final"))
    step = F.col("global_step")
    suffix = F.when(step.isNull(), F.lit(f"final-epoch-{cfg.epochs}")) \
              .otherwise(F.format_string("step-%d-epoch-%d-mlm-%.2f", step, F.col("epoch") + 1, F.col("p")))
    message = F.when(step.isNull(), F.lit(f"Final model - Epoch {cfg.epochs}")) \
               .otherwise(F.format_string("Step %d - Epoch %d (MLM %.2f)", step, F.col("epoch") + 1, F.col("p")))
    return saves.select("global_step", suffix.alias("suffix"), message.alias("message"),
                        F.lit(run).alias("run"))


def lr_schedule(spark: SparkSession, cfg: Curriculum, n_rows: int, peak: float = 5e-4) -> DataFrame:
    """linear decay, zero warm-up; the rate used by optimizer step g
    is lr * max(0, (T - (g - 1)) / T)."""
    t = numbers(cfg, n_rows).all_steps
    g = F.col("id")
    lr = F.lit(peak) * F.greatest(F.lit(0.0), (F.lit(t) - (g - 1)) / F.lit(float(t)))
    return spark.range(1, t + 1).select(g.alias("global_step"), lr.alias("lr"))
