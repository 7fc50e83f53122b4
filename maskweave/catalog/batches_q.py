"""Steps 6-7 queries: masking, padding, shape rule, batch scores and
evaluation aggregates over the full training-data plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskweave.catalog.common import docs
from maskweave.catalog.curriculum_q import CFG, RUN, TWO, plan_sql
from maskweave.catalog.encode_q import VOCAB_CTES, greedy_ctes, test_vocab
from maskweave.operators import collate as CO
from maskweave.operators import encode as EN
from maskweave.operators import evaluate as EV
from maskweave.plans import curriculum as CU
from maskweave.plans.batches import training_data
from maskweave.session import scratch_path
from maskweave.sources import sinks as S

QUERIES = {}
ORACLES = {}

KEYS = ["epoch", "phase", "split", "micro_step"]


def q(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def data(spark, sf, cfg=CFG):
    return training_data(docs(spark, sf), test_vocab(spark, sf), cfg)


def scores(spark, sf, failed=None):
    td = data(spark, sf)
    nll = EV.token_logp(td.encoded)
    return td, EV.score_batches(td.masked, nll, KEYS, failed)


MASK_SQL = f"""with recursive {VOCAB_CTES},
{greedy_ctes('documents', 'doc_id')},
{plan_sql(CFG)},
mrow as (select *, md5('{CFG.seed}:mlm:' || epoch || ':' || phase || ':' || split || ':' || doc_id) as h from mb),
mseed as (select *, cast('0x' || substr(h, 1, 7) as bigint) * 8 as s0, cast('0x' || substr(h, 8, 7) as bigint) * 8 as s1,
                 cast('0x' || substr(h, 15, 7) as bigint) * 8 as s2 from mrow),
mt as (select mb.epoch, mb.phase, mb.split, mb.p, mb.doc_id, mb.micro_step, d.t_idx, d.id as t, s1, s2,
              (s0 + (d.t_idx + 1) * 1630279) % 2147483647 as x
         from mseed mb join dtok d on d.doc_id = mb.doc_id),
m1 as (select *, x * x % 2147483647 as y, y * y % 2147483647 as y2, (y2 * x % 2147483647 * 48271 + 11) % 2147483647 as z from mt),
m2 as (select *, (z + s1) % 2147483647 as x, x * x % 2147483647 as y, y * y % 2147483647 as y2,
              (y2 * x % 2147483647 * 48271 + 11) % 2147483647 as act from (select * exclude (x, y, y2) from m1)),
mu as (select *, (act + s2) % 2147483647 as x, x * x % 2147483647 as y, y * y % 2147483647 as y2,
              (y2 * x % 2147483647 * 48271 + 11) % 2147483647 as pick from (select * exclude (x, y, y2) from m2)),
msel as (select *, (z < ceil(p * 2147483647.0::double) and t not in (select id from vocab where role is not null)) as sel from mu),
mr as (select *, case when not sel then t
                      when act < ceil(0.8::double * 2147483647.0::double) then (select id from vocab where role = 'mask')
                      when act < ceil(0.9::double * 2147483647.0::double)
                        then cast(pick * (select count(*) from vocab) // 2147483647 as bigint)
                      else t end as new_id,
              case when sel then t else -100 end as label
         from msel),
rows_ as (select epoch, phase, split, doc_id, micro_step, cast(count_if(sel) as bigint) as n_selected,
                 cast(count(*) as bigint) as n_tokens,
                 string_agg(cast(new_id as varchar), ' ' order by t_idx) as ids,
                 string_agg(cast(label as varchar), ' ' order by t_idx) as labels
            from mr group by all),
nll as (select id, -ln(c / total) as nll
          from (select id, count(*)::double as c from dtok group by id), (select count(*)::double as total from dtok)),
bs as (select b.epoch, b.phase, b.split, b.micro_step, cast(count(distinct b.doc_id) as bigint) as n_rows,
              cast(count_if(m.sel) as bigint) as n_masked,
              avg(case when m.sel then n.nll end) as raw_loss
         from mb b left join mr m on m.doc_id = b.doc_id and m.epoch = b.epoch and m.phase = b.phase and m.split = b.split
              left join nll n on n.id = m.t
        group by all),
sc as (select *, case when n_masked = 0 then 'no masked tokens' end as error from bs),
scores as (select epoch, phase, split, micro_step, n_rows, n_masked, error,
                  case when error is null then raw_loss end as loss from sc)"""


@q("mlm_mask", f"""{MASK_SQL}
select epoch, phase, split, doc_id, n_selected, ids, labels from rows_""")
def mlm_mask(spark, sf):
    m = data(spark, sf).masked
    return m.select("epoch", "phase", "split", "doc_id",
                    F.size(F.array_remove("labels", CO.IGNORE)).cast("bigint").alias("n_selected"),
                    EN.ids_string("input_ids").alias("ids"), EN.ids_string("labels").alias("labels"))


@q("two_epoch_masks", f"""{MASK_SQL.replace(plan_sql(CFG), plan_sql(TWO))}
select epoch, phase, split, doc_id, n_selected, labels from rows_""")
def two_epoch_masks(spark, sf):
    """Draws differ between epochs."""
    m = data(spark, sf, TWO).masked
    return m.select("epoch", "phase", "split", "doc_id",
                    F.size(F.array_remove("labels", CO.IGNORE)).cast("bigint").alias("n_selected"),
                    EN.ids_string("labels").alias("labels"))


@q("mask_rate_by_phase", f"""{MASK_SQL}
select phase, p, cast(sum(n_tokens) as bigint) as n_tokens, cast(sum(n_selected) as bigint) as n_selected,
       round(sum(n_selected) / sum(n_tokens), 6) as rate
  from rows_ join (select distinct phase as ph_, p from mb) on ph_ = phase group by phase, p""")
def mask_rate_by_phase(spark, sf):
    m = data(spark, sf).masked
    per = m.select("phase", "p", F.size("labels").alias("t"),
                   F.size(F.array_remove("labels", CO.IGNORE)).alias("s"))
    return per.groupBy("phase", "p").agg(
        F.sum("t").cast("bigint").alias("n_tokens"), F.sum("s").cast("bigint").alias("n_selected"),
        F.round(F.sum("s") / F.sum("t"), 6).alias("rate"))


@q("pad_batches", f"""{MASK_SQL},
lens as (select epoch, phase, split, micro_step, n_tokens from rows_)
select epoch, phase, split, micro_step, cast(count(*) as bigint) as n_rows, max(n_tokens) as max_len,
       cast(sum(mx - n_tokens) as bigint) as n_pad
  from (select *, max(n_tokens) over (partition by epoch, phase, split, micro_step) as mx from lens)
 group by epoch, phase, split, micro_step""")
def pad_batches(spark, sf):
    td = data(spark, sf)
    p = td.padded.select(*KEYS, F.size("input_ids").alias("L"),
                         (F.size("attention_mask") - F.size(F.array_remove("attention_mask", 0))).alias("pads"))
    return p.groupBy(*KEYS).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                                F.max("L").cast("bigint").alias("max_len"),
                                F.sum("pads").cast("bigint").alias("n_pad"))


@q("shape_check", f"""{MASK_SQL}
select epoch, phase, split, micro_step, cast(count(*) as bigint) as n_rows, 1::bigint as n_lengths,
       cast(count(*) as bigint) as n_squeezed_ok
  from rows_ group by epoch, phase, split, micro_step""")
def shape_check(spark, sf):
    td = data(spark, sf)
    p = td.padded.withColumn("_nested", F.array("input_ids"))
    ok = (CO.squeeze_leading(F.col("_nested")) == CO.as_int64("input_ids")).cast("int")
    return (p.select(*KEYS, F.size("input_ids").alias("L"), ok.alias("ok"))
             .groupBy(*KEYS).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                                 F.countDistinct("L").cast("bigint").alias("n_lengths"),
                                 F.sum("ok").cast("bigint").alias("n_squeezed_ok")))


@q("shape_nested", f"""{MASK_SQL}
select epoch, phase, split, micro_step, count(*) as n_rows, max(n_tokens)::bigint as width,
       (count(*) * max(n_tokens))::bigint as n_ids
  from rows_ group by epoch, phase, split, micro_step""")
def shape_nested(spark, sf):
    """G4, G5 at rank 3: a batch of shape [1, b, n] becomes [b, n]."""
    rows = data(spark, sf).padded.groupBy(*KEYS).agg(F.collect_list("input_ids").alias("ids"))  # a batch each
    batch = rows.select(*KEYS, CO.squeeze_leading(F.array("ids")).alias("ids"))
    return batch.select(*KEYS, F.size("ids").cast("bigint").alias("n_rows"),
                        F.size(F.element_at("ids", 1)).cast("bigint").alias("width"),
                        F.size(F.flatten("ids")).cast("bigint").alias("n_ids"))


@q("batch_scores", f"""{MASK_SQL}
select epoch, phase, split, micro_step, n_rows, n_masked, round(loss, 6) as loss, error from scores""")
def batch_scores(spark, sf):
    _, sc = scores(spark, sf)
    return sc.select(*KEYS, F.col("n_rows").cast("bigint"), F.col("n_masked").cast("bigint"),
                     F.round("loss", 6).alias("loss"), "error")


@q("eval_mean", f"""{MASK_SQL}
select epoch, phase, cast(count(*) as bigint) as n_batches, cast(count_if(error is not null) as bigint) as n_failed,
       round(coalesce(avg(loss), 'Infinity'::double), 6) as mean_loss
  from scores where split = 'eval' group by epoch, phase""")
def eval_mean(spark, sf):
    _, sc = scores(spark, sf)
    m = EV.eval_mean(sc)
    return m.withColumn("mean_loss", F.round("mean_loss", 6))


@q("eval_mean_empty", f"""{MASK_SQL}
select cast(count(*) as bigint) as n_batches, cast(coalesce(count_if(error is not null), 0) as bigint) as n_failed,
       coalesce(avg(loss), 'Infinity'::double) as mean_loss
  from scores where split = 'eval' and phase >= {len(CFG.shares)}""")
def eval_mean_empty(spark, sf):
    _, sc = scores(spark, sf)
    none = sc.filter((F.col("split") == "eval") & (F.col("phase") >= len(CFG.shares)))
    return EV.overall_mean(none)


@q("failed_batches", f"""{MASK_SQL}
select epoch, phase, split, cast(count(*) as bigint) as n_batches,
       cast(count_if(error is not null or (phase * 1000 + micro_step) % 7 = 0) as bigint) as n_failed
  from scores group by epoch, phase, split""")
def failed_batches(spark, sf):
    """H2: some micro-steps are made to fail."""
    _, sc = scores(spark, sf, CU.fixture_failures)
    return sc.groupBy("epoch", "phase", "split").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_batches"),
        F.count_if(F.col("error").isNotNull()).cast("bigint").alias("n_failed"))


@q("train_loss_log", f"""{MASK_SQL},
ms as (select epoch, phase, micro_step, is_boundary from mb where split = 'train' and seq % {CFG.batch} = 0),
g as (select *, cast(sum(is_boundary::int)
                  over (order by epoch, phase, micro_step rows between unbounded preceding and current row) as bigint)
               as global_step, is_boundary as stepped from ms)
select g.global_step, round(s.loss, 6) as loss
  from g join scores s on s.epoch = g.epoch and s.phase = g.phase and s.micro_step = g.micro_step and s.split = 'train'
 where g.stepped""")
def train_loss_log(spark, sf):
    td, sc = scores(spark, sf)
    gs = CU.global_steps(td.batches, CFG)
    return EV.train_loss_log(sc, gs).withColumn("loss", F.round("loss", 6))


@q("metrics_log", f"""{MASK_SQL},
ms as (select epoch, phase, micro_step, is_boundary from mb where split = 'train' and seq % {CFG.batch} = 0),
g as (select *, cast(sum(is_boundary::int)
                  over (order by epoch, phase, micro_step rows between unbounded preceding and current row) as bigint)
               as global_step, is_boundary as stepped from ms)
select '{RUN}' as run, g.global_step as step, 'loss' as name, round(s.loss, 6) as value
  from g join scores s on s.epoch = g.epoch and s.phase = g.phase and s.micro_step = g.micro_step and s.split = 'train'
 where g.stepped
union all
select '{RUN}', coalesce((select max(global_step) from g where g.epoch = e.epoch and g.phase = e.phase), 0), 'eval_loss',
       round(coalesce(avg(e.loss), 'Infinity'::double), 6)
  from scores e where e.split = 'eval' group by e.epoch, e.phase""")
def metrics_log(spark, sf):
    td, sc = scores(spark, sf)
    gs = CU.global_steps(td.batches, CFG)
    log = EV.train_loss_log(sc, gs).select(F.lit(RUN).alias("run"), F.col("global_step").alias("step"),
                                          F.lit("loss").alias("name"), F.round("loss", 6).alias("value"))
    # the evaluation of a phase is logged at the step that the phase ends with
    ends = gs.groupBy("epoch", "phase").agg(F.max("global_step").alias("step"))
    evals = EV.eval_mean(sc).join(ends, ["epoch", "phase"], "left").select(
        F.lit(RUN).alias("run"), F.coalesce("step", F.lit(0)).alias("step"), F.lit("eval_loss").alias("name"),
        F.round("mean_loss", 6).alias("value"))
    log = log.unionByName(evals)
    path = scratch_path(spark, "metrics")
    S.log_metrics(log, path, once=True)
    S.log_metrics(log, path, once=True)  # a replay adds nothing
    return spark.read.parquet(path)


def _masked_per_row(pdf):
    """A user score: mean count of masked labels per row."""
    return float(sum(int((pdf_l != CO.IGNORE).sum()) for pdf_l in pdf["labels"]) / len(pdf))


@q("batch_scores_udf", f"""{MASK_SQL}
select epoch, phase, split, micro_step,
       round(avg(n_selected), 6) as loss, false as failed
  from rows_ group by epoch, phase, split, micro_step""")
def batch_scores_udf(spark, sf):
    m = data(spark, sf).masked.select(*KEYS, "labels")
    sc = EV.score_with(m, _masked_per_row, KEYS)
    return sc.select(*KEYS, F.round("loss", 6).alias("loss"), F.col("error").isNotNull().alias("failed"))


@q("flagship_batches", f"""{MASK_SQL},
w as (select *, max(n_tokens) over (partition by epoch, phase, split, micro_step) as width from rows_)
select epoch, phase, split, micro_step, doc_id, p_ as p, cast(width as bigint) as width,
       trim(ids || repeat(' ' || (select id from vocab where role = 'pad'), (width - n_tokens)::bigint)) as input_ids,
       trim(repeat('1 ', n_tokens) || repeat('0 ', (width - n_tokens)::bigint)) as attention_mask,
       trim(labels || repeat(' -100', (width - n_tokens)::bigint)) as labels
  from w join (select distinct phase as ph_, p as p_ from mb) on ph_ = phase""")
def flagship_batches(spark, sf):
    """Masked, padded phase batches: the whole training-data plan; token
    lists as strings."""
    td = data(spark, sf)
    return td.padded.select(*KEYS, "doc_id", "p", F.size("input_ids").cast("bigint").alias("width"),
                            *[EN.ids_string(c).alias(c) for c in ("input_ids", "attention_mask", "labels")])
