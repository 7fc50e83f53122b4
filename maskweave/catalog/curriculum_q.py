"""Step 3 queries: curriculum plan, slices, shuffle, micro-batches,
optimizer steps, learning-rate schedule, events, checkpoint manifest."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskweave.catalog.common import docs
from maskweave.operators import position as P
from maskweave.plans import curriculum as CU
from maskweave.plans.config import Curriculum, numbers, run_label
from maskweave.sources import corpus as C

QUERIES = {}
ORACLES = {}

# the plan of the test tables: E and the blocks are scaled down to them
CFG = Curriculum(eval_rows=10, block=48)
DISJOINT = CFG._replace(overlap=False)
SAVE_EVERY = 50
RUN = run_label("org/base-mlm", "corpus")


def q(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def positioned(spark, sf):
    t = C.resolve_text(docs(spark, sf), "key").select("doc_id")
    pos = P.with_position(t)
    return pos, pos.count()


def batches(spark, sf, cfg=CFG):
    pos, n = positioned(spark, sf)
    sl = CU.slices(pos, cfg, n)
    return CU.with_epochs(CU.micro_batches(CU.shuffled(sl, cfg), cfg), cfg), n


def plan_sql(cfg) -> str:
    """CTEs pos, n, plan, ph, sl, sh, mb in SQL (fixture config)."""
    probs = ", ".join(f"({i}, {p}::double)" for i, p in enumerate(cfg.shares))
    e, b, buf, a = cfg.eval_rows, cfg.batch, cfg.block, cfg.accumulate
    nph = len(cfg.shares)
    t_hi = "ph.phase * c + e + c" if cfg.overlap else "(ph.phase + 1) * c"
    return f"""pos as (select doc_id, row_number() over (order by doc_id) - 1 as pos
         from documents where text is not null and text <> ''),
n as (select count(*) as n from pos),
plan as (select greatest({e} + 1, n // {nph}) as c, {e} as e from n),
ph as (select epoch::int as epoch, phase, p from (values {probs}) as t(phase, p), range({cfg.epochs}) as r(epoch)),
sl as (select epoch, phase, p, 'train' as split, doc_id, pos, pos - (phase * c + e) as phase_rank
         from pos, plan, ph where pos >= phase * c + e and pos < {t_hi}
       union all
       select epoch, phase, p, 'eval' as split, doc_id, pos, pos - phase * c as phase_rank
         from pos, plan, ph where pos >= phase * c and pos < phase * c + e),
sh as (select *, case when split = 'train'
                   then blk * {buf} + row_number() over (partition by epoch, phase, split, blk
                        order by cast('0x' || substr(md5('{cfg.seed}:shuffle:' || phase || ':' || doc_id), 1, 8) as bigint), doc_id) - 1
                   else phase_rank end as seq
         from (select *, phase_rank // {buf} as blk from sl)),
mb as (select *, seq // {b} + 1 as micro_step, (seq // {b} + 1) % {a} = 0 as is_boundary from sh)"""


PLAN = plan_sql(CFG)
STEPS_SQL = f"""with {PLAN},
ms as (select epoch, phase, p, micro_step, is_boundary, (phase * 1000 + micro_step) % 7 = 0 as failed
         from mb where split = 'train' and seq % {CFG.batch} = 0),
g as (select *, case when is_boundary and not failed then 1 else 0 end as sb,
             cast(sum(case when is_boundary and not failed then 1 else 0 end)
                  over (order by epoch, phase, micro_step rows between unbounded preceding and current row) as bigint)
               as global_step
        from ms),
tot as (select sum(sb) as total from g),
gs as (select epoch, phase, p, micro_step, is_boundary, failed, global_step,
              cast(case when failed then null when global_step - sb + 1 <= total then global_step - sb + 1 end as bigint)
                as contributes_to, sb = 1 as stepped
         from g, tot)"""


@q("curriculum_plan", f"""with {PLAN},
bounds as (select epoch, phase, p, 'train' as split, phase * c + e as lo, phase * c + e + c as hi from ph, plan
           union all select epoch, phase, p, 'eval', phase * c, phase * c + e from ph, plan)
select b.epoch, b.phase, b.p, b.split, cast(b.lo as bigint) as lo, cast(b.hi as bigint) as hi,
       cast(count(sl.doc_id) as bigint) as n_rows
  from bounds b left join sl on sl.epoch = b.epoch and sl.phase = b.phase and sl.split = b.split
 group by all""")
def curriculum_plan(spark, sf):
    pos, n = positioned(spark, sf)
    sl = CU.with_epochs(CU.slices(pos, CFG, n), CFG)
    cnt = sl.groupBy("epoch", "phase", "split").agg(F.count(F.lit(1)).alias("n_rows"))
    ph = CU.phase_table(spark, CFG, n)
    return (ph.join(cnt, ["epoch", "phase", "split"], "left")
              .select("epoch", "phase", "p", "split", "lo", "hi",
                      F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows")))


@q("curriculum_slices", f"with {PLAN} select epoch, phase, split, doc_id, pos, phase_rank from sl")
def curriculum_slices(spark, sf):
    pos, n = positioned(spark, sf)
    return CU.with_epochs(CU.slices(pos, CFG, n), CFG).select("epoch", "phase", "split", "doc_id", "pos", "phase_rank")


@q("curriculum_disjoint", f"with {plan_sql(DISJOINT)} select epoch, phase, split, doc_id, pos, phase_rank from sl")
def curriculum_disjoint(spark, sf):
    pos, n = positioned(spark, sf)
    return CU.with_epochs(CU.slices(pos, DISJOINT, n), DISJOINT).select("epoch", "phase", "split", "doc_id", "pos", "phase_rank")


@q("curriculum_leakage", f"""with {PLAN}
select t.phase, cast(count(*) as bigint) as n_overlap
  from sl t join sl v on v.doc_id = t.doc_id and v.split = 'eval' and v.phase = t.phase + 1
 where t.split = 'train' group by t.phase""")
def curriculum_leakage(spark, sf):
    pos, n = positioned(spark, sf)
    c = numbers(CFG, n).chunk
    sl = CU.slices(pos, CFG, n)
    # a train row of phase i sits in eval slice i+1 when pos >= (i+1)C
    over = sl.filter((F.col("split") == "train") & (F.col("pos") >= (F.col("phase") + 1) * c)
                     & (F.col("phase") + 1 < len(CFG.shares)))
    return over.groupBy("phase").agg(F.count(F.lit(1)).cast("bigint").alias("n_overlap"))


@q("buffer_shuffle", f"with {PLAN} select epoch, phase, doc_id, seq from sh where split = 'train'")
def buffer_shuffle(spark, sf):
    pos, n = positioned(spark, sf)
    sh = CU.with_epochs(CU.shuffled(CU.slices(pos, CFG, n), CFG), CFG)
    return sh.filter(F.col("split") == "train").select("epoch", "phase", "doc_id", "seq")


@q("phase_slices", f"with {PLAN} select distinct phase, split, doc_id, phase_rank from sl")
def phase_slices(spark, sf):
    """F3/F4 phase by phase from a table in order of position."""
    pos, n = positioned(spark, sf)
    table = CU.clustered(pos.select("doc_id", "pos"))
    parts = [CU.phase_slice(table, CFG, n, k, split).select(
        F.lit(k).alias("phase"), F.lit(split).alias("split"), "doc_id", "phase_rank")
        for k in range(len(CFG.shares)) for split in CU.SPLITS]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


@q("global_shuffle", f"""with {PLAN}
select epoch, phase, split, doc_id, case when split = 'train' then row_number() over (partition by epoch, phase, split
         order by cast('0x' || substr(md5('{CFG.seed}:shuffle:' || phase || ':' || doc_id), 1, 8) as bigint), doc_id) - 1
       else phase_rank end as seq
  from sl""")
def global_shuffle(spark, sf):
    """F5 across a whole phase, eval rows in slice order."""
    pos, n = positioned(spark, sf)
    sh = CU.with_epochs(CU.shuffled(CU.slices(pos, CFG, n), CFG, mode="global"), CFG)
    return sh.select("epoch", "phase", "split", "doc_id", "seq")


@q("micro_batches", f"with {PLAN} select epoch, phase, split, doc_id, micro_step, is_boundary from mb")
def micro_batches(spark, sf):
    mb, _ = batches(spark, sf)
    return mb.select("epoch", "phase", "split", "doc_id", "micro_step", "is_boundary")


@q("global_steps", f"""{STEPS_SQL}
select epoch, phase, micro_step, is_boundary, failed, global_step, contributes_to from gs""")
def global_steps(spark, sf):
    mb, _ = batches(spark, sf)
    gs = CU.global_steps(mb, CFG, CU.fixture_failures)
    return gs.select("epoch", "phase", "micro_step", "is_boundary", "failed", "global_step", "contributes_to")


TWO = CFG._replace(epochs=2)


@q("two_epoch_slices", f"with {plan_sql(TWO)} select epoch, phase, split, doc_id, seq, micro_step from mb")
def two_epoch_slices(spark, sf):
    """The same order in both epochs (Q5)."""
    mb, _ = batches(spark, sf, TWO)
    return mb.select("epoch", "phase", "split", "doc_id", "seq", "micro_step")


@q("two_epoch_steps", STEPS_SQL.replace(PLAN, plan_sql(TWO)) + """
select epoch, phase, micro_step, failed, global_step, contributes_to from gs""")
def two_epoch_steps(spark, sf):
    """Counters go on over phases and epochs (Q4)."""
    mb, _ = batches(spark, sf, TWO)
    return CU.global_steps(mb, TWO, CU.fixture_failures).select(
        "epoch", "phase", "micro_step", "failed", "global_step", "contributes_to")


@q("lr_schedule", f"""with t as (select cast(ceil(count(*) / {CFG.batch * CFG.accumulate}) as bigint) * {CFG.epochs} as t
  from documents where text is not null and text <> '')
select g as global_step, round(0.0005::double * greatest(0.0, (t - (g - 1)) / t::double), 12) as lr
  from t, range(1, t + 1) r(g)""")
def lr_schedule(spark, sf):
    _, n = positioned(spark, sf)
    return CU.lr_schedule(spark, CFG, n).select("global_step", F.round("lr", 12).alias("lr"))


def _events_sql() -> str:
    return f"""{STEPS_SQL},
iv as (select greatest(1, (cast(ceil(n / {CFG.batch * CFG.accumulate}) as bigint)) // ({CFG.epochs} * 4)) as ev from n),
events as (select global_step, 'eval' as event, epoch, phase, p from gs, iv where stepped and global_step % ev = 0
           union all
           select global_step, 'save', epoch, phase, p from gs where stepped and global_step % {SAVE_EVERY} = 0
           union all
           select null, 'final', {CFG.epochs - 1}, null, 0.0::double)"""


@q("event_markers", f"{_events_sql()} select global_step, event, epoch, phase, p from events")
def event_markers(spark, sf):
    mb, n = batches(spark, sf)
    gs = CU.global_steps(mb, CFG, CU.fixture_failures)
    return CU.event_markers(gs, CFG, n, SAVE_EVERY)


@q("checkpoint_manifest", f"""{_events_sql()}
select global_step,
       case when global_step is null then 'final-epoch-{CFG.epochs}'
            else printf('step-%d-epoch-%d-mlm-%.2f', global_step, epoch + 1, p) end as suffix,
       case when global_step is null then 'Final model - Epoch {CFG.epochs}'
            else printf('Step %d - Epoch %d (MLM %.2f)', global_step, epoch + 1, p) end as message,
       '{RUN}' as run
  from events where event in ('save', 'final')""")
def checkpoint_manifest(spark, sf):
    mb, n = batches(spark, sf)
    gs = CU.global_steps(mb, CFG, CU.fixture_failures)
    return CU.checkpoint_manifest(CU.event_markers(gs, CFG, n, SAVE_EVERY), CFG, RUN)
