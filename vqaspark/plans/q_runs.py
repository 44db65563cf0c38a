"""Queries: training-log and checkpoint analytics."""

from __future__ import annotations

from vqaspark.operators import runs as RU
from vqaspark.plans import fixtures as FX
from vqaspark.plans import sql as S
from vqaspark.plans.registry import register


@register("log_history", f"select run_id, step, epoch, loss, eval_loss from ({S.TRAIN_LOG}) l where step % 10 = 0")
def q_log_history(spark, sf):
    return RU.log_history(FX.train_log(spark, sf), 10).select("run_id", "step", "epoch", "loss", "eval_loss")


@register("best_eval_step", f"""
select run_id, count(*) as num_evals, min(eval_loss) as best_eval_loss, arg_min(step, (eval_loss, step)) as best_step
from ({S.TRAIN_LOG}) l where eval_loss is not null group by run_id""")
def q_best_eval_step(spark, sf):
    return RU.best_eval_step(FX.train_log(spark, sf))


@register("last_log", f"""
select l.run_id, l.step, l.epoch, l.loss, l.eval_loss
from ({S.TRAIN_LOG}) l join (select run_id, max(step) as ms from ({S.TRAIN_LOG}) m group by run_id) m
  on l.run_id = m.run_id and l.step = m.ms""")
def q_last_log(spark, sf):
    return RU.last_log(FX.train_log(spark, sf))


_CK_SQL = f"""
select run_id, name, try_cast(regexp_extract(name, '-(\\d+)$', 1) as bigint) as n
from ({S.CHECKPOINTS}) c where name like 'checkpoint-%'"""


@register("latest_checkpoint", f"""
select run_id, max(n) as step, arg_max(name, n) as latest_checkpoint
from ({_CK_SQL}) c where n is not null group by run_id""")
def q_latest_checkpoint(spark, sf):
    return RU.latest_checkpoint(FX.checkpoints(spark, sf))


@register("checkpoint_retention", f"""
select run_id, name, step, rank from (
  select run_id, name, n as step, row_number() over (partition by run_id order by n desc) as rank
  from (select distinct run_id, name, n from ({_CK_SQL}) c where n is not null) d) r
where rank <= 2""")
def q_checkpoint_retention(spark, sf):
    return RU.checkpoint_retention(FX.checkpoints(spark, sf), keep=2)


@register("run_summary", f"""
select run_id, count(*) as num_logs, max(step) as total_steps, arg_max(epoch, step) as final_epoch,
       round(avg(loss), 6) as mean_loss, min(loss) as min_loss, arg_max(loss, step) as final_loss
from ({S.TRAIN_LOG}) l group by run_id""")
def q_run_summary(spark, sf):
    return RU.run_summary(FX.train_log(spark, sf))


@register("loss_by_interval", f"""
select run_id, cast(floor(step / 50) as bigint) as bucket, count(*) as num_logs,
       round(avg(loss), 6) as mean_loss, round(avg(eval_loss), 6) as mean_eval_loss
from ({S.TRAIN_LOG}) l group by run_id, floor(step / 50)""")
def q_loss_by_interval(spark, sf):
    return RU.loss_by_interval(FX.train_log(spark, sf), 50)
