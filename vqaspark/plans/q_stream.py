"""Queries: the streaming operators, run to completion with availableNow.
Each returns the sink read back as a batch table, so it compares 1:1 with
the batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from vqaspark.plans import sql as S
from vqaspark.plans.fixtures import sample_id
from vqaspark.plans.q_data import _chat_sql
from vqaspark.plans.registry import register
from vqaspark.session import scratch_path
from vqaspark.sources.tables import read_table
from vqaspark.streaming import stream as ST


@register("stream_prepare", f"""
select (conv_id << 20) + turn as id, {_chat_sql('text', None)} as text
from conversations where role = 'user' and text <> ''""")
def q_stream_prepare(spark, sf):
    conv = ST.table_stream(spark, sf, "conversations")
    req = (conv.where(F.col("role") == "user")
               .select(sample_id("conv_id", "turn").alias("id"), F.col("text").alias("question")))
    sink, ckpt = ST.scratch_pair(spark, "stream-prepare")
    return ST.run_append(ST.prepare_stream(req), sink, ckpt)


@register("stream_log_windows", """
select user_id as run_id, cast(epoch(date_trunc('day', ts)) as bigint) as window_start,
       count(*) as num_logs, round(sum(value), 6) as sum_loss
from events group by user_id, date_trunc('day', ts)""")
def q_stream_log_windows(spark, sf):
    ev = ST.table_stream(spark, sf, "events")
    log = ev.select(F.col("user_id").alias("run_id"), "ts", F.col("value").alias("loss"))
    agg = ST.windowed_loss(log, watermark=None).select(
        "run_id", F.unix_seconds(F.col("window.start")).alias("window_start"),
        "num_logs", "sum_loss")
    sink, ckpt = ST.scratch_pair(spark, "stream-windows")
    out = ST.run_upserts(agg, ["run_id", "window_start"], sink, ckpt)
    return out.select("run_id", "window_start", "num_logs", F.round("sum_loss", 6).alias("sum_loss"))


@register("stream_log_watermark", """
select user_id as run_id, cast(epoch(date_trunc('day', ts)) as bigint) as window_start,
       count(*) as num_logs, round(sum(value), 6) as sum_loss
from events group by user_id, date_trunc('day', ts)""")
def q_stream_log_watermark(spark, sf):
    """The log in order, five days to a file: the watermark closes windows as
    it passes, no row is late, and none may be dropped."""
    out = ST.run_upserts(
        ST.windowed_loss(ST.file_stream(spark, _log_files(spark, sf, F.lit(False))), watermark="1 day").select(
            "run_id", F.unix_seconds(F.col("window.start")).alias("window_start"), "num_logs", "sum_loss"),
        ["run_id", "window_start"], *ST.scratch_pair(spark, "stream-watermark"))
    return out.select("run_id", "window_start", "num_logs", F.round("sum_loss", 6).alias("sum_loss"))


LOG_FILES = 6       # of five days each


def _log_files(spark, sf, delayed) -> str:
    """The training log as files that arrive one after the other; rows
    ``delayed`` come with the last one."""
    log = read_table(spark, sf, "events").select(F.col("user_id").alias("run_id"), "event_id", "ts", F.col("value").alias("loss"))
    arrival = F.when(delayed, LOG_FILES - 1).otherwise(F.expr(f"(dayofmonth(ts) - 1) div 5 % {LOG_FILES}"))
    path = scratch_path(spark, "log-files")
    for k in range(LOG_FILES):
        log.where(arrival == k).coalesce(1).write.mode("append").parquet(path)
    return path


@register("stream_late_rows", f"""
with e as (select user_id as run_id, ts, value as loss,
                  case when event_id % 10 = 0 then {LOG_FILES - 1} else (day(ts) - 1) // 5 % {LOG_FILES} end as arrival from events),
     m as (select arrival, max(max(ts)) over (order by arrival rows between unbounded preceding and 1 preceding)
                  - interval 1 day as mark from e group by arrival),
     r as (select run_id, date_trunc('day', ts) as day, loss, coalesce(date_trunc('day', ts) + interval 1 day <= mark, false) as late
           from e join m using (arrival))
select run_id, cast(epoch(day) as bigint) as window_start, count(*) filter (not late) as num_logs,
       round(coalesce(sum(loss) filter (not late), 0), 6) as sum_loss, count(*) filter (late) as num_late
from r group by run_id, day""")
def q_stream_late_rows(spark, sf):
    """Every tenth row of the log arrives with the last file: what the
    watermark refuses is counted by window beside what it lets in."""
    stream = ST.file_stream(spark, _log_files(spark, sf, F.col("event_id") % 10 == 0))
    windows, late = ST.run_windows(stream, "1 day", *ST.scratch_pair(spark, "stream-late"))
    refused = late.groupBy(F.window("ts", "1 day"), "run_id").agg(F.count(F.lit(1)).alias("num_late"))
    both = windows.join(refused, ["window", "run_id"], "full_outer")
    return both.select("run_id", F.unix_seconds(F.col("window.start")).alias("window_start"),
                       F.coalesce("num_logs", F.lit(0)).alias("num_logs"),
                       F.round(F.coalesce("sum_loss", F.lit(0.0)), 6).alias("sum_loss"),
                       F.coalesce("num_late", F.lit(0)).alias("num_late"))


@register("stream_exact_match", f"""
select count(*) as num_samples,
  cast(sum(case when {S.norm('teacher_answer')} = {S.norm('reference_answer')} then 1 else 0 end) as bigint) as matches,
  round(sum(case when {S.norm('teacher_answer')} = {S.norm('reference_answer')} then 1 else 0 end) / count(*), 6)
    as exact_match
from ({S.ITEM_PREDS}) p""")
def q_stream_exact_match(spark, sf):
    li = ST.table_stream(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    part = read_table(spark, sf, "part").select("p_partkey", "p_name")
    j = li.join(part, li.l_partkey == part.p_partkey)  # stream-static join
    name, pk, ok = F.col("p_name"), F.col("l_partkey"), F.col("l_orderkey")
    preds = j.select(
        F.when(pk % 11 == 0, F.lit(None).cast("string")).when(pk % 11 == 1, F.lit("")).otherwise(name)
         .alias("reference_answer"),
        F.when(ok % 5 == 0, F.concat(F.lit(" "), F.upper(name), F.lit(" ")))
         .when(ok % 5 == 1, F.split_part(name, F.lit(" "), F.lit(1))).otherwise(name).alias("teacher_answer"))
    sink, ckpt = ST.scratch_pair(spark, "stream-em")
    out = ST.run_complete(ST.running_exact_match(preds), sink, ckpt)
    return out.select("num_samples", "matches",
                      F.round(F.col("matches") / F.col("num_samples"), 6).alias("exact_match"))
