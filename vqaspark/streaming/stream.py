"""Structured Streaming versions of preparation and metrics.

Sources are file streams (``readStream`` over parquet, explicit schema,
``maxFilesPerTrigger`` or ``maxBytesPerTrigger``).  Queries run with ``trigger(availableNow=True)``:
everything present is processed in bounded micro-batches and the query
stops; the sink is then readable as a batch table.  Sinks are exactly-once:
the file sink with a checkpoint, or ``foreachBatch`` writes keyed by batch id
(a replayed batch overwrites its own output instead of duplicating it).
"""

from __future__ import annotations

import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from vqaspark.functions.text import normalize_answer
from vqaspark.operators.prepare import DEFAULT_TEMPLATE, vqa_messages
from vqaspark.session import scratch_path
from vqaspark.sources.tables import is_folder, ntz_as_utc, table_path


def file_stream(spark: SparkSession, directory: str, glob: str = "*.parquet",
                schema: T.StructType | None = None, max_files_per_trigger: int = 1,
                max_bytes_per_trigger: int | None = None) -> DataFrame:
    """S3: stream the parquet files of ``directory`` matching ``glob``.  The
    schema is taken from the files' footers when not given (no data read).
    A micro-batch is bounded by files, or by bytes if given (a larger file is
    a batch of its own)."""
    if schema is None:
        schema = spark.read.option("pathGlobFilter", glob).parquet(directory).schema
    bound = (("maxFilesPerTrigger", max_files_per_trigger) if max_bytes_per_trigger is None
             else ("maxBytesPerTrigger", max_bytes_per_trigger))
    return (spark.readStream.schema(schema).option(*bound)
                 .option("pathGlobFilter", glob).parquet(directory))


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_bytes_per_trigger: int = 1 << 30) -> DataFrame:
    """A table as a stream, be it one file or a folder of files."""
    path = table_path(sf_dir, name)
    directory, glob = (path, "*") if is_folder(spark, path) else (sf_dir, f"{name}.parquet")
    df = file_stream(spark, directory, glob, max_bytes_per_trigger=max_bytes_per_trigger)
    if name == "events":
        df = df.withColumn("ts", ntz_as_utc("ts"))
    return df


def _await(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


# ---------------------------------------------------------------- T1

def prepare_stream(requests: DataFrame, template=DEFAULT_TEMPLATE) -> DataFrame:
    """Stateless P3 filter (question, and ``image_path`` where requests
    carry one) + prompt messages + chat render on a stream."""
    from vqaspark.operators.prepare import valid_requests
    if "image_path" in requests.columns:
        ok = valid_requests(requests)
    else:
        ok = requests.where(F.col("question") != "")
    return ok.select("id", template.render(vqa_messages(F.col("question")), True).alias("text"))


def run_append(stream_df: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    """Append a stateless stream into a parquet file sink (exactly-once via
    the sink's log and the checkpoint) and return the sink as a table."""
    q = (stream_df.writeStream.format("parquet").option("path", sink)
                  .option("checkpointLocation", checkpoint).outputMode("append")
                  .trigger(availableNow=True).start())
    _await(q)
    return stream_df.sparkSession.read.parquet(sink)


# ---------------------------------------------------------------- T2

def windowed_loss(log_stream: DataFrame, watermark: str | None, window: str = "1 day",
                  run_col: str = "run_id") -> DataFrame:
    """Tumbling-window loss statistics per run.  ``watermark`` is the
    caller's to choose: how late rows may come (state of older windows is
    dropped, and rows for them too: see ``run_upserts``), or ``None`` to keep
    every window open and lose no row, for input in any order."""
    marked = log_stream if watermark is None else log_stream.withWatermark("ts", watermark)
    return (marked
                      .groupBy(F.window("ts", window), run_col)
                      .agg(F.count(F.lit(1)).alias("num_logs"),
                           F.sum("loss").alias("sum_loss")))


class DroppedRows(StreamingQueryListener):
    """Adds up the rows that the watermark drops, over all batches of the
    queries it hears of (a query itself keeps only its last progress reports)."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self._ended: dict[str, threading.Event] = {}

    def _end_of(self, run_id) -> threading.Event:
        return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event):
        self._end_of(event.runId)

    def onQueryProgress(self, event):
        p = event.progress
        dropped = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        self.rows[str(p.runId)] = self.rows.get(str(p.runId), 0) + int(dropped)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._end_of(event.runId).set()

    def total(self, query, timeout: float = 120) -> int:
        """Rows dropped in a finished query.  Reports come in order, so the
        last has been heard once the end is."""
        if not self._end_of(query.runId).wait(timeout):
            raise RuntimeError("the stream's reports did not arrive")
        return self.rows.get(str(query.runId), 0)


def run_upserts(agg_stream: DataFrame, key_cols, sink: str, checkpoint: str, late: str = "fail") -> DataFrame:
    """Run an aggregation in ``update`` mode; each micro-batch's changed rows
    go to ``<sink>/batch_id=<n>`` (overwrite = idempotent on replay).  The
    returned table keeps, per key, the row of the latest batch, so windows
    still open at the end of the input are reported too.  Rows that came too
    late for the watermark, in any batch, raise, unless ``late="ignore"``
    (``run_windows`` keeps them as data)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(sink, f"batch_id={batch_id}"))

    spark = agg_stream.sparkSession
    dropped = DroppedRows()
    spark.streams.addListener(dropped)
    try:
        q = (agg_stream.writeStream.outputMode("update").foreachBatch(write)
                       .option("checkpointLocation", checkpoint)
                       .trigger(availableNow=True).start())
        _await(q)
        if late != "ignore" and dropped.total(q):
            raise RuntimeError(f"{dropped.total(q)} rows came too late for the watermark and were not counted")
    finally:
        spark.streams.removeListener(dropped)
    out = spark.read.parquet(sink)
    vals = [c for c in out.columns if c not in list(key_cols) + ["batch_id"]]
    latest = out.groupBy(*key_cols).agg(F.max_by(F.struct(*vals), "batch_id").alias("_v"))
    return latest.select(*key_cols, *[F.col(f"_v.{c}").alias(c) for c in vals])


def run_windows(log_stream: DataFrame, watermark: str, sink: str, checkpoint: str, window: str = "1 day",
                run_col: str = "run_id") -> tuple[DataFrame, DataFrame]:
    """T2 with the late rows kept: (windows as ``windowed_loss`` has them, late
    rows as they came with the ``batch_id`` and ``watermark`` that refused them).

    A batch's watermark is the latest event time of the batches before it, less
    ``watermark``; rows whose window ended by then are late.  Each batch writes
    its late rows, the sums of its other rows by window, and its latest event
    time under its own ``batch_id``: a replayed batch finds the same watermark
    and overwrites what it wrote.  Sums of open windows lie in the sink, not in
    a state store, so memory does not grow with the windows.  Rows without an
    event time belong to no window and are kept with the late ones."""
    spark = log_stream.sparkSession
    at = {k: os.path.join(sink, k) for k in ("sums", "late", "marks")}

    def write(batch: DataFrame, batch_id: int) -> None:
        mine = {k: os.path.join(p, f"batch_id={batch_id}") for k, p in at.items()}
        own = batch.sparkSession
        before = None
        if batch_id > 0:
            marks = own.read.schema("latest timestamp, batch_id long").option("basePath", at["marks"]).parquet(at["marks"])
            before = marks.where(F.col("batch_id") < batch_id).agg(
                F.unix_micros(F.max("latest") - F.expr(f"interval {watermark}")).alias("w")).first()["w"]
        mark = F.timestamp_micros(F.lit(before).cast("long"))
        timed = batch.withColumn("window", F.window("ts", window))
        late = F.coalesce(F.col("window.end") <= mark, F.lit(False))
        (timed.where(~late).groupBy("window", run_col).agg(F.count(F.lit(1)).alias("num_logs"), F.sum("loss").alias("sum_loss"))
              .write.mode("overwrite").parquet(mine["sums"]))
        refused = (timed.where(late).drop("window")
                   .unionByName(batch.where(F.col("ts").isNull())).withColumn("watermark", mark))
        refused.write.mode("overwrite").parquet(mine["late"])
        batch.agg(F.max("ts").alias("latest")).write.mode("overwrite").parquet(mine["marks"])

    q = (log_stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _await(q)
    sums = spark.read.parquet(at["sums"])
    windows = sums.groupBy("window", run_col).agg(F.sum("num_logs").alias("num_logs"), F.sum("sum_loss").alias("sum_loss"))
    return windows, spark.read.parquet(at["late"])


# ---------------------------------------------------------------- T3

def running_exact_match(pred_stream: DataFrame, pred: str = "teacher_answer",
                        ref: str = "reference_answer") -> DataFrame:
    """Running exact match over a prediction stream (one-row state)."""
    p, r = normalize_answer(pred), normalize_answer(ref)
    hit = F.when(p.isNotNull() & r.isNotNull() & (p == r), 1).otherwise(0)
    return pred_stream.agg(F.count(F.lit(1)).alias("num_samples"),
                           F.sum(hit).cast("bigint").alias("matches"))


def run_complete(agg_stream: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    """Run a small aggregation in ``complete`` mode; every batch writes the full
    current result under its own ``batch_id`` (a replay overwrites only
    itself), so readers always find the last whole one."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(sink, f"batch_id={batch_id}"))

    q = (agg_stream.writeStream.outputMode("complete").foreachBatch(write)
                   .option("checkpointLocation", checkpoint)
                   .trigger(availableNow=True).start())
    _await(q)
    out = agg_stream.sparkSession.read.parquet(sink)
    last = out.agg(F.max("batch_id").alias("b")).first()["b"]
    return out.where(F.col("batch_id") == last).drop("batch_id")


def scratch_pair(spark: SparkSession, name: str):
    return scratch_path(spark, f"{name}-sink"), scratch_path(spark, f"{name}-ckpt")
