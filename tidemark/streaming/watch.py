"""Structured Streaming jobs: champion watcher, champion history, streaming scoring
and streamed windowed counts.

Sources are file streams (Parquet folders); runs use ``availableNow`` so a job
processes what is there and stops, and every sink is a folder below the shared
checkpoint location.  ``foreachBatch`` writers are idempotent: a replayed batch id
rewrites the same output.
"""

from __future__ import annotations

import contextlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import nan_to_null
from tidemark.operators import runs as R
from tidemark.operators.ranges import ROWS_PER_RANGE
from tidemark.operators.ranking import running_max_before
from tidemark.session import ensure_utc, materialize
from tidemark.streaming import monitor


#: Keeps large state (buffered runs, score counts) on disk instead of the executors' heap.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _run(query_builder, checkpoint: str):
    q = query_builder.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


@contextlib.contextmanager
def _disk_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB; the session's choice returns."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, STATE_STORE)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


# --- T1 -------------------------------------------------------------------------------
def _pointer(sess, state_dir: str):
    """``(batch_id, path after that batch, path before it)`` from the ``current`` file,
    or ``None`` before the first batch.  Only a missing file means that; any other failure
    to read it is raised."""
    path = os.path.join(state_dir, "current")
    if not _exists(sess, path):
        return None
    rows = sess.read.text(path).collect()   # one line
    if not rows:
        return None
    bid, after, before = rows[0]["value"].split("\t")
    return int(bid), after, (before or None)


def champion_step(batch: DataFrame, batch_id: int, state_dir: str, metric: str = "f1") -> None:
    """One micro-batch of the watcher: best run per experiment over the stored champion
    and the new runs; a change event per experiment whose champion moved.

    Idempotent by batch id.  Micro-batch ids are consecutive and batch N starts only
    after N-1 committed, so the state before batch N is always ``champion/batch=N-1``:
    a replayed batch compares with the same earlier state and rewrites the same files.
    The ``current`` pointer is written last and only serves readers."""
    sess = batch.sparkSession
    champ_root = os.path.join(state_dir, "champion")
    events_root = os.path.join(state_dir, "events")
    prev_path = os.path.join(champ_root, f"batch={batch_id - 1}") if batch_id > 0 else None
    try:
        prev = sess.read.parquet(prev_path) if prev_path else None
    except Exception as e:   # a gap in the state: refuse rather than restart from nothing
        raise RuntimeError(f"champion state of batch {batch_id - 1} is missing in {champ_root}") from e
    best = R.best_run(batch, metric)
    cand = best if prev is None else best.unionByName(prev.select(*best.columns))
    new = R.best_run(cand, metric)
    out = os.path.join(champ_root, f"batch={batch_id}")
    new.write.mode("overwrite").parquet(out)
    new = sess.read.parquet(out)
    if prev is None:
        ev = new.select(F.lit(batch_id).alias("batch_id"), "experiment_name",
                        F.lit(None).cast("string").alias("old_run_id"), F.col("run_id").alias("new_run_id"))
    else:
        j = new.join(prev.select("experiment_name", F.col("run_id").alias("old_run_id")), "experiment_name", "left")
        ev = j.where(~F.col("run_id").eqNullSafe(F.col("old_run_id"))).select(
            F.lit(batch_id).alias("batch_id"), "experiment_name", "old_run_id", F.col("run_id").alias("new_run_id"))
    ev.write.mode("overwrite").parquet(os.path.join(events_root, f"batch={batch_id}"))
    line = f"{batch_id}\t{out}\t{prev_path or ''}"
    sess.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(
        os.path.join(state_dir, "current"))


def champion_state(spark: SparkSession, state_dir: str, metric: str = "f1") -> tuple[DataFrame, DataFrame]:
    """The stored champion table and every change event (batch id is a column); both are
    empty before the first batch."""
    ptr = _pointer(spark, state_dir)
    if ptr is None:
        return (spark.createDataFrame([], f"experiment_name string, run_id string, {metric} double"),
                spark.createDataFrame([], "batch_id int, experiment_name string, old_run_id string, new_run_id string"))
    champ = spark.read.parquet(ptr[1])
    # events are stored one folder per batch id (batch=N); the id is already a column
    return champ, spark.read.parquet(os.path.join(state_dir, "events")).drop("batch")


def watch_champion(spark: SparkSession, runs_dir: str, state_dir: str, metric: str = "f1",
                   files_per_batch: int = 1) -> tuple[DataFrame, DataFrame]:
    """Stream run-log files; after every micro-batch keep the best run per experiment
    and record an event when it changes (``champion_step``).

    State is two tables in ``state_dir``: ``champion/`` (one row per experiment) and
    ``events/`` (batch id, experiment, old and new run), plus the ``current`` pointer."""
    schema = spark.read.parquet(runs_dir).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(runs_dir)

    def on_batch(batch: DataFrame, batch_id: int):
        champion_step(batch, batch_id, state_dir, metric)

    _run(stream.writeStream.foreachBatch(on_batch), os.path.join(state_dir, "_checkpoint"))
    return champion_state(spark, state_dir, metric)


# --- T2 -------------------------------------------------------------------------------
def champion_history(runs: DataFrame, metric: str = "f1", by=("experiment_name",), order=("start_time", "run_id"),
                     rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Batch form: every run that beats the best earlier run of its experiment
    (running maximum over time ranges, see ``ranking.running_max_before``).  A null or NaN
    metric beats nothing."""
    clean = runs.withColumn(metric, nan_to_null(F.col(metric).cast("double")))
    prev = running_max_before(clean, list(by), list(order), metric, rows_per_range, out="prev_best")
    return prev.where(F.col(metric) > F.coalesce(F.col("prev_best"), F.lit(-1.0)))


def _released(rows: DataFrame, best: DataFrame | None, metric: str) -> tuple[DataFrame, DataFrame]:
    """Records among ``rows``, which follow everything seen before, and the best values
    after them.  The best values so far go in front as rows without a start time."""
    keep = rows.columns
    seeded = rows
    if best is not None:
        blank = [F.lit(None).cast(rows.schema[c].dataType).alias(c) if c not in ("experiment_name", metric) else F.col(c) for c in keep]
        seeded = rows.unionByName(best.select(*blank))
    seeded = materialize(seeded)
    records = champion_history(seeded, metric).where("start_time is not null").select(*keep, "prev_best")
    return records, seeded.groupBy("experiment_name").agg(F.max(nan_to_null(F.col(metric))).alias(metric))


def _history_batch(batch: DataFrame, batch_id: int, out_dir: str, metric: str) -> None:
    """One micro-batch of released runs.  As in ``champion_step`` the state before batch N
    is always that of batch N - 1, so a replayed batch rewrites the same files."""
    sess = batch.sparkSession
    best = sess.read.parquet(os.path.join(out_dir, "best", f"batch={batch_id - 1}")) if batch_id > 0 else None
    records, after = _released(materialize(batch), best, metric)
    records.write.mode("overwrite").parquet(os.path.join(out_dir, "history", f"batch={batch_id}"))
    after.write.mode("overwrite").parquet(os.path.join(out_dir, "best", f"batch={batch_id}"))
    line = f"{batch_id}\t{os.path.join(out_dir, 'best', f'batch={batch_id}')}\t"
    sess.createDataFrame([(line,)], "value string").write.mode("overwrite").text(os.path.join(out_dir, "current"))


def champion_history_stream(spark: SparkSession, runs_dir: str, out_dir: str, metric: str = "f1", delay: str = "1 day",
                            bucket: str = "1 hour", files_per_batch: int = 1) -> DataFrame:
    """Streaming form, for run files that arrive in any order up to ``delay`` late.

    Runs wait in keyed state (RocksDB), spread over (time bucket, run), until the watermark
    has passed their bucket; a bucket is then released and dropped from state.  Released
    runs of all experiments follow everything released before, so each micro-batch is the
    batch history over them with the best values so far in front - ranges and windows over
    many tasks, also for one hot experiment.  Runs later than ``delay`` and runs without a
    start time take no part.

    The result is the released history and, on top, the history of the runs that still
    wait, read from the state as it stands; the latter is not stored, as late runs may
    still change it."""
    ensure_utc(spark)
    schema = spark.read.parquet(runs_dir).schema
    keep = ["experiment_name", "run_id", "run_name", "start_time", metric]
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(runs_dir)
    timed = stream.select(*keep, F.col("start_time").cast("timestamp").alias("_at")).withWatermark("_at", delay)
    waiting = timed.groupBy(F.window("_at", bucket).alias("_bucket"), *keep).agg(F.count(F.lit(1)).alias("_n")).select(*keep)
    checkpoint = out_dir.rstrip("/") + "_checkpoint"
    with _disk_state(spark):
        _run(waiting.writeStream.outputMode("append").foreachBatch(lambda b, i: _history_batch(b, i, out_dir, metric)), checkpoint)
    released = spark.read.parquet(os.path.join(out_dir, "history")).drop("batch")
    _, best_path, _ = _pointer(spark, out_dir)
    state = spark.read.format("statestore").load(checkpoint)
    open_runs = materialize(state.select(*[F.col("key").getField(c).alias(c) for c in keep]))
    records, _ = _released(open_runs, spark.read.parquet(best_path), metric)
    return released.unionByName(records)


# --- T3 -------------------------------------------------------------------------------
def score_stream(spark: SparkSession, in_dir: str, out_dir: str, score_fn, key: str = "row_key",
                 time_col: str = "arrived_at", watermark: str = "1 day",
                 files_per_batch: int = 1000) -> DataFrame:
    """Score customers as their rows arrive; a key seen again within the watermark is
    dropped (bounded state, unlike a plain ``dropDuplicates``), whether the copies share
    a micro-batch or not.  ``files_per_batch`` sizes each micro-batch."""
    ensure_utc(spark)
    schema = spark.read.parquet(in_dir).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(in_dir)
    d = stream.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, watermark)
    scored = score_fn(d.dropDuplicatesWithinWatermark([key]))
    _run(scored.writeStream.format("parquet").option("path", out_dir).outputMode("append"),
         out_dir.rstrip("/") + "_checkpoint")
    return spark.read.parquet(out_dir)


# --- T4 (stream) ----------------------------------------------------------------------
def windowed_metrics_stream(spark: SparkSession, events_dir: str, glob: str, enrich, out_dir: str, width: str = "7 days",
                            slide: str | None = None, watermark: str = "1 day", label: str = "churn", pred: str = "pred",
                            score: str = "proba", files_per_batch: int = 1000) -> DataFrame:
    """Event file stream -> enrich (e.g. a stream-static join with scores) -> all metrics of
    ``monitor.windowed_metrics``, ROC AUC and average precision included, for every window
    that the watermark has closed.

    State holds a row count per (window, score, label, prediction), spread over many keys,
    in RocksDB.  When the watermark passes a window's end its counts are released together
    (append mode) and dropped from state; a micro-batch turns the windows it closes into
    their final metrics, one folder per batch, rewritten if the batch is replayed.  Events
    later than the watermark, and windows still open, are not in the result."""
    schema = spark.read.parquet(os.path.join(events_dir, glob)).schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", glob)
              .option("maxFilesPerTrigger", files_per_batch).parquet(events_dir))
    timed = enrich(monitor.event_time(stream)).withWatermark("event_time", watermark)
    counts = monitor.window_score_counts(timed, width, slide, label, pred, score)

    def close(batch: DataFrame, batch_id: int):
        done = monitor.metrics_of_counts(materialize(batch), label, pred, score)
        done.write.mode("overwrite").parquet(os.path.join(out_dir, f"batch={batch_id}"))

    with _disk_state(spark):
        _run(counts.writeStream.outputMode("append").foreachBatch(close), out_dir.rstrip("/") + "_checkpoint")
    if not _exists(spark, out_dir):     # no event came
        close(spark.createDataFrame([], counts.schema), 0)
    return spark.read.parquet(out_dir).drop("batch")


def windowed_counts_stream(spark: SparkSession, events_dir: str, glob: str, enrich, out_dir: str,
                           width: str = "7 days", watermark: str = "1 day",
                           files_per_batch: int = 1000) -> DataFrame:
    """Event file stream -> enrich (e.g. a stream-static join with scores) -> windowed
    confusion counts.  The running result is rewritten per micro-batch (complete mode
    through ``foreachBatch``), so the folder always holds the latest counts."""
    schema = spark.read.parquet(os.path.join(events_dir, glob)).schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", glob)
              .option("maxFilesPerTrigger", files_per_batch).parquet(events_dir))
    counts = monitor.windowed_counts(enrich(monitor.event_time(stream)), width, watermark=watermark)

    def write(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(out_dir)

    _run(counts.writeStream.outputMode("complete").foreachBatch(write), out_dir.rstrip("/") + "_checkpoint")
    return spark.read.parquet(out_dir)
