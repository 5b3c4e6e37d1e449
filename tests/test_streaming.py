"""Champion watcher (T1): change events per batch, a better run arriving late, and a
batch delivered twice."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import score
from tidemark.streaming import monitor
from tidemark.streaming import watch as W

SCHEMA = "experiment_name string, run_id string, f1 double"


def _events(spark, state):
    _, ev = W.champion_state(spark, state)
    return sorted((r.batch_id, r.old_run_id, r.new_run_id) for r in ev.collect())


def test_watch_champion_late_better_run(spark, tmp_path):
    runs = str(tmp_path / "runs")
    for rows in ([("e", "a", 0.5)], [("e", "b", 0.4)], [("e", "c", 0.7), ("e", "d", 0.0)]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(runs)
    champ, ev = W.watch_champion(spark, runs, str(tmp_path / "state"))
    assert [(r.run_id, r.f1) for r in champ.collect()] == [("c", 0.7)]
    assert sorted((r.batch_id, r.old_run_id, r.new_run_id) for r in ev.collect()) == [(0, None, "a"), (2, "a", "c")]


def test_champion_step_replay_is_idempotent(spark, tmp_path):
    state = str(tmp_path / "state")
    b0 = spark.createDataFrame([("e", "a", 0.5), ("f", "x", 0.2)], SCHEMA)
    b1 = spark.createDataFrame([("e", "b", 0.4)], SCHEMA)
    b2 = spark.createDataFrame([("e", "c", 0.7), ("f", "y", 0.1)], SCHEMA)
    for i, b in enumerate((b0, b1, b2)):
        W.champion_step(b, i, state)
    first = _events(spark, state)
    # batch 2 delivered again after it had already moved the pointer
    W.champion_step(b2, 2, state)
    assert _events(spark, state) == first == [(0, None, "a"), (0, None, "x"), (2, "a", "c")]
    champ, _ = W.champion_state(spark, state)
    assert sorted((r.experiment_name, r.run_id) for r in champ.collect()) == [("e", "c"), ("f", "x")]
    assert os.path.isdir(os.path.join(state, "champion", "batch=2"))


def _write(spark, rows, schema, folder):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_champion_history_stream_with_late_files(spark, tmp_path):
    """Run files in shuffled order, some days late, equal times and scores, null and NaN
    scores: the stream ends at the batch history; runs beyond the delay are left out."""
    rnd = random.Random(5)
    schema = "experiment_name string, run_id string, run_name string, start_time timestamp_ntz, f1 double"
    start = datetime.datetime(2024, 1, 1)
    rows = []
    for i in range(300):
        at = start + datetime.timedelta(hours=rnd.randint(0, 24 * 40))
        f1 = rnd.choice([None, float("nan"), round(rnd.random() * (1 + i / 900), 2), round(rnd.random(), 2)])
        rows.append((rnd.choice("aab"), f"r{i:03d}", "n", at, f1))
    late = {r[1]: r[3] + datetime.timedelta(days=rnd.random() * 2.5) for r in rows}       # arrival
    order = sorted(rows, key=lambda r: late[r[1]])
    folder = str(tmp_path / "runs")
    for k in range(0, 300, 60):
        _write(spark, rnd.sample(order[k:k + 60], 60), schema, folder)
    _write(spark, [("a", "too-late", "n", start - datetime.timedelta(days=50), 0.99), ("b", "no-time", "n", None, 0.99)], schema, folder)
    out = str(tmp_path / "out")
    got = W.champion_history_stream(spark, folder, out, delay="3 days", bucket="1 hour")
    want = W.champion_history(spark.createDataFrame(rows, schema))
    key = lambda d: sorted((r["experiment_name"], r["start_time"], r["run_id"], r["f1"], r["prev_best"] is None or r["prev_best"])
                           for r in d.collect())
    assert key(got) == key(want)
    # most of it was final before the end, in several batches, and left the state
    stored = spark.read.parquet(os.path.join(out, "history"))
    assert stored.select("batch").distinct().count() > 1
    assert spark.read.format("statestore").load(out + "_checkpoint").count() < 100
    # more files continue from the stored state
    more = [("a", "x1", "n", start + datetime.timedelta(days=41), 1.5), ("b", "x2", "n", start + datetime.timedelta(days=60), 1.7)]
    _write(spark, more, schema, folder)
    got = W.champion_history_stream(spark, folder, out, delay="3 days", bucket="1 hour")
    assert key(got) == key(W.champion_history(spark.createDataFrame(rows + more, schema)))


def test_windowed_metrics_stream_closes_windows(spark, tmp_path):
    """Closed windows equal the batch metrics, late events within the watermark included;
    the others wait, and closed windows leave the state."""
    rnd = random.Random(6)
    schema = "ts timestamp_ntz, churn int, proba double"
    start = datetime.datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        p = rnd.choice([None, float("nan"), round(rnd.random(), 1), 0.5])
        rows.append((start + datetime.timedelta(hours=i * 1.5), int(rnd.random() < 0.4), p))
    # the last two events of a slice arrive with the next one
    slices = [rows[max(0, k - 2):k + (120 if k == 480 else 118)] for k in range(0, 600, 120)]
    folder = str(tmp_path / "events")
    for s in slices:
        _write(spark, s, schema, folder)
    enrich = lambda d: score.apply_threshold(d, 0.5)
    out = str(tmp_path / "out")
    got = W.windowed_metrics_stream(spark, folder, "*.parquet", enrich, out, width="2 days", files_per_batch=1)
    want = monitor.windowed_metrics(enrich(monitor.event_time(spark.createDataFrame(rows, schema))), "2 days")
    last = max(r[0] for r in rows) - datetime.timedelta(days=1)
    cols = ["window_start", "tp", "fp", "tn", "fn", "n", "f1", "roc_auc", "pr_ap"]
    closed = [tuple(r) for r in want.where(F.col("window_end").cast("timestamp_ntz") <= F.lit(last)).select(*cols).collect()]
    assert len(closed) >= 15
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(closed)
    state = spark.read.format("statestore").load(out + "_checkpoint")
    assert state.select(F.col("key.window.start")).distinct().count() == want.count() - len(closed)


def test_champion_state_before_the_first_batch(spark, tmp_path):
    champ, events = W.champion_state(spark, str(tmp_path / "none"))
    assert champ.count() == events.count() == 0
    os.makedirs(tmp_path / "bad" / "current")
    (tmp_path / "bad" / "current" / "part-0.txt").write_text("no pointer")
    with pytest.raises(ValueError):
        W.champion_state(spark, str(tmp_path / "bad"))
