"""Streams fed in several files must end where the batch operators end."""

import glob
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from lectern import schemas as S
from lectern.catalog import QUERIES
from lectern.operators import runlog as rl
from lectern.streaming import live

KINDS = ["run_queued", "run_started", "stage_waiting", "stage_started", "stage_finished", "progress",
         "stage_failed", "run_failed", "run_finished", *rl.SLOT_DELTAS]


def log(make, n=200, seed=1):
    rng = random.Random(seed)
    rows = []
    for seq in range(1, n):
        kind = rng.choice(KINDS)
        staged = kind.startswith("stage")
        rows.append((seq, kind, "/in/a.wav", rng.choice("abc"), 1, 3, f"s0{rng.randint(1, 9)}" if staged else None,
                     "local_heavy" if staged else None, None, rng.choice([None, "", f"m{seq}"]), None))
    df = make(rows, "seq LONG, event STRING, audio_path STRING, run_dir STRING, run_index INT, total_runs INT, stage STRING, resource STRING, status STRING, message STRING, task_label STRING")
    return df.withColumn("ts", F.timestamp_seconds("seq"))


def loop_states(rows):
    out = {}
    for e in rows:
        s = out.setdefault(e.run_dir, dict(status="queued", stage=None, resource=None, message=None, start=None, end=None))
        s["at"] = e.ts
        s["message"] = e.message or s["message"]
        s["status"] = rl.STATUS_AFTER.get(e.event, s["status"])
        if e.event == "run_started":
            s["start"] = e.ts
        if e.event in ("run_finished", "run_failed"):
            s["end"] = e.ts
        if e.event in ("stage_waiting", "stage_started", "stage_failed"):
            s["stage"], s["resource"] = e.stage, e.resource
        if e.event in ("stage_finished", "run_finished"):
            s["stage"] = s["resource"] = None
    return out


def as_dict(states):
    return {r.run_dir: dict(status=r.status, stage=r.current_stage, resource=r.resource, message=r.last_message,
                            start=r.started_at, end=r.finished_at, at=r.updated_at) for r in states.collect()}


def feed(df, folder, pieces):
    for i, cond in enumerate(pieces):
        df.filter(cond).coalesce(1).write.json(f"{folder}/{i}")


def test_states_batch_and_live(spark, make, tmp_path):
    df = log(make)
    want = loop_states(df.orderBy("seq").collect())
    assert as_dict(rl.run_states(df, "run_dir")) == want
    # Later events arrive first: only seq decides.
    feed(df, tmp_path / "in", ["seq > 120", "seq <= 60", "seq > 60 and seq <= 120"])
    stream = live.read_events(spark, str(tmp_path / "in" / "*"), maxFilesPerTrigger=1)
    live.live_states(stream, f"{tmp_path}/out", f"{tmp_path}/ck", "run_dir", once=True).awaitTermination()
    assert as_dict(live.current_states(spark, f"{tmp_path}/out", "run_dir")) == want
    live.compact_states(spark, f"{tmp_path}/out", f"{tmp_path}/small", "run_dir")
    assert as_dict(live.current_states(spark, f"{tmp_path}/small", "run_dir")) == want
    summary = rl.fleet_summary(rl.run_states(df, "run_dir")).head()
    assert summary.total_runs == 3 == sum(summary[1:])


def test_states_over_two_checkpoints_and_late_events(spark, make, tmp_path):
    events, late = log(make, 120), log(make, 120).filter("seq % 7 = 3")
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    start = lambda ck, **kw: live.live_states(
        live.read_events(spark, src, events.schema, "parquet", **kw), out, f"{tmp_path}/{ck}", "run_dir", once=True).awaitTermination()
    for low, high in ((60, 200), (0, 60)):  # the newest events come first
        events.filter(f"seq % 7 <> 3 AND seq >= {low} AND seq < {high}").coalesce(1).write.mode("append").parquet(src)
        start("ck")
    late.coalesce(1).write.mode("append").parquet(src)
    start("ck")
    want = as_dict(rl.run_states(events, "run_dir"))
    assert as_dict(live.current_states(spark, out, "run_dir")) == want
    start("anew", maxFilesPerTrigger="1")
    assert as_dict(live.current_states(spark, out, "run_dir")) == want


def test_slots_continue_across_batches(spark, make, tmp_path):
    df = log(make, 300, 2)
    want = {}
    level = {"local": 0, "external_api": 0}
    for e in df.orderBy("seq").collect():
        if e.event in rl.SLOT_DELTAS:
            res, step = rl.SLOT_DELTAS[e.event]
            level[res] = max(0, level[res] + step)
            want[e.seq] = level[res]
    assert {r.seq: r.in_use for r in rl.slots_in_use(rl.slot_deltas(df)).collect()} == want
    out, events = str(tmp_path / "out"), f"{tmp_path}/in/*"
    for i, (lo, hi) in enumerate([(0, 100), (100, 101), (101, 300)]):
        df.filter(f"seq > {lo} and seq <= {hi}").coalesce(1).write.json(f"{tmp_path}/in/{i}")
        stream = rl.slot_deltas(live.read_events(spark, events))
        live.live_slots(stream, out, f"{tmp_path}/ck", once=True, slice_rows=16).awaitTermination()
    got = live.slot_levels(spark, out)
    assert {r.seq: r.in_use for r in got.collect()} == want
    assert got.filter("late").isEmpty()
    df.filter("event = 'local_slot_acquired'").limit(1).coalesce(1).write.json(f"{tmp_path}/in/9")
    live.live_slots(rl.slot_deltas(live.read_events(spark, events)), out, f"{tmp_path}/ck", once=True).awaitTermination()
    assert live.slot_levels(spark, out).filter("late").count() == 1


def test_progress_lines(make):
    rows = [(1, "run_started", "/in/a.wav", "a", 1, 2, None), (2, "progress", "/in/a.wav", "a", 1, 2, "[s02] chunking audio..."),
            (3, "progress", "/in/a.wav", "a", 1, 2, None), (4, "stage_started", "/in/a.wav", "a", 1, 2, "x"), (5, "run_failed", "/in/a.wav", "a", 1, 2, "boom")]
    df = make(rows, "seq LONG, event STRING, audio_path STRING, run_dir STRING, run_index INT, total_runs INT, message STRING")
    assert [r.line for r in live.progress_lines(df).orderBy("seq").collect()] == [
        "[run-batch] file 1/2: /in/a.wav", "[run-batch][a] [s02] chunking audio...", "[run-batch] failed for /in/a.wav: boom"]


def test_new_arrivals_keep_old_ids(spark, make, tmp_path):
    ids, done = f"{tmp_path}/ids", f"{tmp_path}/done"

    def process(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{done}/epoch={epoch}")

    def run(*paths, checkpoint="ck"):
        make([(p,) for p in paths], "path STRING").coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        stream = live.read_events(spark, f"{tmp_path}/in", "path STRING")
        live.pick_up_new(stream, ids, f"{tmp_path}/{checkpoint}", process).awaitTermination()
        return {r.path: r.run_id for r in live.assigned_ids(spark, ids).collect()}

    first = run("/in/b/alpha.wav", "/in/c/alpha.wav")
    assert first == {"/in/b/alpha.wav": "alpha", "/in/c/alpha.wav": "alpha-2"}
    assert run("/in/a/alpha.wav", "/in/b/alpha.wav") == {**first, "/in/a/alpha.wav": "alpha-3"}
    assert spark.read.parquet(done).count() == 3
    both = {**first, "/in/a/alpha.wav": "alpha-3", "/in/d/alpha.wav": "alpha-4"}
    assert run("/in/d/alpha.wav", checkpoint="ck2") == both  # a new checkpoint keeps every id


def test_outcomes_and_matrix(make):
    states = make([("a", "completed", None), ("b", "failed", "boom")], "run_id STRING, status STRING, last_message STRING")
    assert tuple(rl.batch_outcome(states).head()) == (1, 1, 2)
    assert [tuple(r) for r in rl.failures(states).collect()] == [("b", "boom")]
    m = make([("r", "s01", "success", "2024-01-01T00:00:00+00:00", "2024-01-01T00:00:05.5Z"), ("r", "s02", "failed", "soon", "2024-01-01T00:00:05Z"),
              ("r", "s01", "skipped", "2024-01-02T00:00:00Z", "2024-01-01T00:00:00Z")],
             "run_id STRING, stage STRING, status STRING, started_at STRING, finished_at STRING")
    assert [r.duration_s for r in rl.stage_durations(m).collect()] == [5.5, 0.0, 0.0]
    row = rl.stage_matrix(m, first="s01", last="s03").head()
    assert (row.s01, row.s02, row.s03) == ("success", "failed", None)
    try:
        rl.stage_range("s05", "s02")
    except ValueError as e:
        assert "Invalid stage range" in str(e)
    else:
        raise AssertionError("reversed range must fail")
    assert S.STAGES[0] == "s01"


@pytest.mark.parametrize("files", [0, 2])
def test_queries_read_tables_of_one_file_and_of_many(spark, make, tmp_path, files):
    rows = [(n, "x", "en", f"src{n % 2}", n) for n in range(9)]
    docs = make(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    docs.coalesce(1).write.parquet(f"{tmp_path}/one")
    if files:
        docs.repartition(files).write.parquet(f"{tmp_path}/sf/documents.parquet")
    else:
        os.mkdir(f"{tmp_path}/sf")
        shutil.copy(glob.glob(f"{tmp_path}/one/part-*.parquet")[0], f"{tmp_path}/sf/documents.parquet")
    got = QUERIES["i4_new_arrivals"](spark, f"{tmp_path}/sf").collect()
    assert {(r.path, r.n_chars) for r in got} == {(f"/in/{n}/src{n % 2}.wav", n) for n in range(9)} and len(got) == 9
