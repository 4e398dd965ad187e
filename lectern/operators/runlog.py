"""Run events and manifests folded into states, gauges and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lectern import schemas as S
from lectern.operators import ordered

# What each event means for its run.
STATUS_AFTER = {
    "run_queued": "queued", "run_started": "running", "run_finished": "completed",
    "run_failed": "failed", "stage_waiting": "waiting", "stage_started": "running",
    "stage_finished": "running", "stage_failed": "failed",
}
SETS_STAGE = ("stage_waiting", "stage_started", "stage_failed")
CLEARS_STAGE = ("stage_finished", "run_finished")
SLOT_DELTAS = {
    "local_slot_acquired": ("local", 1), "local_slot_released": ("local", -1),
    "external_task_started": ("external_api", 1), "external_task_finished": ("external_api", -1),
    "external_task_failed": ("external_api", -1),
}


def _status_after(event: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, status in STATUS_AFTER.items():
        out = F.when(event == name, status).otherwise(out)
    return out


def run_states(events: DataFrame, run: str = "run_id") -> DataFrame:
    """H1: latest state per run; order comes from ``seq``, not arrival.

    Every field is a max_by with map-side combine, so a run with very many
    events needs no special care. Also valid on a stream.
    """
    event, seq = F.col("event"), F.col("seq")
    clears = event.isin(*CLEARS_STAGE)
    place = F.when(event.isin(*SETS_STAGE) | clears, F.struct(
        F.when(~clears, F.col("stage")).alias("stage"),
        F.when(~clears, F.col("resource")).alias("resource"),
    ))
    ends = event.isin("run_finished", "run_failed")

    def last(value: Column, when: Column) -> Column:
        return F.max_by(value, F.when(when, seq))

    return events.groupBy(run).agg(
        F.coalesce(last(_status_after(event), event.isin(*STATUS_AFTER)), F.lit("queued")).alias("status"),
        last(place, place.isNotNull()).alias("_place"),
        last(F.col("message"), F.coalesce(F.col("message"), F.lit("")) != "").alias("last_message"),
        last(F.col("ts"), event == "run_started").alias("started_at"),
        F.max_by("ts", "seq").alias("updated_at"),
        last(F.col("ts"), ends).alias("finished_at"),
        F.max("seq").alias("last_seq"),
    ).select(
        run, "status", F.col("_place.stage").alias("current_stage"), F.col("_place.resource").alias("resource"),
        "last_message", "started_at", "updated_at", "finished_at", "last_seq",
    )


def _class(status: Column) -> Column:
    return F.when(status.isin("queued", "completed", "failed"), status).otherwise("running")


def fleet_summary(states: DataFrame) -> DataFrame:
    """H2: one row of counts; whatever is not queued, completed or failed runs."""
    cls = _class(F.col("status"))
    return states.select(cls.alias("c")).agg(
        F.count(F.lit(1)).alias("total_runs"),
        *[F.count_if(F.col("c") == n).alias(f"{n}_runs") for n in ("queued", "running", "completed", "failed")],
    )


def fleet_members(states: DataFrame, run: str = "run_id") -> DataFrame:
    """H2 id lists as rows (class, run), in order; never gathered in one value."""
    return states.select(_class(F.col("status")).alias("class"), run).orderBy("class", run)


def slot_deltas(events: DataFrame) -> DataFrame:
    resource = F.lit(None).cast("string")
    delta = F.lit(None).cast("int")
    for name, (res, step) in SLOT_DELTAS.items():
        resource = F.when(F.col("event") == name, res).otherwise(resource)
        delta = F.when(F.col("event") == name, step).otherwise(delta)
    return events.filter(F.col("event").isin(*SLOT_DELTAS)).select(
        "seq", resource.alias("resource"), delta.alias("delta")
    )


def slots_in_use(deltas: DataFrame, keys=("resource",), **kw) -> DataFrame:
    """H3: slots in use after each event, never below zero.

    There are only a few resources, so each holds a large share of the log:
    the sliced running sums do the work.
    """
    return ordered.clamped_level(deltas, list(keys), "seq", "delta", "in_use", **kw)


def _instant(value: Column) -> Column:
    text = F.trim(value)
    iso = r"\A\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?\z"
    return F.when(text.rlike(iso), text.try_cast("timestamp"))


def stage_durations(manifests: DataFrame, now: Column | None = None) -> DataFrame:
    """H4: seconds from start to finish (or now); unreadable or negative is 0."""
    start = _instant(F.col("started_at"))
    end = F.when(F.col("finished_at").isNull(), now if now is not None else F.current_timestamp()).otherwise(
        _instant(F.col("finished_at"))
    )
    seconds = (F.unix_micros(end) - F.unix_micros(start)) / 1e6
    return manifests.withColumn("duration_s", F.coalesce(F.greatest(F.lit(0.0), seconds), F.lit(0.0)))


def batch_outcome(states: DataFrame) -> DataFrame:
    """H5: succeeded / failed / total."""
    return states.agg(
        F.count_if(F.col("status") != "failed").alias("succeeded"),
        F.count_if(F.col("status") == "failed").alias("failed"), F.count(F.lit(1)).alias("total"),
    )


def failures(states: DataFrame, run: str = "run_id") -> DataFrame:
    return states.filter(F.col("status") == "failed").select(run, "last_message")


def finished_status(results: DataFrame, run: str = "run_id") -> DataFrame:
    """H5: a run whose stages were all dry runs is a dry run."""
    return results.groupBy(run).agg(
        F.when(F.bool_and(F.col("status") == "dry_run"), "dry_run").otherwise("completed").alias("status")
    )


def stage_range(first: str, last: str) -> list[str]:
    i, j = S.STAGES.index(first), S.STAGES.index(last)
    if i > j:
        raise ValueError(f"Invalid stage range: {first} > {last}")
    return list(S.STAGES[i:j + 1])


def stage_matrix(
    manifests: DataFrame, run: str = "run_id", first: str = "s01", last: str = "s10"
) -> DataFrame:
    """H6: run x stage -> last status. The stage list is fixed, so no extra pass."""
    stages = stage_range(first, last)
    return manifests.filter(F.col("stage").isin(*stages)).groupBy(run).agg(*[
        F.max_by("status", F.when(F.col("stage") == s, F.col("finished_at"))).alias(s) for s in stages
    ])
