"""H: run states, fleet summaries, slot gauge, durations, matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.catalog.base import query, table
from lectern.operators import runlog as rl

# How the event table stands in for a run log.
_KIND = {"signup": "run_started", "click": "stage_started", "view": "stage_finished", "purchase": "run_finished", "error": "run_failed"}


def renamed(events):
    kind = F.col("event_type")
    for raw, event in _KIND.items():
        kind = F.when(F.col("event_type") == raw, event).otherwise(kind)
    stage = F.format_string("s%02d", F.col("event_id") % 10 + 1)
    return events.select(
        "ts", F.col("event_id").alias("seq"), kind.alias("event"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("run_id"),
        F.when(F.col("event_type").isin("click", "view"), stage).alias("stage"), F.when(F.col("event_type") == "click", "local_heavy").alias("resource"),
        F.when(F.col("value") > 5, F.col("props")).otherwise("").alias("message"))


def _events(spark, sf):
    return renamed(table(spark, sf, "events"))


STATES = """e AS (
  SELECT ts, event_id AS seq, event_type AS k, 'u' || user_id AS run_id, printf('s%02d', event_id % 10 + 1) AS stage, CASE WHEN value > 5 THEN props ELSE '' END AS message FROM events),
states AS (
  SELECT run_id,
    CASE arg_max(k, seq) WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'running' END AS status,
    CASE WHEN arg_max(k, seq) FILTER (WHERE k IN ('click', 'view', 'purchase')) = 'click' THEN arg_max(stage, seq) FILTER (WHERE k = 'click') END AS current_stage,
    CASE WHEN arg_max(k, seq) FILTER (WHERE k IN ('click', 'view', 'purchase')) = 'click' THEN 'local_heavy' END AS resource,
    arg_max(message, seq) FILTER (WHERE message <> '') AS last_message,
    arg_max(ts, seq) FILTER (WHERE k = 'signup') AS started_at, arg_max(ts, seq) AS updated_at,
    arg_max(ts, seq) FILTER (WHERE k IN ('purchase', 'error')) AS finished_at, max(seq) AS last_seq
  FROM e GROUP BY run_id)"""


@query("h1_run_states", f"WITH {STATES} SELECT * FROM states")
def run_states(spark, sf):
    return rl.run_states(_events(spark, sf))


@query("h2_fleet_summary", f"""WITH {STATES} SELECT count(*) AS total_runs, count(*) FILTER (WHERE false) AS queued_runs, count(*) FILTER (WHERE status = 'running') AS running_runs,
  count(*) FILTER (WHERE status = 'completed') AS completed_runs, count(*) FILTER (WHERE status = 'failed') AS failed_runs FROM states""")
def fleet_summary(spark, sf):
    return rl.fleet_summary(rl.run_states(_events(spark, sf)))


@query("h2_fleet_members", f"WITH {STATES} SELECT status AS class, run_id FROM states")
def fleet_members(spark, sf):
    return rl.fleet_members(rl.run_states(_events(spark, sf)))


def deltas(events):
    """Clicks take a slot, views give one back; two resources by user parity."""
    return events.filter(F.col("event_type").isin("click", "view")).select(
        F.col("event_id").alias("seq"), F.when(F.col("user_id") % 2 == 0, "local").otherwise("external_api").alias("resource"),
        F.when(F.col("event_type") == "click", 1).otherwise(-1).alias("delta"))


GAUGE = """g AS (
  SELECT event_id AS seq, CASE WHEN user_id % 2 = 0 THEN 'local' ELSE 'external_api' END AS resource, CASE event_type WHEN 'click' THEN 1 ELSE -1 END AS d
  FROM events WHERE event_type IN ('click', 'view')),
s AS (SELECT *, sum(d) OVER (PARTITION BY resource ORDER BY seq) AS s FROM g),
levels AS (SELECT seq, resource, s - least(0, min(s) OVER (PARTITION BY resource ORDER BY seq)) AS in_use FROM s)"""


def _gauge(**kw):
    return lambda spark, sf: rl.slots_in_use(deltas(table(spark, sf, "events")), **kw).select("seq", "resource", "in_use")


query("h3_slots_in_use", f"WITH {GAUGE} SELECT seq, resource, in_use::BIGINT AS in_use FROM levels")(_gauge())
query("h3_slots_in_use_sliced", f"WITH {GAUGE} SELECT seq, resource, in_use::BIGINT AS in_use FROM levels")(_gauge(slice_rows=500))


@query("h4_stage_durations", """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber = 3 THEN 0 ELSE greatest(0, epoch(l_shipdate) - epoch(o_orderdate)) END::DOUBLE AS duration_s
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def stage_durations(spark, sf):
    """From order to shipping; every third line has an unreadable start."""
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    shown = rows.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_linenumber") == 3, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")).alias("started_at"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("finished_at"))
    return rl.stage_durations(shown).drop("started_at", "finished_at")


@query("h5_batch_outcome", f"WITH {STATES} SELECT count(*) FILTER (WHERE status <> 'failed') AS succeeded, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) AS total FROM states")
def batch_outcome(spark, sf):
    return rl.batch_outcome(rl.run_states(_events(spark, sf)))


@query("h5_failures", f"WITH {STATES} SELECT run_id, last_message FROM states WHERE status = 'failed'")
def failures(spark, sf):
    return rl.failures(rl.run_states(_events(spark, sf)))


@query("h5_finished_status", "SELECT o_custkey AS run_id, CASE WHEN bool_and(o_orderstatus = 'F') THEN 'dry_run' ELSE 'completed' END AS status FROM orders GROUP BY o_custkey")
def finished_status(spark, sf):
    return rl.finished_status(table(spark, sf, "orders").select(
        F.col("o_custkey").alias("run_id"), F.when(F.col("o_orderstatus") == "F", "dry_run").otherwise("success").alias("status")))


_STAGES = [f"s{i:02d}" for i in range(5, 10)]


@query("h6_stage_matrix", "SELECT o_custkey AS run_id, " + ", ".join(
    f"arg_max(o_orderstatus, (o_orderdate, o_orderkey)) FILTER (WHERE o_orderkey % 5 + 5 = {int(s[1:])}) AS {s}" for s in _STAGES) + " FROM orders GROUP BY o_custkey")
def stage_matrix(spark, sf):
    manifests = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("run_id"), F.format_string("s%02d", F.col("o_orderkey") % 5 + 5).alias("stage"),
        F.col("o_orderstatus").alias("status"), F.struct("o_orderdate", "o_orderkey").alias("finished_at"))
    return rl.stage_matrix(manifests, first="s05", last="s09")
