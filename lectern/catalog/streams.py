"""I: the same views kept by Structured Streaming; results equal the batch ones."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lectern.catalog import logs
from lectern.catalog.base import query, table
from lectern.session import shared_folder
from lectern.streaming import live


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


def _stream(spark, sf, name):
    """A table as a file stream, be it one file or a folder of part files. The pattern matches its name only:
    as a plain path a single file would be taken for the base folder."""
    schema = table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.[p]arquet")


@query("i1_live_states", f"WITH {logs.STATES} SELECT * FROM states")
def live_states(spark, sf):
    out = _folder(spark)
    live.live_states(logs.renamed(_stream(spark, sf, "events")), f"{out}/states", f"{out}/log", once=True).awaitTermination()
    return live.current_states(spark, f"{out}/states")


@query("i2_live_slots", f"WITH {logs.GAUGE} SELECT seq, resource, in_use::BIGINT AS in_use FROM levels")
def live_slots(spark, sf):
    out = _folder(spark)
    live.live_slots(logs.deltas(_stream(spark, sf, "events")), out, f"{out}/log", once=True).awaitTermination()
    return live.slot_levels(spark, out).select("seq", "resource", "in_use")


@query("i3_progress_feed", """SELECT event_id AS seq, CASE event_type
    WHEN 'signup' THEN '[run-batch] file ' || event_id % 100 || '/' || 100 || ': /in/' || user_id || '.wav'
    WHEN 'click' THEN '[run-batch][u' || user_id || '] ' || props ELSE '[run-batch] failed for /in/' || user_id || '.wav: ' || props END AS line
FROM events WHERE event_type IN ('signup', 'click', 'error')""")
def progress_feed(spark, sf):
    out = _folder(spark)
    kind = F.when(F.col("event_type") == "signup", "run_started").when(F.col("event_type") == "click", "progress").when(
        F.col("event_type") == "error", "run_failed").otherwise("other")
    user = F.col("user_id").cast("string")
    events = _stream(spark, sf, "events").select(
        F.col("event_id").alias("seq"), kind.alias("event"), (F.col("event_id") % 100).cast("int").alias("run_index"), F.lit(100).alias("total_runs"),
        F.concat(F.lit("/in/"), user, F.lit(".wav")).alias("audio_path"), F.concat(F.lit("u"), user).alias("run_dir"), F.col("props").alias("message"))
    writer = live.progress_lines(events).writeStream.outputMode("append").option("checkpointLocation", f"{out}/log").trigger(availableNow=True)
    writer.format("parquet").start(f"{out}/lines").awaitTermination()
    return spark.read.parquet(f"{out}/lines")


@query("i4_new_arrivals", """SELECT '/in/' || doc_id || '/' || source || '.wav' AS path, n_chars FROM documents""")
def new_arrivals(spark, sf):
    """Documents arriving as recordings: each is processed once, with an id."""
    out = _folder(spark)
    arrivals = _stream(spark, sf, "documents").select(
        F.concat(F.lit("/in/"), F.col("doc_id").cast("string"), F.lit("/"), F.col("source"), F.lit(".wav")).alias("path"), "n_chars")

    def process(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{out}/done/epoch={epoch}")

    for _ in range(2):  # the second run finds nothing new
        live.pick_up_new(arrivals, f"{out}/ids", f"{out}/log", process).awaitTermination()
    done = spark.read.option("basePath", f"{out}/done").parquet(f"{out}/done")
    return done.filter("run_id IS NOT NULL").select("path", "n_chars")
