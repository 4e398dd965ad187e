"""Live views over the event log with Structured Streaming.

Each view appends one folder per micro-batch (``epoch=N``; for states and ids below
``stream=ID``, so that a stream with a new checkpoint overwrites nothing) and overwrites
that folder when a batch is retried, so results are exactly-once. Readers take the
newest row per key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lectern import schemas as S
from lectern.operators import incremental, ordered, runlog


def read_events(spark: SparkSession, path: str, schema=S.EVENTS, fmt: str = "json", **options) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def _start(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str, once: bool) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps over restarts from its checkpoint."""
    return spark.read.json(f"{checkpoint}/metadata").head()["id"]


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.option("basePath", path).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


# -- I1 ---------------------------------------------------------------------


def live_states(events: DataFrame, path: str, checkpoint: str, run: str = "run_id", once: bool = False) -> StreamingQuery:
    """Run states kept up to date; only changed runs are written.

    A stream that starts anew with another checkpoint reads the log from its start. Until it has caught up,
    the states that know a later event stay in force; of states that know the same last event, that
    written last counts, since late events change a state without a new last one.
    """
    def upsert(changed: DataFrame, epoch: int) -> None:
        folder = f"{path}/stream={_stream_id(changed.sparkSession, checkpoint)}/epoch={epoch}"
        changed.withColumn("written_at", F.current_timestamp()).write.mode("overwrite").parquet(folder)

    return _start(runlog.run_states(events, run), checkpoint, upsert, "update", once)


def current_states(spark: SparkSession, path: str, run: str = "run_id") -> DataFrame:
    """Newest state per run; feed it to fleet_summary for the live counts."""
    rows = spark.read.option("basePath", path).parquet(path)
    rest = [c for c in rows.columns if c not in (run, "stream", "epoch", "written_at")]
    return rows.groupBy(run).agg(
        F.max_by(F.struct(*rest), F.struct("last_seq", "written_at", "epoch")).alias("s")).select(run, "s.*")


def compact_states(spark: SparkSession, path: str, into: str, run: str = "run_id") -> None:
    """Rewrite the newest states to a fresh folder, as epoch 0 of a stream of its own. The stream that
    wrote ``path`` can go on into the fresh folder."""
    current_states(spark, path, run).withColumn("written_at", F.current_timestamp()).write.mode("error").parquet(
        f"{into}/stream=compacted/epoch=0")


# -- I2 ---------------------------------------------------------------------


def live_slots(deltas: DataFrame, path: str, checkpoint: str, once: bool = False, **kw) -> StreamingQuery:
    """Slots in use, clamped at zero, continued across micro-batches.

    The running level of a micro-batch is the sliced batch operator started
    from the last level, so a resource with most of the events still spreads
    over all tasks. Only one small row per resource is carried. Events whose
    ``seq`` is behind the last one seen are applied on arrival and marked late.
    """
    spark = deltas.sparkSession
    state_path, level_path = f"{path}/state", f"{path}/levels"

    def apply(batch: DataFrame, epoch: int) -> None:
        # Every batch leaves the full state, so the one before is all it takes.
        carry = _table(spark, f"{state_path}/epoch={epoch - 1}") if epoch else None
        if epoch and carry is None:
            raise RuntimeError(f"{state_path}/epoch={epoch - 1} is missing; the levels would start at zero")
        start = carry.select("resource", "start_level") if carry is not None else None
        levels = ordered.clamped_level(batch, ["resource"], "seq", "delta", "in_use", start=start, **kw)
        if carry is not None:
            levels = levels.join(carry.select("resource", "last_seq"), "resource", "left")
        else:
            levels = levels.withColumn("last_seq", F.lit(None).cast("bigint"))
        levels = levels.withColumn("late", F.coalesce(F.col("seq") <= F.col("last_seq"), F.lit(False))).drop("last_seq")
        levels.write.mode("overwrite").parquet(f"{level_path}/epoch={epoch}")
        done = spark.read.schema(levels.schema).parquet(f"{level_path}/epoch={epoch}")
        ends = done.groupBy("resource").agg(
            F.max_by("in_use", "seq").alias("start_level"), F.max("seq").alias("last_seq")
        )
        if carry is not None:
            ends = ends.join(carry.withColumnRenamed("last_seq", "_was"), "resource", "full_outer").select(
                "resource", F.coalesce(ends["start_level"], carry["start_level"]).alias("start_level"),
                F.greatest("last_seq", "_was").alias("last_seq"),
            )
        ends.write.mode("overwrite").parquet(f"{state_path}/epoch={epoch}")

    return _start(deltas, checkpoint, apply, "append", once)


def slot_levels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", f"{path}/levels").parquet(f"{path}/levels")


# -- I3 ---------------------------------------------------------------------


def progress_lines(events: DataFrame) -> DataFrame:
    """The lines worth showing, as (seq, line). Stateless."""
    event = F.col("event")
    # Line formats.
    line = (
        F.when(event == "run_started", F.concat(
            F.lit("[run-batch] file "), F.col("run_index").cast("string"), F.lit("/"),
            F.col("total_runs").cast("string"), F.lit(": "), F.col("audio_path")))
        .when((event == "progress") & F.col("message").isNotNull(), F.concat(
            F.lit("[run-batch]["), F.col("run_dir"), F.lit("] "), F.col("message")))
        .when(event == "run_failed", F.concat(
            F.lit("[run-batch] failed for "), F.col("audio_path"), F.lit(": "),
            F.coalesce(F.col("message"), F.lit("None"))))
    )
    return events.select("seq", line.alias("line")).filter("line IS NOT NULL")


# -- I4 ---------------------------------------------------------------------


def pick_up_new(
    arrivals: DataFrame, ids_path: str, checkpoint: str,
    process: Callable[[DataFrame, int], None], once: bool = True,
) -> StreamingQuery:
    """I4: only recordings not seen before get an id and are processed.

    ``arrivals(path, ...)`` is a file stream. Ids live under ``ids_path``,
    one folder per stream and micro-batch; earlier ids never change, also when
    a stream starts anew with another checkpoint. A retried micro-batch leaves
    out only the ids that it wrote itself.
    """
    spark = arrivals.sparkSession

    def handle(batch: DataFrame, epoch: int) -> None:
        stream = _stream_id(spark, checkpoint)
        known = _table(spark, ids_path)
        if known is None:
            known = spark.createDataFrame([], "path STRING, run_id STRING")
        else:
            known = known.filter((F.col("stream").cast("string") != stream) | (F.col("epoch") != epoch))
        ids = incremental.assign_run_ids(batch.select("path"), known).filter("is_new").select("path", "run_id")
        folder = f"{ids_path}/stream={stream}/epoch={epoch}"
        ids.write.mode("overwrite").parquet(folder)
        fresh = spark.read.schema("path STRING, run_id STRING").parquet(folder)
        process(batch.join(fresh, "path"), epoch)

    return _start(arrivals, checkpoint, handle, "append", once)


def assigned_ids(spark: SparkSession, ids_path: str) -> DataFrame:
    return spark.read.option("basePath", ids_path).parquet(ids_path).select("path", "run_id")
