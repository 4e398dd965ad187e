"""Stages that do only what is new: signatures, choice of work, policy, the stage, outputs, manifests.

One folder holds what all passes leave: ``texts`` and ``calls`` (the newest per run and stage) and
``manifests`` (appended, the latest outcome counts). Outputs are stored before manifests, so a pass that is
lost between the two does those runs again; with a reply ledger that repeats no paid call.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.operators import incremental as inc, ordered
from lectern.plans.stages import ModelSetup, StageResult
from lectern.session import write_and_read
from lectern.sources import sinks

KEYS = ["run_id", "stage"]
MANIFESTS = (
    "run_id STRING, stage STRING, status STRING, started_at STRING, finished_at STRING, "
    "params MAP<STRING,STRING>, inputs_signature STRING, outputs_signature STRING, error STRING"
)

Work = Callable[[DataFrame], StageResult]


@dataclass(frozen=True)
class Step:
    """One stage: what it does with the texts of some runs, and what its result depends on beside them."""

    stage: str
    work: Work
    params: dict[str, str]


@dataclass(frozen=True)
class Pass:
    """What one pass did: its manifests, one per run, and the calls it made (None where no run had work)."""

    manifests: DataFrame
    calls: DataFrame | None


def model_params(setup: ModelSetup, *templates: str) -> dict[str, str]:
    """Parameters of a model stage: another model, temperature or template is new work, a cap is not."""
    digest = hashlib.sha256("\0".join(templates).encode()).hexdigest()
    return {"model": setup.model, "provider": setup.provider, "temperature": str(float(setup.temperature)), "templates": digest}


def signed(texts: DataFrame, stage: str) -> DataFrame:
    """run_id, stage, inputs_signature of the texts of each run; a null text counts as missing."""
    named = ["run_id", "part"] if "part" in texts.columns else ["run_id"]
    files = texts.select("run_id", F.concat_ws("/", *[F.col(c).cast("string") for c in named]).alias("path"), "text")
    files = write_and_read(files.select("run_id", "path", F.sha2("text", 256).alias("sha256")), "digests")
    return inc.input_signatures(files.withColumn("stage", F.lit(stage)), files)


def stored_manifests(spark: SparkSession, folder: str) -> DataFrame | None:
    return sinks.read_table(spark, f"{folder}/manifests", MANIFESTS)


def stored_texts(spark: SparkSession, folder: str, stage: str) -> DataFrame | None:
    """run_id, part, text, stage: the newest outputs of a stage."""
    texts = sinks.read_table(spark, f"{folder}/texts")
    return None if texts is None else texts.filter(F.col("stage") == stage).drop(sinks.BUCKET)


def run_stage(
    texts: DataFrame, step: Step, folder: str, *, on_exists: str = "overwrite", force: bool = False, dry_run: bool = False,
    buckets: int = sinks.BUCKETS,
) -> Pass:
    """Do a stage for the runs whose texts or parameters changed since their last success.

    Of those, ``on_exists`` decides where outputs are stored already: overwrite does them again, skip leaves
    them, fail stops before any call. ``force`` takes every run as changed; ``dry_run`` only notes what
    would be done. Outputs stand in ``buckets`` folders a stage, the same number in every pass. ``texts``: run_id, text and, where a run has several rows, part. Runs are named: a
    null run_id is an error. A run that the stage rejects is 'failed' and keeps its older outputs.
    """
    if on_exists not in ("overwrite", "skip", "fail"):
        raise ValueError(f"unknown policy '{on_exists}'")
    spark, started = texts.sparkSession, _now()
    if texts.filter(F.col("run_id").isNull()).head() is not None:
        raise ValueError("run_id is null")
    params = F.create_map(*[F.lit(str(x)) for pair in sorted(step.params.items()) for x in pair]).cast("map<string,string>")
    candidates = write_and_read(signed(texts, step.stage).withColumn("params", params), "candidates")
    before = stored_manifests(spark, folder)
    changed = candidates if before is None else inc.select_work(candidates, before, KEYS, force)
    wanted = _allowed(changed, stored_texts(spark, folder, step.stage), on_exists)
    todo = candidates if wanted is candidates else write_and_read(wanted, "todo")

    rest = candidates.join(todo.select("run_id"), "run_id", "left_anti").withColumns(_outcome("skipped"))
    if dry_run:
        return Pass(_noted(todo.withColumns(_outcome("dry_run")).unionByName(rest), folder, started), None)
    if todo.head() is None:
        return Pass(_noted(rest, folder, started), None)

    if wanted is not candidates:  # texts of few runs: most others are left out before any is shuffled
        runs = todo.select("run_id")
        texts = ordered.maybe_among(texts, runs, ["run_id"])[0].join(runs, "run_id", "left_semi")
    result = step.work(texts)
    made = sinks.save_runs(result.texts, f"{folder}/texts", "overwrite", buckets=buckets, stage_first=False)
    # The log tells prompts by hash and replies by length; the texts themselves are the outputs.
    calls = sinks.save_runs(result.calls.drop("prompt", "response"), f"{folder}/calls", "overwrite", buckets=buckets)
    reasons = result.rejected.groupBy("run_id").agg(F.min("breach").alias("error"))
    outputs = signed(made, step.stage).select("run_id", F.col("inputs_signature").alias("outputs_signature"))
    done = todo.join(outputs, "run_id", "left").join(reasons, "run_id", "left")
    done = done.withColumn("status", F.when(F.col("outputs_signature").isNotNull(), "success").otherwise("failed"))
    return Pass(_noted(done.unionByName(rest), folder, started), calls)


def run_steps(texts: DataFrame, steps: Sequence[Step], folder: str, **policy) -> list[Pass]:
    """Stages one after the other, each on the stored outputs of the one before. A run that fails stops
    there; the others go on. A second call with the same texts and parameters does no stage again."""
    passes = []
    for step in steps:
        passes.append(run_stage(texts, step, folder, **policy))
        alive = passes[-1].manifests.filter("status <> 'failed'").select("run_id")
        stored = stored_texts(texts.sparkSession, folder, step.stage)
        if stored is None:
            break
        # The next stage's own outputs go to the same table, so what it reads is kept apart.
        texts = write_and_read(stored.drop("stage").join(alive, "run_id", "left_semi"), "stage-input")
    return passes


def _allowed(changed: DataFrame, stored: DataFrame | None, on_exists: str) -> DataFrame:
    if stored is None or on_exists == "overwrite":
        return changed
    there = stored.select("run_id").distinct()
    if on_exists == "skip":
        return changed.join(there, "run_id", "left_anti")
    hit = changed.join(there, "run_id", "left_semi").head()
    if hit is not None:
        raise sinks.ExistingOutputError(f"outputs already exist for {[hit[k] for k in KEYS]}")
    return changed


def _outcome(status: str) -> dict:
    none = F.lit(None).cast("string")
    return {"status": F.lit(status), "outputs_signature": none, "error": none}


def _noted(rows: DataFrame, folder: str, started: str) -> DataFrame:
    rows = rows.withColumns({"started_at": F.lit(started), "finished_at": F.lit(_now())})
    names = [c.split()[0] for c in MANIFESTS.split(", ")]
    rows = write_and_read(rows.select(*names), "manifests")
    sinks.write_manifests(rows, f"{folder}/manifests")
    return rows


def _now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="microseconds")
