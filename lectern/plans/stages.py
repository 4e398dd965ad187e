"""Model stages composed from the operators, over all runs at once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lectern import schemas as S
from lectern.operators import blocks as bl, calls as ca, ordered, prompts as pr, responses as rs, review as rv, shaping as sh
from lectern.session import write_and_read


@dataclass(frozen=True)
class ModelSetup:
    """Which model answers, how, and under which caps."""

    make: Callable[[], ca.Model]
    model: str
    temperature: float = 0.1
    provider: str = S.LOCAL_PROVIDER
    caps: ca.Caps = ca.Caps()
    tasks: int | None = None
    #: Folder of replies that were paid for: a stage that is run again calls only what it does not answer.
    ledger: str | None = None


@dataclass(frozen=True)
class StageResult:
    texts: DataFrame
    calls: DataFrame
    rejected: DataFrame
    extra: dict[str, DataFrame]


def _prompted(rows: DataFrame, body: str, values, stage: str, phase: str, setup: ModelSetup) -> DataFrame:
    unknown = pr.hole_names(body) - set(values)
    if unknown:
        raise pr.TemplateError(f"Missing prompt template values for {stage}: {', '.join(sorted(unknown))}")
    return rows.withColumns({
        "prompt": pr.fill(F.lit(body), values),
        "stage": F.lit(stage), "phase": F.lit(phase),
        "provider": F.lit(setup.provider), "model": F.lit(setup.model),
        "temperature": F.lit(float(setup.temperature)),
    })


def _admitted(prompts: DataFrame, setup: ModelSetup, **kw) -> tuple[DataFrame, DataFrame]:
    """Prompts within budget and the groups over it. Only paid calls have one."""
    if setup.provider != S.PAID_PROVIDER:
        return prompts, _no_groups(prompts)
    ready, rejected = ca.admit(prompts, caps=setup.caps, **kw)
    return ready, rejected.select("run_id", "stage", "breach")


def _limited(prompts: DataFrame, setup: ModelSetup, spent: DataFrame | None = None, **kw) -> tuple[DataFrame, DataFrame]:
    """Prompts whose number is within the limit of calls, and the groups with more."""
    if setup.provider != S.PAID_PROVIDER:
        return prompts, _no_groups(prompts)
    ready, over = ca.within_limit(prompts, setup.caps.calls, spent=spent, **kw)
    return ready, write_and_read(over, "over-limit")


def _no_groups(prompts: DataFrame) -> DataFrame:
    return prompts.select("run_id", "stage", F.lit(None).cast("string").alias("breach")).limit(0)


def _answered(ready: DataFrame, setup: ModelSetup, stored: DataFrame) -> DataFrame:
    """Replies without their prompts. Prompts as they are stored are called where they lie, if that keeps all slots busy."""
    slots = ready.sparkSession.sparkContext.defaultParallelism
    in_place = setup.tasks is None and ready is stored and stored.rdd.getNumPartitions() >= slots
    return ca.call_model(ready, setup.make, tasks=setup.tasks, ledger=setup.ledger, prompt_kept=False, in_place=in_place)


def _stopped(costs: DataFrame, rejected: DataFrame, setup: ModelSetup) -> DataFrame:
    """Groups stopped by a run-time cap, added to those stopped before calling."""
    before = rejected.select("run_id", "stage", "breach")
    if setup.provider != S.PAID_PROVIDER:
        return before
    late = ca.cap_breaches(costs, caps=setup.caps).select("run_id", "stage", "breach")
    return before.unionByName(late).distinct()


def text_transform(
    texts: DataFrame,
    stage: str,
    template: str,
    setup: ModelSetup,
    *,
    max_chars: int = S.TEXT_CHUNK_CHARS,
    sep: str = "\n\n",
    with_edits: bool = False,
) -> StageResult:
    """M2: chunk, prompt, check budgets, call, reassemble - for every run.

    The four instances (clean s05, edit s07, translate s09, polish s10) differ
    in stage, input and template only. Runs over budget are reported and get
    no text; runs without text get an empty text and no call.
    """
    chunks = sh.text_chunks(texts, ["run_id"], max_chars, sep=sep).withColumnRenamed("chunk_id", "batch_id")
    prompts = write_and_read(
        _prompted(chunks, template, {"text": F.col("text")}, stage, "chunk", setup)
        .withColumn("input_chars", F.length("text").cast("bigint")).withColumn("retry_index", F.lit(0))
        .drop(*([] if with_edits else ["text"])),
        "prompts",
    )
    upper = ordered.largest(prompts, "batch_id")
    ready, rejected = _admitted(prompts, setup, upper=upper)
    ready, over = _limited(ready, setup, upper=upper)
    rejected = rejected.unionByName(over)
    # Prompts and replies are stored; what joins them reads the columns it needs only.
    answered = _answered(ready, setup, prompts)
    costs = ca.running_costs(ca.untold(answered.filter("error IS NULL")), upper=upper)
    # Stored, so that its size is known: replies are not shuffled for a short list of runs.
    failed = write_and_read(ca.failed_groups(answered), "failed-runs")
    stopped = _stopped(costs, rejected, setup).unionByName(failed)
    runs = texts.select("run_id").distinct().join(stopped, "run_id", "left_anti")
    answered = answered.join(failed.select("run_id"), "run_id", "left_anti")
    done = answered
    if setup.provider == S.PAID_PROVIDER:
        done = ordered.attach(answered, runs, ["run_id"], "batch_id", upper=upper)
    out = sh.reassemble(done, ["run_id"], "batch_id", "response", runs=runs, upper=upper)
    extra = {}
    if with_edits:
        before = answered.select("run_id", "batch_id", "text")
        after = answered.select("run_id", "batch_id", F.col("response").alias("text"))
        extra["line_changes"] = rv.line_changes(before, after, ["run_id", "batch_id"])
        extra["edits"] = answered.select(
            "run_id", F.col("batch_id").alias("chunk_id"), F.col("text").alias("before"), F.col("response").alias("after")
        )
    return StageResult(out.withColumn("stage", F.lit(stage)), ca.call_log(costs), stopped, extra)


def classify(
    texts: DataFrame, template: str, repair: str, setup: ModelSetup, *,
    sep: str = "\n\n", retries: int = S.JSON_RETRIES, stage: str = "s06",
) -> StageResult:
    """Span classification: batches, repair rounds, decisions, review, removal."""
    spans = write_and_read(sh.span_batches(sh.spans(texts, ["run_id"], sep=sep)), "spans")
    prompts = write_and_read(
        _prompted(sh.batch_lines(spans), template, {"span_lines": F.col("lines")}, stage, "classify", setup)
        .withColumn("input_chars", F.length("prompt").cast("bigint")).drop("lines"),
        "prompts",
    )
    ready, rejected = _admitted(prompts, setup)
    attempts, dead, over = ca.repair_rounds(
        ready, setup.make, rs.parse_decisions, repair, retries=retries, tasks=setup.tasks, ledger=setup.ledger,
        limit=setup.caps.calls if setup.provider == S.PAID_PROVIDER else None,
    )
    rejected = rejected.unionByName(over)
    attempts = attempts.withColumn("input_chars", F.length("prompt").cast("bigint"))
    costs = ca.running_costs(attempts.filter("error IS NULL"))
    stopped = _stopped(costs, rejected, setup).unionByName(ca.failed_groups(attempts)).unionByName(
        dead.select("run_id", "stage", F.lit("invalid_json").alias("breach"))
    ).distinct()
    runs = texts.select("run_id").distinct().join(stopped, "run_id", "left_anti")
    upper = ordered.largest(spans, "span_id")
    # Stored, so that its size is known: spans are not shuffled for a short list of runs.
    gone = write_and_read(stopped.select("run_id").distinct(), "stopped-runs")
    alive = spans.filter("run_id IS NOT NULL").join(gone, "run_id", "left_anti")
    decided = write_and_read(
        rv.apply_decisions(alive, rs.decisions(attempts, ["run_id", "batch_id"])), "decided"
    )
    sentences = rv.sentence_table(decided)
    out = sh.reassemble(rv.kept(decided), ["run_id"], "span_id", runs=runs, upper=upper)
    return StageResult(
        out.withColumn("stage", F.lit(stage)), ca.call_log(costs).drop("parsed"), stopped,
        {
            "decisions": decided, "removed": rv.removed(decided), "sentences": sentences,
            "report": rv.review_report(sentences, runs, upper=upper), "dead": dead,
        },
    )


def condense(
    texts: DataFrame, map_template: str, reduce_template: str, setup: ModelSetup, *,
    sep: str = "\n\n", stage: str = "s08",
) -> StageResult:
    """Window prompts -> blocks -> merge -> reduce prompt -> final text."""
    paragraphs = write_and_read(sh.spans(texts, ["run_id"], sep=sep), "paragraphs")
    windows = sh.windows(paragraphs).withColumn("lines", sh.render_lines(F.col("rows"))).drop("rows")
    prompts = write_and_read(
        _prompted(windows, map_template, {"paragraph_lines": F.col("lines")}, stage, "map", setup)
        .drop("lines").withColumn("retry_index", F.lit(0)),
        "prompts",
    )
    ready, over = _admitted(prompts, setup)
    ready, many = _limited(ready, setup)
    over = over.unionByName(many)
    mapped = write_and_read(rs.parse_blocks(_answered(ready, setup, prompts)), "mapped")
    unread = mapped.filter(F.col("parsed").isNull()).select(
        "run_id", "stage", F.coalesce("error", F.lit("invalid_json")).alias("breach"))
    stopped = over.select("run_id", "stage", "breach").unionByName(unread).distinct()
    runs = texts.select("run_id").distinct().join(stopped, "run_id", "left_anti")

    found = rs.clamp_blocks(rs.blocks(mapped, ["run_id", "batch_id", "start_paragraph", "end_paragraph"]))
    totals = paragraphs.groupBy("run_id").agg(F.max("span_id").alias("n"))
    upper = ordered.largest(paragraphs, "span_id")
    live = totals.join(runs, "run_id")
    capped = ordered.attach(found, live, ["run_id"], "from_p", upper=upper)
    merged = bl.merge_blocks(capped, cap="n", upper=upper)
    # Runs that need spare blocks are told from names, so only their paragraphs are shuffled.
    bare = write_and_read(live.select("run_id").join(merged.select("run_id").distinct(), "run_id", "left_anti"), "bare-runs")
    spare = bl.fallback_blocks(ordered.maybe_among(paragraphs, bare, ["run_id"])[0], None, upper=upper, bare=bare)
    candidates = write_and_read(merged.unionByName(spare), "candidates")

    payload = bl.candidate_json(candidates)
    reduce = write_and_read(
        _prompted(payload, reduce_template, {"candidate_blocks_json": F.col("candidate_blocks_json")},
                  stage, "reduce", setup)
        .drop("candidate_blocks_json")
        .withColumns({"batch_id": F.lit(2_147_483_647), "retry_index": F.lit(0)}),
        "prompts",
    )
    ready2, over2 = _admitted(reduce, setup, upper=0)
    ready2, many = _limited(ready2, setup, ca.calls_made(mapped), upper=0)
    over2 = over2.unionByName(many)
    reduced = write_and_read(_answered(ready2, setup, reduce), "reduced")
    keep = reduced.columns
    attempts = mapped.select(*keep).unionByName(reduced)
    # The reduce call comes after all windows of its run.
    ranked = attempts.withColumn(
        "batch_id", F.when(F.col("phase") == "reduce", F.lit(upper + 1)).otherwise(F.col("batch_id"))
    )
    costs = ca.running_costs(ca.untold(ranked.filter("error IS NULL")), upper=upper + 1)
    stopped = stopped.unionByName(_stopped(costs, over2, setup)).unionByName(ca.failed_groups(reduced)).distinct()
    final = reduced.join(bl.block_bodies(candidates), "run_id", "left").select(
        "run_id", sh.final_condensed(F.col("response"), F.col("bodies")).alias("text"), F.lit(1).alias("one")
    )
    runs = texts.select("run_id").distinct().join(stopped, "run_id", "left_anti")
    out = ordered.assemble(
        final.join(runs, "run_id", "left_semi"), ["run_id"], ["one"], "text", runs=runs, upper=1
    )
    return StageResult(
        out.withColumn("stage", F.lit(stage)), ca.call_log(costs), stopped, {"blocks": candidates}
    )
