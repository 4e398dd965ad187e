"""Model calls as table work: estimates, prices, caps, calling, repair rounds."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import NamedTuple, Protocol

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import StructType

from lectern import schemas as S
from lectern.functions import accounting as acc
from lectern.operators import ordered, prompts as pr
from lectern.session import write_and_read

HOT_COPIES = 1 << 20
HOT_SALTS = 64
#: Prompts that are salted at most, the most frequent ones; any other is less than this part of all rows.
HOT_PROMPTS = 100_000
#: Prompts that a task answers between two writes of the ledger, and calls that it has in flight.
LEDGER_BATCH, IN_FLIGHT = 256, 4
#: So many calls in a wave without one answer mean that the client is broken, not the prompts.
HOPELESS = 20


class Reply(NamedTuple):
    text: str
    in_tok: int | None = None
    out_tok: int | None = None


class Model(Protocol):
    def generate(self, model: str, prompt: str, temperature: float) -> Reply: ...


class BudgetError(RuntimeError):
    """A token, cost or call cap is exceeded."""


class ClientError(RuntimeError):
    """No call was answered."""


@dataclass(frozen=True)
class Caps:
    cost_usd: float = S.COST_CAP_USD
    tokens_in: int = S.TOKEN_CAP_IN
    tokens_out: int = S.TOKEN_CAP_OUT
    calls: int = S.MAX_CALLS_PER_STAGE


def estimated(prompts: DataFrame) -> DataFrame:
    """M4: estimated input and output tokens per prompt; rows without their prompt have est_in already."""
    rows = prompts.withColumn("est_in", acc.estimate_tokens(F.col("prompt"))) if "prompt" in prompts.columns else prompts
    return rows.withColumn("est_out", acc.estimate_output(F.col("est_in"), F.col("stage")))


def priced(rows: DataFrame, prices=S.MODEL_PRICES) -> DataFrame:
    """M5: unit prices by model prefix."""
    return rows.withColumns({
        "price_in": acc.model_price(F.col("model"), "in", prices),
        "price_out": acc.model_price(F.col("model"), "out", prices),
    })


def costed(calls: DataFrame) -> DataFrame:
    """M6: reported usage wins over the estimate, side by side. A row that shares another row's call
    (``called`` is false) used no tokens."""
    made = F.col("called") if "called" in calls.columns else F.lit(True)
    rows = priced(estimated(calls)).withColumns({
        "in_tok": F.when(made, F.coalesce("in_tok", "est_in")).otherwise(F.lit(0)),
        "out_tok": F.when(made, F.coalesce("out_tok", "est_out")).otherwise(F.lit(0)),
    })
    return rows.withColumn(
        "cost", acc.call_cost(F.col("in_tok"), F.col("out_tok"), F.col("price_in"),
                              F.col("price_out"), F.col("provider"))
    ).drop("est_in", "est_out", "price_in", "price_out")


def running_costs(
    calls: DataFrame, keys=("run_id", "stage"), order=("batch_id", "retry_index"), **kw
) -> DataFrame:
    """M7: cumulative tokens, cost and call number in call order."""
    return ordered.running(
        costed(calls), list(keys), list(order),
        [
            ordered.Running("cum_in", "sum", F.col("in_tok")),
            ordered.Running("cum_out", "sum", F.col("out_tok")),
            ordered.Running("cum_cost", "sum", F.col("cost")),
            ordered.Running("call_no", "count"),
        ],
        **kw,
    )


def usd(amount: Column) -> Column:
    return F.round(amount, 6).cast("double")


def call_log(costs: DataFrame) -> DataFrame:
    """M3: log rows; amounts are rounded only here, after summing. Rows without texts (``untold``) have hash and length already."""
    told = {"prompt_hash": F.sha2("prompt", 256)} if "prompt" in costs.columns else {}
    if "response" in costs.columns:
        told["output_chars"] = F.length("response").cast("bigint")
    return costs.withColumns({
        **told,
        "cost_usd": usd(F.col("cost")),
        "cum_cost_usd": usd(F.col("cum_cost")),
    }).drop("cost", "cum_cost", "error")


def untold(answered: DataFrame) -> DataFrame:
    """Answered calls as the log needs them, without their texts, so that numbering calls moves no text."""
    return answered.withColumn("output_chars", F.length("response").cast("bigint")).drop("prompt", "response", "text", "parsed")


def _cap(value: float) -> Column:
    return F.lit(str(value)).cast("decimal(30,12)")


def budgets(prompts: DataFrame, keys=("run_id", "stage", "phase"), caps: Caps = Caps()) -> DataFrame:
    """M8: estimated totals and the first cap they exceed, per group.

    Sums combine map-side, so one huge run costs no more than many small ones.
    """
    rows = priced(estimated(prompts))
    cost = acc.call_cost(F.col("est_in"), F.col("est_out"), F.col("price_in"),
                         F.col("price_out"), F.col("provider"))
    totals = rows.withColumn("_cost", cost).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("prompts"),
        F.sum("est_in").alias("est_in"), F.sum("est_out").alias("est_out"),
        F.sum("_cost").alias("_cost"), F.max(F.col("provider") == S.PAID_PROVIDER).alias("_paid"),
    )
    breach = F.when(~F.col("_paid"), None).when(
        F.col("est_in") > caps.tokens_in, "token_cap_input"
    ).when(F.col("est_out") > caps.tokens_out, "token_cap_output").when(
        F.col("_cost") > _cap(caps.cost_usd), "cost_cap_usd"
    )
    return totals.select(*keys, "prompts", "est_in", "est_out", usd(F.col("_cost")).alias("est_cost_usd"),
                         breach.alias("breach"))


def admit(
    prompts: DataFrame, keys=("run_id", "stage", "phase"), caps: Caps = Caps(), *,
    strict: bool = False, order: str = "batch_id", **kw,
) -> tuple[DataFrame, DataFrame]:
    """(prompts within budget, rejected groups). Isolation is per group."""
    report = budgets(prompts, keys, caps)
    rejected = report.filter(F.col("breach").isNotNull())
    if strict:
        first = rejected.head()
        if first is not None:
            raise BudgetError(f"{[first[k] for k in keys]}: preflight exceeds {first['breach']}")
    fine = report.filter(F.col("breach").isNull()).select(*keys)
    return ordered.attach(prompts, fine, list(keys), order, **kw), rejected


def cap_breaches(costs: DataFrame, keys=("run_id", "stage"), caps: Caps = Caps()) -> DataFrame:
    """M9: first call per group whose running total, or number, passes a cap."""
    breach = F.when(F.col("provider") != S.PAID_PROVIDER, None).when(
        F.col("call_no") > caps.calls, "max_calls"
    ).when(F.col("cum_in") > caps.tokens_in, "token_cap_input").when(
        F.col("cum_out") > caps.tokens_out, "token_cap_output"
    ).when(F.col("cum_cost") > _cap(caps.cost_usd), "cost_cap_usd")
    return costs.withColumn("breach", breach).filter("breach IS NOT NULL").groupBy(*keys).agg(
        F.min("call_no").alias("call_no"), F.min_by("breach", "call_no").alias("breach")
    )


def within_limit(
    prompts: DataFrame, limit: int, keys=("run_id", "stage"), order=("batch_id",), *,
    spent: DataFrame | None = None, **kw,
) -> tuple[DataFrame, DataFrame]:
    """M9 before the call: (prompts that may be called, groups with more prompts than calls left).

    Calls of a group are numbered in order before any is made, after the ``spent`` ones (keys, spent)
    of earlier rounds, and only numbers up to ``limit`` pass: call ``limit`` + 1 is never made. The
    numbers are a sliced prefix sum, so a hot group is not one task. Calls that cost nothing have no limit.
    """
    paid = F.col("provider") == S.PAID_PROVIDER
    free, counted = prompts.filter(~paid), prompts.filter(paid)
    counted = ordered.number_rows(counted, list(keys), list(order), "_no", **kw)
    if spent is not None:
        counted = ordered.attach(counted, spent, list(keys), order[0], how="left", **kw)
    else:
        counted = counted.withColumn("spent", F.lit(0))
    number = F.col("_no") + F.coalesce("spent", F.lit(0))
    over = counted.filter(number > limit).select(*keys).distinct().withColumn("breach", F.lit("max_calls"))
    return free.unionByName(counted.filter(number <= limit).select(*prompts.columns)), over


def calls_made(answered: DataFrame, keys=("run_id", "stage")) -> DataFrame:
    """Calls per group so far, for ``within_limit``; a failed call was a call."""
    return answered.groupBy(*keys).agg(F.count(F.lit(1)).alias("spent"))


# ---------------------------------------------------------------------------
# Calling the model
# ---------------------------------------------------------------------------

_REPLY = "model STRING, temperature DOUBLE, prompt_hash STRING, copies BIGINT, response STRING, in_tok BIGINT, out_tok BIGINT, error STRING"
_TOLD = pa.schema([("response", pa.string()), ("in_tok", pa.int64()), ("out_tok", pa.int64()), ("error", pa.string())])
_TOLD_DDL = "response STRING, in_tok BIGINT, out_tok BIGINT, error STRING"


def _caller(make_model: Callable[[], Model], in_flight: int, keep: list[str]):
    """For mapInArrow: the columns ``keep`` of each row and its reply."""

    def answer(client: Model, model: str, prompt: str, temperature: float) -> tuple:
        try:
            reply = client.generate(model, prompt, temperature)
            return reply.text.strip(), reply.in_tok, reply.out_tok, None
        except Exception as problem:  # one failed call must not end the other runs
            return None, None, None, f"{type(problem).__name__}: {problem}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make_model()
        with ThreadPoolExecutor(in_flight) as pool:
            for rows in batches:
                asked = zip(*[rows.column(c).to_pylist() for c in ("model", "prompt", "temperature")])
                replies = list(pool.map(lambda a: answer(client, *a), asked))
                told = [pa.array([r[i] for r in replies], f.type) for i, f in enumerate(_TOLD)]
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in keep], *told], names=[*keep, *_TOLD.names])

    return run


def _ask(rows: DataFrame, make_model: Callable[[], Model], in_flight: int, keep: list[str]) -> DataFrame:
    schema = StructType([*[rows.schema[c] for c in keep], *StructType.fromDDL(_TOLD_DDL)])
    return rows.mapInArrow(_caller(make_model, in_flight, keep), schema)


def failed_groups(answered: DataFrame, keys=("run_id", "stage")) -> DataFrame:
    """Groups with a failed call and what went wrong."""
    return answered.filter("error IS NOT NULL").groupBy(*keys).agg(F.min("error").alias("breach"))


_CALL = ["model", "temperature", "prompt_hash"]


def ledger_replies(spark, path: str) -> DataFrame:
    """Stored replies, one per call; an answer wins over failures of the same call. No ledger yet: no rows."""
    try:
        stored = spark.read.schema(_REPLY).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _REPLY)
    best = F.max_by(F.struct("copies", "response", "in_tok", "out_tok", "error"), F.struct(F.col("error").isNull(), "copies"))
    return stored.groupBy(*_CALL).agg(best.alias("_r")).select(*_CALL, "_r.*")


def call_model(
    prompts: DataFrame,
    make_model: Callable[[], Model],
    *,
    tasks: int | None = None,
    known: DataFrame | None = None,
    ledger: str | None = None,
    batch: int = LEDGER_BATCH,
    in_flight: int = IN_FLIGHT,
    hopeless: int = HOPELESS,
    hot_copies: int = HOT_COPIES,
    salts: int = HOT_SALTS,
    prompt_kept: bool = True,
    in_place: bool = False,
) -> DataFrame:
    """M1: one reply per prompt row.

    Equal (model, temperature, prompt) rows are called once; ``called`` is true on the one row of
    them, the first by the other columns, that the call is billed to. ``tasks`` caps the parallel
    tasks, each with ``in_flight`` calls at a time: the client is shared by that many threads.

    Replies are written before anything reads them, so a later action never repeats finished calls.
    Without a ``ledger`` a task that is lost repeats its own. With one, a folder, prompts are called in waves of
    ``batch`` per task, each wave is added to the ledger when it ends, and calls that the ledger answers are
    not made again: a lost task repeats one batch at most, and a run that was broken off goes on
    where it was. ``known`` replies (same columns) are not called again either; failed ones are. A call that raises,
    or has no text, gives a row with ``error`` and no response; ``hopeless`` calls in one wave
    without any answer raise ClientError. Turn speculation off for the session that calls a paid model.

    Without ledger and known replies a prompt of one row only is stored with its row and reply, so neither is joined.
    Without ``prompt_kept`` rows come back with est_in in place of their prompt, and it is not stored again.
    With ``in_place`` such prompts are called by the tasks that read them, for a caller whose prompts lie in
    as many parts as there are slots.
    """
    spark = prompts.sparkSession
    if not prompt_kept:
        prompts = prompts.withColumn("est_in", acc.estimate_tokens(F.col("prompt")))
    asked = prompts.withColumn("prompt_hash", F.sha2("prompt", 256))
    mine = F.xxhash64(*[F.col(c) for c, t in prompts.dtypes if c != "prompt" and not t.startswith("map")], F.col("prompt_hash"))
    # A fixed number of tasks: calls are slow, so their bytes say nothing about
    # how few tasks would do.
    width = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    told = prompts.columns if prompt_kept else [c for c in prompts.columns if c != "prompt"]
    if known is None and ledger is None:
        return _call_all(asked.withColumn("_mine", mine), told, make_model, None if in_place else width, width, in_flight, hopeless, hot_copies, salts)
    unique = asked.groupBy(*_CALL).agg(
        F.first("prompt").alias("prompt"), F.count(F.lit(1)).alias("copies"), F.min(mine).alias("bill"))
    unique = write_and_read(unique, "calls-asked")
    bills = unique.select(*_CALL, "copies", "bill")
    if known is not None:
        known = known if "error" in known.columns else known.withColumn("error", F.lit(None).cast("string"))
        known = known.filter("error IS NULL")
        unique = unique.join(known.select(*_CALL), _CALL, "left_anti")
    ask = lambda rows: _ask(rows.repartition(width, "prompt_hash"), make_model, in_flight, [*_CALL, "copies", "bill"])
    if ledger is None:
        replies = write_and_read(ask(unique), "replies")
        _check_client(replies.agg(*_told()).first(), hopeless)
    else:
        answered = ledger_replies(spark, ledger).filter("error IS NULL")
        todo = unique.join(answered.select(*_CALL), _CALL, "left_anti")
        waves = -(-todo.count() // (width * batch))
        if waves:
            # One folder per wave, so that a wave reads its own prompts only.
            wave_of = F.pmod(F.xxhash64("prompt_hash"), F.lit(waves)).cast("int")
            todo = write_and_read(todo.withColumn("wave", wave_of).repartition("wave"), "unanswered", "wave")
        for wave in range(waves):
            seen = Observation()
            said = ask(todo.filter(F.col("wave") == wave).drop("wave")).observe(seen, *_told())
            said.select(*[f.name for f in StructType.fromDDL(_REPLY)]).write.mode("append").parquet(ledger)
            _check_client(seen.get, hopeless)
        asked_now = unique.select(*_CALL, "copies", "bill")
        replies = write_and_read(ledger_replies(spark, ledger).drop("copies").join(asked_now, _CALL), "replies")
    if known is not None:
        replies = replies.unionByName(known.drop("copies").join(bills, _CALL).select(*replies.columns))
    return _join_replies(asked.withColumn("_mine", mine).select(*told, "prompt_hash", "_mine"), replies, hot_copies, salts)


def _call_all(asked, told, make_model, dealt: int | None, width: int, in_flight, hopeless, hot_copies, salts) -> DataFrame:
    """Replies to all prompts. Only prompts that may have several rows are grouped, and only their replies joined: which
    they are is known from hashes. ``dealt``: the tasks that the others are dealt to; None leaves them where they lie."""
    keep = [*[c for c in told if c not in _CALL], *_CALL]
    shared = write_and_read(asked.groupBy(*_CALL).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"), "shared-calls")
    some = not shared.isEmpty()
    several, single = ordered.maybe_among(asked, shared, ["prompt_hash"]) if some else (None, asked)
    single = single.select(*dict.fromkeys([*keep, "prompt"]))
    single = single if dealt is None else single.repartition(dealt, "prompt_hash")
    alone = write_and_read(_ask(single, make_model, in_flight, keep), "replies")
    out = alone.withColumn("called", F.lit(True))
    if not some:
        _check_client(alone.agg(*_told()).first(), hopeless)
        return out
    unique = several.groupBy(*_CALL).agg(
        F.first("prompt").alias("prompt"), F.count(F.lit(1)).alias("copies"), F.min("_mine").alias("bill"))
    unique = unique.repartition(width, "prompt_hash")
    replies = write_and_read(_ask(unique, make_model, in_flight, [*_CALL, "copies", "bill"]), "shared-replies")
    _check_client(alone.select("error").unionByName(replies.select("error")).agg(*_told()).first(), hopeless)
    return out.unionByName(_join_replies(several.select(*keep, "_mine"), replies, hot_copies, salts))


def _told() -> list[Column]:
    """What a wave tells of its calls."""
    return [F.count(F.lit(1)).alias("n"), F.count("error").alias("bad"), F.min("error").alias("error")]


def _check_client(told, hopeless: int) -> None:
    if told["n"] >= hopeless and told["n"] == told["bad"]:
        raise ClientError(f"none of {told['n']} calls was answered: {told['error']}")


def _join_replies(asked, replies, hot_copies, salts):
    """Give every prompt row its reply; very common prompts are salted.

    The hot ones are the HOT_PROMPTS most frequent of those with ``hot_copies`` rows or more, so
    their hashes fit a broadcast, and any prompt that is not among them has less than 1 / HOT_PROMPTS
    of all rows.
    """
    frequent = replies.filter(F.col("copies") >= hot_copies)
    if frequent.isEmpty():
        out = asked.join(replies.drop("copies"), _CALL)
        return out.withColumn("called", F.col("_mine") == F.col("bill")).drop("_mine", "bill")
    hot = frequent.orderBy(F.desc("copies"), "prompt_hash").limit(HOT_PROMPTS)
    hot = write_and_read(hot.select(*_CALL, F.lit(True).alias("_hot")), "hot-prompts")
    salt = F.pmod(F.xxhash64("_mine"), F.lit(salts))
    salted = asked.join(F.broadcast(hot), _CALL, "left").withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(F.lit(0)).cast("int"))
    shards = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread = replies.join(F.broadcast(hot), _CALL, "left").withColumn("_salt", F.explode(shards)).drop("copies", "_hot")
    out = salted.drop("_hot").join(spread, [*_CALL, "_salt"])
    return out.withColumn("called", F.col("_mine") == F.col("bill")).drop("_salt", "_mine", "bill")


def repair_rounds(
    prompts: DataFrame,
    make_model: Callable[[], Model],
    parse: Callable[[DataFrame], DataFrame],
    repair_body: str,
    *,
    retries: int = S.JSON_RETRIES,
    keys=("run_id", "stage", "batch_id"),
    tasks: int | None = None,
    ledger: str | None = None,
    limit: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Call, parse, re-ask the failed ones; at most ``retries`` + 1 rounds.

    ``parse`` adds ``parsed`` (null when unusable) and ``parse_error``.
    Returns (all attempts, dead letters: batches that never parsed, groups that ran into the ``limit`` of
    calls). Calls of all rounds are numbered before each round, so none beyond the limit is made. A failed
    call is an attempt with ``error``; it is not asked again.
    """
    holes = pr.hole_names(repair_body) - {"original_prompt", "bad_response"}
    if holes:
        raise pr.TemplateError(f"Missing prompt template values for repair: {', '.join(sorted(holes))}")
    # The original of a repair prompt; a prompt of the first round is its own.
    todo = prompts.withColumn("_original", F.lit(None).cast("string"))
    attempts = None
    last, stopped = None, None
    for attempt in range(retries + 1):
        if limit is not None:
            todo, over = within_limit(todo, limit, spent=None if attempts is None else calls_made(attempts))
            over = write_and_read(over, "over-limit")
            stopped = over if stopped is None else stopped.unionByName(over).distinct()
        answered = call_model(todo.withColumn("retry_index", F.lit(attempt)), make_model, tasks=tasks, ledger=ledger)
        # Written once per round: the next round and the log both read it.
        last = write_and_read(parse(answered), "round")
        attempts = last if attempts is None else attempts.unionByName(last)
        failed = last.filter("parsed IS NULL AND error IS NULL")
        if attempt == retries or failed.isEmpty():
            break
        original = F.coalesce("_original", "prompt")
        ask = pr.fill(F.lit(repair_body), {"original_prompt": original, "bad_response": F.col("response")})
        todo = failed.withColumns({"prompt": ask, "_original": original}).select(*todo.columns)
    dead = last.filter("parsed IS NULL AND error IS NULL").select(*keys, "parse_error")
    if stopped is None:
        stopped = prompts.select("run_id", "stage", F.lit("max_calls").alias("breach")).limit(0)
    return attempts.drop("_original"), dead, stopped
