"""M: prompts, estimates, prices, caps, model calls, repair rounds."""

from __future__ import annotations

import hashlib
import json
import re
import uuid

from pyspark.sql import functions as F

from lectern import schemas as S
from lectern.catalog.base import documents, query, sql_batches, sql_chunks, sql_strip
from lectern.operators import calls as ca, prompts as pr
from lectern.plans import stages as st
from lectern.session import shared_folder

_BODY = "Clean this up.\n\nInput:\n{{text}}"
_BODY_SQL = "'Clean this up.' || chr(10) || chr(10) || 'Input:' || chr(10) || text"
_MODELS = ("gpt-5-nano", "GPT-5-mini-2025", "gpt-5.2", "other")
_RATIO_SQL = "CASE stage " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in S.STAGE_OUTPUT_RATIO.items()) + " ELSE 0.8::DOUBLE END"
_STAGES = ("s05", "s06", "s07", "s08", "s09", "s10", "s11")


def _prompts(spark, sf):
    """One run per source, one call per document, in document order."""
    docs = documents(spark, sf)
    pick = lambda values, n: F.element_at(F.array(*[F.lit(v) for v in values]), (n + 1).cast("int"))
    number = F.regexp_extract("source", r"(\d+)", 1).cast("int")
    return docs.select(
        F.col("source").alias("run_id"), pick(_STAGES, number % 7).alias("stage"), F.lit("chunk").alias("phase"),
        F.col("doc_id").alias("batch_id"), F.lit(0).alias("retry_index"),
        F.when(number % 5 == 4, "local").otherwise("openai").alias("provider"),
        pick(_MODELS, number % 4).alias("model"), F.lit(0.1).alias("temperature"), "text",
        pr.fill(F.lit(_BODY), {"text": F.col("text")}).alias("prompt"),
        F.length("text").cast("bigint").alias("input_chars"),
        F.when(F.col("doc_id") % 3 == 0, F.col("n_chars")).cast("bigint").alias("in_tok"),
        F.when(F.col("doc_id") % 4 == 0, F.col("n_chars") * 2).cast("bigint").alias("out_tok"),
    )


_P = f"""p AS (
  SELECT source AS run_id, regexp_extract(source, '(\\d+)', 1)::INT AS num, doc_id AS batch_id, text, n_chars, {_BODY_SQL} AS prompt FROM documents),
q AS (
  SELECT *, [{', '.join(f"'{s}'" for s in _STAGES)}][num % 7 + 1] AS stage,
         CASE WHEN num % 5 = 4 THEN 'local' ELSE 'openai' END AS provider,
         [{', '.join(f"'{m}'" for m in _MODELS)}][num % 4 + 1] AS model,
         ceil(length(regexp_replace(prompt, '^\\s+|\\s+$', '', 'g')) / 4.0)::BIGINT AS est_in FROM p),
e AS (SELECT *, greatest(1, ceil(est_in * {_RATIO_SQL}))::BIGINT AS est_out FROM q),
r AS (
  SELECT *, CASE WHEN lower(model) LIKE 'gpt-5-nano%' THEN 0.05 WHEN lower(model) LIKE 'gpt-5-mini%' THEN 0.25 WHEN lower(model) LIKE 'gpt-5.2%' THEN 1.75 ELSE 0.25 END::DECIMAL(18,6) AS price_in,
         CASE WHEN lower(model) LIKE 'gpt-5-nano%' THEN 0.40 WHEN lower(model) LIKE 'gpt-5-mini%' THEN 2.00 WHEN lower(model) LIKE 'gpt-5.2%' THEN 14.00 ELSE 2.0 END::DECIMAL(18,6) AS price_out FROM e),
u AS (
  SELECT *, CASE WHEN batch_id % 3 = 0 THEN n_chars ELSE est_in END AS in_tok, CASE WHEN batch_id % 4 = 0 THEN n_chars * 2 ELSE est_out END AS out_tok FROM r),
c AS (
  SELECT *, CASE WHEN provider = 'openai' THEN (in_tok::DECIMAL(19,0) * price_in::DECIMAL(10,2) + out_tok::DECIMAL(19,0) * price_out::DECIMAL(10,2)) ELSE 0 END::DECIMAL(30,2) AS micro FROM u),
w AS (
  SELECT *, sum(in_tok) OVER o AS cum_in, sum(out_tok) OVER o AS cum_out, sum(micro) OVER o AS cum_micro, row_number() OVER o AS call_no
  FROM c WINDOW o AS (PARTITION BY run_id, stage ORDER BY batch_id))"""


def _money(x):
    return f"round(({x})::DECIMAL(32,2)::DECIMAL(38,8) * 0.000001, 6)::DOUBLE"


@query("m3_call_log", f"""WITH {_P} SELECT run_id, batch_id, sha256(prompt) AS prompt_hash, length(text)::BIGINT AS input_chars,
  length(text)::BIGINT AS output_chars, {_money('micro')} AS cost_usd, {_money('cum_micro')} AS cum_cost_usd FROM w""")
def call_log(spark, sf):
    answered = _prompts(spark, sf).withColumn("response", F.col("text"))
    return ca.call_log(ca.running_costs(answered)).select(
        "run_id", "batch_id", "prompt_hash", "input_chars", "output_chars", "cost_usd", "cum_cost_usd")


@query("m4_token_estimates", f"WITH {_P} SELECT run_id, batch_id, est_in, est_out FROM e")
def token_estimates(spark, sf):
    return ca.estimated(_prompts(spark, sf)).select("run_id", "batch_id", "est_in", "est_out")


@query("m5_model_prices", f"WITH {_P} SELECT run_id, batch_id, price_in::DOUBLE AS price_in, price_out::DOUBLE AS price_out FROM r")
def model_prices(spark, sf):
    return ca.priced(_prompts(spark, sf)).select(
        "run_id", "batch_id", F.col("price_in").cast("double").alias("price_in"), F.col("price_out").cast("double").alias("price_out"))


@query("m6_call_costs", f"WITH {_P} SELECT run_id, batch_id, in_tok, out_tok, {_money('micro')} AS cost_usd FROM c")
def call_costs(spark, sf):
    return ca.costed(_prompts(spark, sf)).select("run_id", "batch_id", "in_tok", "out_tok", ca.usd(F.col("cost")).alias("cost_usd"))


def _running(**kw):
    def run(spark, sf):
        return ca.running_costs(_prompts(spark, sf), **kw).select(
            "run_id", "stage", "batch_id", "call_no", "cum_in", "cum_out", ca.usd(F.col("cum_cost")).alias("cum_cost_usd"))
    return run


_RUNNING_SQL = f"""WITH {_P} SELECT run_id, stage, batch_id, call_no, cum_in::BIGINT AS cum_in, cum_out::BIGINT AS cum_out, {_money('cum_micro')} AS cum_cost_usd FROM w"""
query("m7_running_costs", _RUNNING_SQL)(_running())
query("m7_running_costs_sliced", _RUNNING_SQL)(_running(slice_rows=64))

_CAPS = ca.Caps(cost_usd=0.05, tokens_in=60_000, tokens_out=40_000, calls=30)
_BUDGET_SQL = f"""b AS (
  SELECT run_id, stage, count(*) AS prompts, sum(est_in)::BIGINT AS est_in, sum(est_out)::BIGINT AS est_out, bool_or(provider = 'openai') AS paid,
         sum(CASE WHEN provider = 'openai' THEN est_in * price_in::DECIMAL(10,2) + est_out * price_out::DECIMAL(10,2) ELSE 0 END)::DECIMAL(32,2) AS micro
  FROM r GROUP BY run_id, stage),
v AS (SELECT *, CASE WHEN NOT paid THEN NULL WHEN est_in > 60000 THEN 'token_cap_input' WHEN est_out > 40000 THEN 'token_cap_output'
        WHEN micro > 0.05 * 1000000 THEN 'cost_cap_usd' END AS breach FROM b)"""


@query("m8_budgets", f"WITH {_P}, {_BUDGET_SQL} SELECT run_id, stage, prompts, est_in, est_out, {_money('micro')} AS est_cost_usd, breach FROM v")
def budgets(spark, sf):
    return ca.budgets(_prompts(spark, sf), ("run_id", "stage"), _CAPS)


@query("m8_admitted_prompts", f"WITH {_P}, {_BUDGET_SQL} SELECT run_id, stage, batch_id FROM r JOIN v USING (run_id, stage) WHERE breach IS NULL")
def admitted(spark, sf):
    return ca.admit(_prompts(spark, sf), ("run_id", "stage"), _CAPS, slice_rows=128)[0].select("run_id", "stage", "batch_id")


@query("m9_cap_breaches", f"""WITH {_P}, t AS (
  SELECT *, CASE WHEN provider <> 'openai' THEN NULL WHEN call_no > 30 THEN 'max_calls' WHEN cum_in > 60000 THEN 'token_cap_input'
    WHEN cum_out > 40000 THEN 'token_cap_output' WHEN cum_micro > 0.05 * 1000000 THEN 'cost_cap_usd' END AS breach FROM w)
SELECT run_id, stage, min(call_no) AS call_no, arg_min(breach, call_no) AS breach FROM t WHERE breach IS NOT NULL GROUP BY run_id, stage""")
def cap_breaches(spark, sf):
    return ca.cap_breaches(ca.running_costs(_prompts(spark, sf)), caps=_CAPS)


# -- model calls with deterministic stand-ins ---------------------------------


class Echo:
    """Answers with the prompt; reports usage for even lengths only."""

    def generate(self, model, prompt, temperature):
        even = len(prompt) % 2 == 0
        return ca.Reply(f" [{model}] {prompt}\n", len(prompt) if even else None, None)


@query("m1_model_replies", f"""WITH {_P} SELECT run_id, batch_id, '[' || model || '] ' || regexp_replace(prompt, '\\s+$', '') AS response,
  CASE WHEN length(prompt) % 2 = 0 THEN length(prompt) END::BIGINT AS in_tok FROM q""")
def model_replies(spark, sf):
    replies = ca.call_model(_prompts(spark, sf).drop("in_tok", "out_tok"), Echo, tasks=8, hot_copies=3, salts=4)
    return replies.select("run_id", "batch_id", "response", "in_tok")


_LIMIT = 7


@query("m9_call_limit", f"""WITH {_P} SELECT run_id, stage,
  sum((provider <> 'openai' OR batch_id <= {_LIMIT})::INT)::BIGINT AS calls, max((provider = 'openai' AND batch_id > {_LIMIT})::INT) = 1 AS stopped
FROM (SELECT * REPLACE (row_number() OVER (PARTITION BY run_id, stage, provider ORDER BY batch_id) AS batch_id) FROM q) GROUP BY run_id, stage""")
def call_limit(spark, sf):
    """Calls really made of each run when a paid stage may make few, and whether it ran into the limit."""
    ready, over = ca.within_limit(_prompts(spark, sf).drop("in_tok", "out_tok"), _LIMIT, slice_rows=128)
    made = ca.call_model(ready, Echo, tasks=8).groupBy("run_id", "stage").agg(F.count(F.lit(1)).alias("calls"))
    over = over.select("run_id", "stage", F.lit(True).alias("stopped"))
    return made.join(over, ["run_id", "stage"], "left").fillna(False, ["stopped"])


class Refusing:
    """Raises for prompts whose hash starts with 0, has no text for those with 1, answers the rest."""

    def generate(self, model, prompt, temperature):
        digit = hashlib.sha256(prompt.encode()).hexdigest()[0]
        if digit == "0":
            raise ValueError("refused")
        return ca.Reply(None if digit == "1" else prompt[:3])


@query("m1_failed_calls", f"""WITH {_P} SELECT run_id, batch_id, sha256(prompt)[1] IN ('0', '1') AS failed,
  CASE WHEN sha256(prompt)[1] NOT IN ('0', '1') THEN {sql_strip("prompt[1:3]")} END AS response FROM q""")
def failed_calls(spark, sf):
    """Replies by way of a ledger, failed calls as rows of their own."""
    ledger = f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}"
    asked = _prompts(spark, sf).drop("in_tok", "out_tok")
    replies = ca.call_model(asked, Refusing, tasks=8, ledger=ledger, batch=512)
    return replies.select("run_id", "batch_id", F.col("error").isNotNull().alias("failed"), "response")


def _texts(spark, sf):
    return documents(spark, sf).select(F.col("doc_id").cast("string").alias("run_id"), "text")


@query("m2_text_transform", f"""WITH {sql_chunks(6000)}
SELECT doc_id::VARCHAR AS run_id, 0::INT AS part, 's07' AS stage,
  string_agg('[m] Edit:' || chr(10) || text, chr(10) || chr(10) ORDER BY chunk_id) || chr(10) AS text
FROM chunks GROUP BY doc_id""")
def text_transform(spark, sf):
    return st.text_transform(_texts(spark, sf), "s07", "Edit:\n{{text}}", st.ModelSetup(Echo, "m"), sep="\n").texts


class Judge:
    """Removes every third span; stumbles on some prompts.

    Prompts whose hash starts with 0-3 get an unusable first answer, and those
    starting with 0 never get a usable one.
    """

    def generate(self, model, prompt, temperature):
        repair = prompt.startswith("Repair:\n")
        original = prompt.split("\nPROMPT>>\n", 1)[1].split("\n<<BAD\n", 1)[0] if repair else prompt
        digit = hashlib.sha256(original.encode()).hexdigest()[0]
        if digit == "0" or (digit in "123" and not repair):
            return ca.Reply("I would rather not.")
        rows = [
            {"span_id": int(n), "action": "remove" if int(n) % 3 == 0 else "KEEP", "label": "l" + n}
            for n in re.findall(r"^\[(\d+)\] ", original, re.M) if int(n) % 4
        ]
        return ca.Reply("Here:\n```json\n" + json.dumps({"items": rows}) + "\n```")


_CLASSIFY = "Classify:\n{{span_lines}}"
_REPAIR = "Repair:\nPROMPT>>\n{{original_prompt}}\n<<BAD\n{{bad_response}}"


def _classified(spark, sf):
    return st.classify(_texts(spark, sf), _CLASSIFY, _REPAIR, st.ModelSetup(Judge, "m"), sep="\n", retries=2)


_JUDGED = sql_batches(40, 8000) + """,
asked AS (
  SELECT doc_id, batch_id, sha256('Classify:' || chr(10) || string_agg('[' || span_id || '] ' || text, chr(10) ORDER BY span_id))[1] AS digit
  FROM batched GROUP BY doc_id, batch_id),
dead AS (SELECT DISTINCT doc_id FROM asked WHERE digit = '0'),
decided AS (
  SELECT doc_id::VARCHAR AS run_id, batch_id, span_id, text,
    CASE WHEN span_id % 4 <> 0 AND span_id % 3 = 0 THEN 'REMOVE' ELSE 'KEEP' END AS action,
    CASE WHEN span_id % 4 <> 0 THEN 'l' || span_id END AS label
  FROM batched WHERE doc_id NOT IN (SELECT doc_id FROM dead))"""


@query("m10_repair_rounds", f"""WITH {_JUDGED}
SELECT doc_id::VARCHAR AS run_id, batch_id, (CASE WHEN digit = '0' THEN 3 WHEN digit IN ('1', '2', '3') THEN 2 ELSE 1 END)::BIGINT AS attempts, digit <> '0' AS solved
FROM asked""")
def repair_rounds(spark, sf):
    calls = _classified(spark, sf).calls
    return calls.groupBy("run_id", "batch_id").agg(
        F.count(F.lit(1)).alias("attempts"), F.bool_or(F.col("parse_error").isNull()).alias("solved"))


@query("m10_classified_texts", f"""WITH {_JUDGED}
SELECT d.run_id, 0::INT AS part, 's06' AS stage, coalesce(string_agg(text, chr(10) || chr(10) ORDER BY span_id) FILTER (WHERE action = 'KEEP') || chr(10), '') AS text
FROM decided d GROUP BY run_id""")
def classified_texts(spark, sf):
    return _classified(spark, sf).texts


@query("m10_decisions", f"WITH {_JUDGED} SELECT run_id, span_id, action, label FROM decided")
def final_decisions(spark, sf):
    return _classified(spark, sf).extra["decisions"].select("run_id", "span_id", "action", "label")
