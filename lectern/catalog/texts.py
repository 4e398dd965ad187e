"""B: paragraphs, sentences, chunks, batches, windows, prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern import schemas as S
from lectern.catalog import base
from lectern.catalog.base import documents, query, sql_batches, sql_chunks, sql_strip, sql_wrap, table
from lectern.operators import prompts as pr, shaping as sh


@query("b1_paragraphs", f"WITH {base.SPANS} SELECT doc_id, span_id, text FROM spans")
def paragraphs(spark, sf):
    return sh.spans(documents(spark, sf), ["doc_id"], sep="\n")


@query("b2_sentences", f"""WITH {base.SPANS},
parts AS (
  SELECT doc_id, span_id, list_filter(list_transform(
    string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)),
    lambda x: {sql_strip('x')}), lambda x: x <> '') AS xs
  FROM spans)
SELECT doc_id, span_id, generate_subscripts(xs, 1)::INT AS sentence_id, unnest(xs) AS sentence FROM parts""")
def sentences(spark, sf):
    return sh.sentences(sh.spans(documents(spark, sf), ["doc_id"], sep="\n"), ["doc_id", "span_id"])


@query("b3_wrapped_paragraphs", f"""WITH {base.SPANS},
folded AS (SELECT *, CASE WHEN length(text) > 500 THEN {sql_wrap('text', 500)} END AS f FROM spans),
lists AS (
  SELECT doc_id, span_id, CASE WHEN f IS NULL THEN [text]
    ELSE list_concat(f.out, CASE WHEN f.cur = '' THEN []::VARCHAR[] ELSE [f.cur] END) END AS ps
  FROM folded)
SELECT doc_id, span_id, generate_subscripts(ps, 1)::INT AS piece_id, unnest(ps) AS piece FROM lists""")
def wrapped(spark, sf):
    spans = sh.spans(documents(spark, sf), ["doc_id"], sep="\n")
    return sh.wrapped(spans, ["doc_id", "span_id"], 500)


def _chunked(max_chars):
    def run(spark, sf):
        return sh.text_chunks(documents(spark, sf), ["doc_id"], max_chars, sep="\n")
    return run


query("b4_text_chunks", f"WITH {sql_chunks(6000)} SELECT doc_id, chunk_id, text FROM chunks")(_chunked(6000))
query("b4_text_chunks_tight", f"WITH {sql_chunks(300)} SELECT doc_id, chunk_id, text FROM chunks")(_chunked(300))


def _batched(size, chars, **kw):
    def run(spark, sf):
        spans = sh.spans(documents(spark, sf), ["doc_id"], sep="\n")
        return sh.span_batches(spans, "doc_id", size, chars, **kw).select("doc_id", "span_id", "batch_id")
    return run


query("b5_span_batches", f"WITH {sql_batches(40, 8000)} SELECT doc_id, span_id, batch_id FROM batched")(_batched(40, 8000))
# Slices of 16 spans force the chained form that long runs use.
query("b5_span_batches_sliced", f"WITH {sql_batches(5, 1500)} SELECT doc_id, span_id, batch_id FROM batched")(
    _batched(5, 1500, slice_rows=16))


def _windows(spark, sf):
    return sh.windows(sh.spans(documents(spark, sf), ["doc_id"], sep="\n"), "doc_id")


@query("b6_overlapping_windows", f"""WITH {base.WINDOWS}
SELECT doc_id, (k + 1)::INT AS batch_id, min(span_id)::INT AS start_paragraph,
       max(span_id)::INT AS end_paragraph, count(*)::INT AS paragraphs
FROM placed GROUP BY doc_id, k""")
def windows(spark, sf):
    return _windows(spark, sf).select(
        "doc_id", "batch_id", "start_paragraph", "end_paragraph", F.size("rows").alias("paragraphs"))


@query("b7_numbered_lines", f"""WITH {base.WINDOWS}
SELECT doc_id, (k + 1)::INT AS batch_id,
       string_agg('[' || span_id || '] ' || text, chr(10) ORDER BY span_id) AS lines
FROM placed GROUP BY doc_id, k""")
def numbered_lines(spark, sf):
    return _windows(spark, sf).select("doc_id", "batch_id", sh.render_lines(F.col("rows")).alias("lines"))


@query("b8_reassembly", f"""WITH j AS (
  SELECT conv_id, {sql_strip("string_agg(text, chr(10) || chr(10) ORDER BY turn)")} AS t
  FROM conversations GROUP BY conv_id)
SELECT conv_id, 0::INT AS part, CASE WHEN t = '' THEN '' ELSE t || chr(10) END AS text FROM j""")
def reassembly(spark, sf):
    return sh.reassemble(table(spark, sf, "conversations"), ["conv_id"], "turn")


@query("b8_reassembly_parts", """WITH j AS (
  SELECT conv_id, turn // 3 AS p, max(turn // 3) OVER (PARTITION BY conv_id) AS lastp, turn, text FROM conversations)
SELECT conv_id, p::INT AS part,
       string_agg(trim(text, ' ' || chr(10)), chr(10) || chr(10) ORDER BY turn)
         || CASE WHEN p = any_value(lastp) THEN chr(10) ELSE '' END AS text
FROM j GROUP BY conv_id, p""")
def reassembly_parts(spark, sf):
    """The form long runs take: several parts per text."""
    turns = table(spark, sf, "conversations").withColumn("text", F.trim(F.regexp_replace("text", r"\A\n+|\n+\z", "")))
    return sh.reassemble(turns, ["conv_id"], "turn", part_rows=3)


@query("b9_block_headings", f"""SELECT conv_id, turn,
  CASE WHEN turn % 3 = 0 THEN 'said by ' || role ELSE {sql_strip('text')} END AS text
FROM conversations""")
def block_headings(spark, sf):
    head = F.concat(F.lit("  ## Block 0"), F.col("turn").cast("string"), F.lit(": Title\n"))
    reply = F.when(F.col("turn") % 3 == 0, F.concat(head, head)).otherwise(F.concat(head, F.col("text"), F.lit("\n"), head))
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", sh.final_condensed(reply, F.concat(F.lit("said by "), F.col("role"))).alias("text"))


@query("b10_prompts", """SELECT doc_id, source,
  CASE lang WHEN 'en' THEN 'Clean:' || chr(10) || text
            WHEN 'fr' THEN text || ' (' || source || ')'
            ELSE '{' || source || '} ' || text || ' / ' || text END AS prompt
FROM documents""")
def prompts(spark, sf):
    docs = documents(spark, sf)
    body = F.when(F.col("name") == "en", "Clean:\n{{text}}").when(
        F.col("name") == "fr", "{{text}} ({{source}})").otherwise("{{{source}}} {{text}} / {{text}}")
    templates = docs.select(F.col("lang").alias("name")).distinct().withColumn("body", body)
    return pr.render(docs, templates, {"source": F.col("source"), "text": F.col("text")}, on="lang").select(
        "doc_id", "source", "prompt")


_KEYS = list(S.TEMPLATE_CATALOG)
_KEY_SQL = "[" + ", ".join(f"'{k}'" for k in _KEYS) + "]"
_NAMED = f"""named AS (
  SELECT doc_id, n_chars * 1000000000 + doc_id AS prio, {_KEY_SQL}[doc_id % 8 + 1] AS key,
         CASE WHEN doc_id % 8 IN (6, 7) AND n_chars % 2 = 0 THEN 1 ELSE 0 END AS age,
         text || CASE lang WHEN 'en' THEN ' {{{{text}}}}' WHEN 'fr' THEN ' {{{{oops}}}} {{{{text}}}}' ELSE '' END AS body
  FROM documents),
best AS (SELECT key, arg_min(doc_id, prio) AS doc_id FROM named GROUP BY key)"""
_NAMED = _NAMED.replace("{{{{", "{{").replace("}}}}", "}}")


def _templates(spark, sf):
    """One template folder per document; shorter documents come first."""
    docs = documents(spark, sf)
    key = F.element_at(F.array(*[F.lit(k) for k in _KEYS]), (F.col("doc_id") % 8 + 1).cast("int"))
    old = (F.col("doc_id") % 8 >= 6) & (F.col("n_chars") % 2 == 0)
    name = key
    for current, (older,) in S.LEGACY_TEMPLATE_NAMES.items():
        name = F.when(old & (key == current), older).otherwise(name)
    tail = F.when(F.col("lang") == "en", " {{text}}").when(F.col("lang") == "fr", " {{oops}} {{text}}").otherwise("")
    return docs.select(
        F.concat(F.lit("root"), F.col("doc_id").cast("string")).alias("root"),
        (F.col("n_chars") * 1_000_000_000 + F.col("doc_id")).alias("root_priority"), name.alias("name"), F.concat("text", tail).alias("body"))


@query("b11_template_choice", f"""WITH {_NAMED}
SELECT key AS template_key, 'root' || doc_id AS root, body FROM best JOIN named USING (key, doc_id)""")
def template_choice(spark, sf):
    return pr.resolve_templates(_templates(spark, sf)).select("template_key", "root", "body")


@query("b11_template_audit", f"""WITH {_NAMED}, cat AS (
  SELECT unnest({_KEY_SQL}) AS key, unnest([{', '.join("['" + "','".join(n) + "']" for _, n in S.TEMPLATE_CATALOG.values())}]) AS names),
f AS (
  SELECT key, names, list_sort(list_distinct(regexp_extract_all(body, '\\{{\\{{([a-zA-Z_][a-zA-Z0-9_]*)\\}}\\}}', 1))) AS found
  FROM best JOIN named USING (key, doc_id) JOIN cat USING (key)),
g AS (
  SELECT key, array_to_string(list_filter(found, lambda x: NOT list_contains(names, x)), ',') AS unknown,
         array_to_string(list_sort(list_filter(names, lambda x: NOT list_contains(found, x))), ',') AS missing FROM f)
SELECT key AS template_key, unknown, missing,
  CASE WHEN unknown <> '' THEN 'reject' WHEN missing <> '' THEN 'warn' ELSE 'ok' END AS verdict FROM g""")
def template_audit(spark, sf):
    audit = pr.audit_templates(pr.resolve_templates(_templates(spark, sf)), pr.catalog(spark))
    return audit.select("template_key", F.array_join("unknown", ",").alias("unknown"),
                        F.array_join("missing", ",").alias("missing"), "verdict")
