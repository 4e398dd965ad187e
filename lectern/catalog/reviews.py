"""Decisions applied, sentence reviews, reports, line changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.catalog.base import documents, query, sql_strip, table
from lectern.operators import review as rv


def _doc_spans(spark, sf):
    """Run = source, span = document (ids are sparse), batch = language."""
    return documents(spark, sf).select(
        F.col("source").alias("run_id"), F.col("lang").alias("batch_id"),
        F.col("doc_id").alias("span_id"), F.regexp_replace("text", "\n", " ").alias("text"))


def _decisions(spark, sf):
    """Labels as decisions, given twice: the second one (toxic) counts."""
    labels = table(spark, sf, "labels").join(_doc_spans(spark, sf).drop("text"), F.col("doc_id") == F.col("span_id"))
    action = F.when(F.col("toxic") == 1, "REMOVE").otherwise("KEEP")
    first = F.struct(F.lit(0).alias("pos"), F.lit("REMOVE").alias("action"), F.lit("first").alias("label"))
    second = F.struct(F.lit(1).alias("pos"), action.alias("action"), F.concat(F.lit("q"), F.col("quality").cast("string")).alias("label"))
    return labels.select("run_id", "batch_id", "span_id", F.explode(F.array(second, first)).alias("d")).select(
        "run_id", "batch_id", "span_id", "d.pos", "d.action", "d.label", F.lit(None).cast("string").alias("reason"))


def _decided(spark, sf):
    return rv.apply_decisions(_doc_spans(spark, sf), _decisions(spark, sf))


_DECIDED = f"""decided AS (
  SELECT source AS run_id, d.doc_id AS span_id, replace(text, chr(10), ' ') AS text,
         CASE WHEN toxic = 1 THEN 'REMOVE' ELSE 'KEEP' END AS action, 'q' || quality AS label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
parts AS (
  SELECT *, list_filter(list_transform(string_split(regexp_replace({sql_strip('text')}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)),
    lambda x: {sql_strip('x')}), lambda x: x <> '') AS xs FROM decided),
sents AS (
  SELECT run_id, span_id, action, label, generate_subscripts(xs, 1)::INT AS sentence_id, unnest(xs) AS sentence FROM parts)"""


@query("f1_applied_decisions", f"WITH {_DECIDED} SELECT run_id, span_id, action, label FROM decided")
def applied(spark, sf):
    return _decided(spark, sf).select("run_id", "span_id", "action", "label")


@query("f2_kept_spans", "SELECT doc_id AS span_id, source AS run_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def kept(spark, sf):
    last = _decisions(spark, sf).filter("pos = 1")
    return rv.split_spans(_doc_spans(spark, sf), last)[0].select("run_id", "span_id")


@query("f2_removed_spans", f"WITH {_DECIDED} SELECT run_id, span_id, label, text FROM decided WHERE action = 'REMOVE'")
def removed(spark, sf):
    return rv.removed(_decided(spark, sf)).select("run_id", "span_id", "label", "text")


@query("f3_sentence_review", f"WITH {_DECIDED} SELECT run_id, span_id, sentence_id, action, label, sentence FROM sents")
def sentence_review(spark, sf):
    return rv.sentence_table(_decided(spark, sf)).drop("reason")


@query("f4_review_counts", f"""WITH {_DECIDED} SELECT run_id, count(*) AS sentences, count(*) FILTER (WHERE action = 'KEEP') AS keep,
  count(*) FILTER (WHERE action = 'REMOVE') AS remove FROM sents GROUP BY run_id""")
def review_counts(spark, sf):
    return rv.review_counts(rv.sentence_table(_decided(spark, sf)))


def _cell(x, css=""):
    esc = f"replace(replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"
    return f"'        <td{css}>' || {esc} || '</td>' || chr(10)"


def _quoted(text):
    return "'" + text.replace("'", "''") + "'"


_ROW = f"""'      <tr class="status-' || action || '">' || chr(10) || {_cell('no::VARCHAR')} || {_cell('span_id::VARCHAR')} || {_cell('action', ' class="status"')}
  || {_cell("coalesce(label, '')")} || {_cell("''")} || {_cell('sentence')} || '      </tr>'"""


@query("f5_review_report", f"""WITH {_DECIDED},
n AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY span_id, sentence_id) AS no FROM sents),
b AS (SELECT run_id, count(*) AS c, count(*) FILTER (WHERE action = 'KEEP') AS k, string_agg({_ROW}, chr(10) ORDER BY no) AS body FROM n GROUP BY run_id)
SELECT run_id, 0::INT AS part, {_quoted(rv._HEAD)} || chr(10) || '  <p class="summary">sentences: ' || c || ' | KEEP: ' || k || ' | REMOVE: ' || (c - k) || '</p>'
  || chr(10) || {_quoted(rv._TABLE)} || chr(10) || body || chr(10) || {_quoted(rv._TABLE_END)} || chr(10) || {_quoted(rv._FOOT)} || chr(10) AS text
FROM b""")
def review_report(spark, sf):
    # The page of a whole source can pass 2 GB at larger scales, more than a value holds.
    return rv.review_report(rv.sentence_table(_decided(spark, sf)), _doc_spans(spark, sf).select("run_id"), page_bytes=rv.PAGE_BYTES)


@query("f6_line_changes", """WITH b AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
a AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 AND line LIKE '%.' THEN line || '!' ELSE line END AS line FROM (SELECT DISTINCT doc_id, line FROM b)),
gone AS (SELECT * FROM b EXCEPT ALL SELECT * FROM a), fresh AS (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
SELECT doc_id, line, 'removed' AS change, count(*) AS times FROM gone GROUP BY ALL
UNION ALL SELECT doc_id, line, 'added', count(*) FROM fresh GROUP BY ALL""")
def line_changes(spark, sf):
    """After: lines without exact repeats; a mark added in every other document."""
    docs = documents(spark, sf).select("doc_id", "text")
    marked = F.transform(F.array_distinct(F.split("text", "\n")), lambda x: F.when(
        (F.col("doc_id") % 2 == 0) & x.endswith("."), F.concat(x, F.lit("!"))).otherwise(x))
    return rv.line_changes(docs, docs.withColumn("text", F.array_join(marked, "\n")), ["doc_id"])
