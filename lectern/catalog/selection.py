"""Fingerprints, signatures, unchanged work, sources, ids."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lectern.catalog.base import query, sql_chunks, table
from lectern.catalog.calls import Echo
from lectern.operators import incremental as inc
from lectern.plans import run as rn, stages as st
from lectern.session import shared_folder


@query("a2_artifacts", """SELECT url || '#' || page_id AS path, sha256(html) AS sha256, strlen(html)::BIGINT AS bytes FROM pages""")
def artifacts(spark, sf):
    pages = table(spark, sf, "pages").select(F.concat_ws("#", "url", F.col("page_id").cast("string")).alias("path"), "html")
    return inc.artifacts(pages, "html")


def _manifests(spark, sf):
    """One attempt per order of a customer: status from the order status."""
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "failed").otherwise("skipped")
    stage = F.concat(F.lit("s0"), (F.col("o_orderkey") % 3 + 6).cast("string"))
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("run_id"), stage.alias("stage"), status.alias("status"),
        F.struct("o_orderdate", "o_orderkey").alias("finished_at"),
        F.create_map(F.lit("priority"), F.col("o_orderpriority"), F.lit("a"), F.lit("1")).alias("params"),
        F.sha2(F.floor("o_totalprice").cast("bigint").cast("string"), 256).alias("inputs_signature"), "o_orderkey", "o_totalprice")


_LATEST = """m AS (
  SELECT o_custkey AS run_id, 's0' || (o_orderkey % 3 + 6) AS stage, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' ELSE 'skipped' END AS status,
         o_orderpriority AS priority, floor(o_totalprice)::BIGINT AS price, o_orderkey,
         row_number() OVER (PARTITION BY o_custkey, o_orderkey % 3 ORDER BY CASE WHEN o_orderstatus IN ('F', 'O') THEN 0 ELSE 1 END, o_orderdate DESC, o_orderkey DESC) AS rn FROM orders),
latest AS (SELECT * FROM m WHERE rn = 1 AND status <> 'skipped')"""


def _candidates(spark, sf):
    """Every manifest seen again; every other one with a changed input."""
    rows = _manifests(spark, sf)
    changed = F.when(F.col("o_orderkey") % 2 == 0, F.lit("changed")).otherwise(F.col("inputs_signature"))
    flipped = F.create_map(F.lit("a"), F.lit("1"), F.lit("priority"), F.try_element_at("params", F.lit("priority")))
    return rows.select("run_id", "stage", "o_orderkey", flipped.alias("params"), changed.alias("inputs_signature"))


@query("f8_work_selection", f"""WITH {_LATEST}
SELECT c.run_id, c.stage, c.o_orderkey FROM m c WHERE NOT EXISTS (
  SELECT 1 FROM latest l WHERE l.run_id = c.run_id AND l.stage = c.stage AND l.status = 'success'
    AND l.priority = c.priority AND l.price = c.price AND c.o_orderkey % 2 = 1)""")
def work_selection(spark, sf):
    return inc.select_work(_candidates(spark, sf), _manifests(spark, sf)).select("run_id", "stage", "o_orderkey")


@query("f8_second_run", f"""WITH documents AS (
  SELECT d.doc_id, d.source, d.lang, l.doc_id IS NOT NULL AS revised,
         CASE WHEN l.doc_id IS NOT NULL THEN d.text || chr(10) || 'Revised.' ELSE d.text END AS text
  FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)),
{sql_chunks(6000)},
told AS (
  SELECT doc_id, count(*) AS n, string_agg('[m] Edit:' || chr(10) || text, chr(10) || chr(10) ORDER BY chunk_id) || chr(10) AS text
  FROM chunks GROUP BY doc_id)
SELECT d.doc_id::VARCHAR AS run_id, CASE WHEN revised THEN 'success' ELSE 'skipped' END AS status,
  CASE WHEN revised THEN coalesce(n, 0) ELSE 0 END::BIGINT AS calls, coalesce(t.text, '') AS text
FROM documents d LEFT JOIN told t USING (doc_id)""".replace("WITH split AS", "split AS"))
def second_run(spark, sf):
    """All documents are edited; then the labelled ones, revised since, and no others are edited again."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("doc_id").cast("string").alias("run_id"), "text")
    labelled = table(spark, sf, "labels").select("doc_id", F.lit(True).alias("_revised")).distinct()
    revised = docs.join(labelled, "doc_id", "left").withColumn(
        "text", F.when(F.col("_revised"), F.concat("text", F.lit("\nRevised."))).otherwise(F.col("text")))
    setup, template = st.ModelSetup(Echo, "m"), "Edit:\n{{text}}"
    step = rn.Step("s07", lambda t: st.text_transform(t, "s07", template, setup, sep="\n"), rn.model_params(setup, template))
    folder = f"{shared_folder(spark)}/second-run-{uuid.uuid4().hex}"
    rn.run_stage(docs.select("run_id", "text"), step, folder, buckets=16)
    done = rn.run_stage(revised.select("run_id", "text"), step, folder, buckets=16)
    made = done.calls.groupBy("run_id").agg(F.count(F.lit(1)).alias("calls"))
    stored = rn.stored_texts(spark, folder, "s07").select("run_id", "text")
    return done.manifests.select("run_id", "status").join(stored, "run_id", "left").join(made, "run_id", "left").select(
        "run_id", "status", F.coalesce("calls", F.lit(0)).cast("bigint").alias("calls"), "text")


@query("f9_input_signatures", """WITH e AS (SELECT DISTINCT source AS run_id, 's0' || doc_id % 3 AS stage, lang || '/' || doc_id AS path, doc_id FROM documents),
f AS (SELECT d.lang || '/' || d.doc_id AS path, sha256(d.text) AS sha FROM documents d WHERE doc_id IN (SELECT doc_id FROM labels))
SELECT run_id, stage, string_agg(path || ':' || coalesce(sha, '<missing>'), chr(10) ORDER BY path) AS inputs_signature
FROM e LEFT JOIN f USING (path) GROUP BY run_id, stage""")
def input_signatures(spark, sf):
    docs = table(spark, sf, "documents").withColumn("path", F.concat_ws("/", "lang", F.col("doc_id").cast("string")))
    expected = docs.select(F.col("source").alias("run_id"), F.concat(F.lit("s0"), (F.col("doc_id") % 3).cast("string")).alias("stage"), "path")
    found = inc.artifacts(docs.join(table(spark, sf, "labels"), "doc_id", "left_semi"), "text")
    return inc.input_signatures(expected, found)


@query("f7_fresh_source", f"""WITH {_LATEST}
SELECT c.c_custkey AS run_id, CASE WHEN l.status = 'success' AND l.price % 10 < 5 AND c.c_custkey % 4 <> 0 THEN 's08' ELSE 's07' END AS input_source_stage,
  CASE WHEN l.status = 'success' AND l.price % 10 < 5 AND c.c_custkey % 4 <> 0 THEN 'condensed ' ELSE 'edited ' END || c_name AS text
FROM customer c LEFT JOIN latest l ON l.run_id = c.c_custkey AND l.stage = 's08'""")
def fresh_source(spark, sf):
    """Edited text per customer; its signature matches for low last digits."""
    customers = table(spark, sf, "customer")
    manifests = _manifests(spark, sf).withColumn(
        "inputs_signature", F.when(F.floor("o_totalprice") % 10 < 5, F.lit("now")).otherwise(F.lit("then")))
    edited = customers.select(F.col("c_custkey").alias("run_id"), F.concat(F.lit("edited "), F.col("c_name")).alias("text"), F.lit("now").alias("signature"))
    condensed = customers.filter("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("run_id"), F.concat(F.lit("condensed "), F.col("c_name")).alias("text"))
    return inc.fresh_source(edited, condensed, manifests)


@query("f10_best_output", """WITH t AS (SELECT DISTINCT o_custkey AS run_id, o_orderkey % 5 + 6 AS n FROM orders)
SELECT run_id, CASE WHEN max(n) = 10 THEN 's10' ELSE 's0' || max(n) END AS stage FROM t WHERE n >= 7 GROUP BY run_id""")
def best_output(spark, sf):
    stages = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("run_id"), F.format_string("s%02d", F.col("o_orderkey") % 5 + 6).alias("stage")).distinct()
    return inc.best_output(stages)


def _paths(spark, sf):
    """Pages as recordings; many share a stem, some stems are empty or accented."""
    stem = F.concat(F.regexp_extract("url", r"//([^./]+)", 1), F.lit(" é"), F.when(F.col("page_id") % 3 == 0, F.lit("!")).otherwise(F.lit("")))
    stem = F.when(F.col("page_id") % 11 == 0, F.lit("_-_")).otherwise(stem)
    return table(spark, sf, "pages").select(F.concat(F.format_string("/in/%09d/", "page_id"), stem, F.lit(".MP3")).alias("path"), "page_id")


_IDS = r"""p AS (
  SELECT page_id, CASE WHEN page_id % 11 = 0 THEN 'audio' ELSE lower(regexp_extract(url, '//([^./]+)', 1)) END AS base,
    printf('/in/%09d/', page_id) || CASE WHEN page_id % 11 = 0 THEN '_-_' ELSE regexp_extract(url, '//([^./]+)', 1) || ' é' || CASE WHEN page_id % 3 = 0 THEN '!' ELSE '' END END || '.MP3' AS path
  FROM pages),
k AS (SELECT path, 'known-' || page_id || '-x' AS run_id FROM p WHERE page_id % 10 = 7),
t AS (SELECT DISTINCT base AS name FROM p WHERE page_id % 4 = 1 UNION SELECT DISTINCT base || '-3' FROM p WHERE page_id % 4 = 2),
n AS (SELECT path, base, row_number() OVER (PARTITION BY base ORDER BY path) AS n FROM p WHERE page_id % 10 <> 7),
s AS (SELECT base, generate_series AS s FROM (SELECT base, count(*) AS c FROM n GROUP BY base), generate_series(1, c + 2)),
free AS (
  SELECT base, s, row_number() OVER (PARTITION BY base ORDER BY s) AS n FROM s
  WHERE (CASE WHEN s = 1 THEN base ELSE base || '-' || s END) NOT IN (SELECT name FROM t))"""


def _assigned(spark, sf, **kw):
    paths = _paths(spark, sf)
    known = paths.filter("page_id % 10 = 7").select("path", F.format_string("known-%d-x", "page_id").alias("run_id"))
    base = inc.tx.run_name(inc.file_stem(F.col("path")))
    taken = paths.filter("page_id % 4 = 1").select(base.alias("name")).union(
        paths.filter("page_id % 4 = 2").select(F.concat(base, F.lit("-3")).alias("name")))
    return inc.assign_run_ids(paths, known, taken, **kw)


_IDS_SQL = f"""WITH {_IDS}
SELECT path, run_id, false AS is_new FROM k
UNION ALL SELECT path, CASE WHEN s = 1 THEN base ELSE base || '-' || s END, true FROM n JOIN free USING (base, n)"""
query("f11_stable_ids", _IDS_SQL)(lambda spark, sf: _assigned(spark, sf))
query("f11_stable_ids_sliced", _IDS_SQL)(lambda spark, sf: _assigned(spark, sf, slice_rows=16))


@query("f11_ids_with_clashes", """WITH p AS (
  SELECT lower(regexp_extract(url, '//([^./]+)', 1)) || CASE page_id % 3 WHEN 0 THEN '' WHEN 1 THEN '-2' ELSE '-3' END AS base,
         regexp_extract(url, '//([^./]+)', 1) || CASE page_id % 3 WHEN 0 THEN '' WHEN 1 THEN '-2' ELSE '-3' END AS stem, page_id FROM pages),
w AS (
  SELECT list_reduce(list({'n': base, 'p': printf('/in/%09d/', page_id) || stem || '.wav', 'used': []::VARCHAR[], 'out': []::VARCHAR[]} ORDER BY printf('/in/%09d/', page_id)),
    lambda a, x: {'n': '', 'p': '', 'used': list_append(a.used, CASE WHEN NOT list_contains(a.used, x.n) THEN x.n
        ELSE x.n || '-' || list_filter(range(2, len(a.used) + 3), lambda k: NOT list_contains(a.used, x.n || '-' || k))[1] END),
      'out': list_append(a.out, x.p)},
    {'n': '', 'p': '', 'used': []::VARCHAR[], 'out': []::VARCHAR[]}) AS r FROM p)
SELECT unnest(r.out) AS path, unnest(r.used) AS run_id, true AS is_new FROM w""")
def clashing_ids(spark, sf):
    """Stems that equal another stem's suffixed name ('a-2' next to 'a')."""
    stem = F.concat(F.regexp_extract("url", r"//([^./]+)", 1), F.when(
        F.col("page_id") % 3 > 0, F.concat(F.lit("-"), (F.col("page_id") % 3 + 1).cast("string"))).otherwise(F.lit("")))
    paths = table(spark, sf, "pages").select(F.concat(F.format_string("/in/%09d/", "page_id"), stem, F.lit(".wav")).alias("path"))
    return inc.assign_run_ids(paths, spark.createDataFrame([], "path STRING, run_id STRING"))


@query("f12_mapping_problems", """WITH m AS (
  SELECT c_name AS path, CASE WHEN c_custkey % 97 = 0 THEN '..' WHEN c_custkey % 89 = 0 THEN c_mktsegment || '/x' WHEN c_custkey % 5 = 0 THEN 'id' || c_custkey // 10 ELSE 'id-' || c_custkey END AS run_id FROM customer)
SELECT run_id, 'invalid name' AS problem, count(*) AS paths FROM m WHERE run_id = '..' OR run_id LIKE '%/%' GROUP BY run_id
UNION ALL SELECT run_id, 'duplicate assignment', count(*) FROM m GROUP BY run_id HAVING count(*) > 1""")
def mapping_problems(spark, sf):
    k = F.col("c_custkey")
    name = F.when(k % 97 == 0, "..").when(k % 89 == 0, F.concat("c_mktsegment", F.lit("/x"))).when(
        k % 5 == 0, F.concat(F.lit("id"), F.floor(k / 10).cast("string"))).otherwise(F.concat(F.lit("id-"), k.cast("string")))
    return inc.mapping_problems(table(spark, sf, "customer").select(F.col("c_name").alias("path"), name.alias("run_id")))
