"""E and G: replies parsed into rows, blocks clamped and merged."""

from __future__ import annotations

import json
import re

from pyspark.sql import functions as F

from lectern.catalog import base
from lectern.catalog.base import documents, SPANS, query, table
from lectern.operators import blocks as bl, calls as ca, responses as rs, shaping as sh
from lectern.plans import stages as st


def _replies(spark, sf):
    """One reply per document about its lines, in seven spellings by doc_id."""
    spans = sh.spans(documents(spark, sf), ["doc_id"], sep="\n")
    d, i = F.col("doc_id"), F.col("span_id")
    row = F.when(d % 7 == 4, F.struct(
        i.cast("string").alias("spanId"), F.when(i % 3 == 0, " remove ").otherwise("Keep").alias("verdict"),
        F.col("text").alias("extra"))).cast("struct<spanId:string,verdict:string,extra:string>")
    plain = F.struct(i.alias("span_id"), F.when(i % 3 == 0, "REMOVE").otherwise("KEEP").alias("action"), F.col("text").alias("reason"))
    bad = F.struct((i + F.when(d % 2 == 0, F.lit(0.5)).otherwise(F.lit(0.0))).alias("span_id"), F.lit("KEEP").alias("action"))
    text = F.when(d % 7 == 4, F.to_json(row)).when(d % 7 == 6, F.to_json(bad)).otherwise(F.to_json(plain))
    rows = spans.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("span_id", text.alias("j")))).alias("r"))
    listed = F.concat(F.lit("["), F.array_join(F.transform("r", lambda r: r.j), ", "), F.lit("]"))
    return rows.select(
        "doc_id",
        F.when(d % 7 == 1, F.concat(F.lit("Sure!\n```JSON\n"), listed, F.lit("\n```\nDone.")))
        .when(d % 7 == 2, F.concat(F.lit('{"items": 7, "results": '), listed, F.lit("}")))
        .when(d % 7 == 3, F.concat(F.lit("I see [ two ]: "), F.lit('{"data": '), listed, F.lit("} and \"so ] on\"")))
        .when(d % 7 == 5, F.concat(F.lit("cut off: "), F.substring(listed, F.lit(1), F.length(listed) - 1)))
        .otherwise(listed).alias("response"),
    )


# doc_id % 7: 0 plain, 1 fenced, 2 wrapped, 3 the bracket in prose wins and is
# not JSON but the braces are, 4 other key names, 5 truncated so that only its
# first object is readable, 6 fractions.
_GOOD = "(doc_id % 7 IN (0, 1, 2, 3, 4) OR (doc_id % 7 = 6 AND doc_id % 2 = 1))"


@query("e1_reply_verdicts", f"""WITH {SPANS}
SELECT DISTINCT doc_id, CASE WHEN doc_id % 7 = 5 THEN 'LLM response is not a JSON array'
  WHEN {_GOOD} THEN NULL ELSE 'Invalid decision object' END AS parse_error FROM spans""")
def reply_verdicts(spark, sf):
    return rs.parse_decisions(_replies(spark, sf)).select("doc_id", "parse_error")


@query("e2_e3_decisions", f"""WITH {SPANS}
SELECT doc_id, span_id, CASE WHEN doc_id % 7 <> 6 AND span_id % 3 = 0 THEN 'REMOVE' ELSE 'KEEP' END AS action,
       CASE WHEN doc_id % 7 IN (4, 6) THEN NULL ELSE text END AS reason
FROM spans WHERE {_GOOD}""")
def decisions(spark, sf):
    parsed = rs.parse_decisions(_replies(spark, sf))
    return rs.decisions(parsed, ["doc_id"]).select("doc_id", "span_id", "action", "reason")


def _block_replies(spark, sf):
    """Per order, one block per line item; some invalid, some wrapped."""
    items = table(spark, sf, "lineitem")
    n, q = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    block = F.struct(
        F.when(q % 11 == 0, F.lit(0)).otherwise(n).alias("from_paragraph"), (n + q % 4).alias("to_paragraph"),
        F.when(q % 13 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" T"), q.cast("string"))).alias("title"),
        F.concat(F.lit("b"), n.cast("string"), F.lit(" "), F.col("l_partkey").cast("string")).alias("body"))
    # An order may list a line number twice: the part key tells the two apart.
    rows = items.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.to_json(block).alias("j")))).alias("r"))
    listed = F.concat(F.lit("["), F.array_join(F.transform("r", lambda r: r.j), ","), F.lit("]"))
    key = F.col("l_orderkey")
    return rows.select(
        key.alias("run_id"), F.lit(1).alias("batch_id"),
        F.when(key % 5 == 1, F.concat(F.lit("```\n"), listed, F.lit("\n```")))
        .when(key % 5 == 2, F.concat(F.lit('{"blocks":'), listed, F.lit("}")))
        .when(key % 5 == 3, F.lit('{"other": []}')).when(key % 5 == 4, F.concat(F.lit("see "), listed))
        .otherwise(listed).alias("response"))


_BLOCKS = """items AS (
  SELECT l_orderkey AS run_id, l_linenumber AS n, l_quantity::INT AS q, l_partkey,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS arr
  FROM lineitem WHERE l_orderkey % 5 IN (0, 1, 2)),
blocks AS (
  SELECT run_id, arr, n AS from_p, n + q % 4 AS to_p, 'T' || q AS title, 'b' || n || ' ' || l_partkey AS body
  FROM items WHERE q % 11 <> 0 AND q % 13 <> 0)"""


@query("e4_blocks", f"WITH {_BLOCKS} SELECT run_id, from_p::INT AS from_p, to_p::INT AS to_p, title, body FROM blocks")
def blocks(spark, sf):
    parsed = rs.parse_blocks(_block_replies(spark, sf))
    return rs.blocks(parsed, ["run_id"]).drop("pos")


@query("e5_clamped_blocks", f"""WITH {_BLOCKS}
SELECT run_id, greatest(2, from_p)::INT AS from_p, least(5, to_p)::INT AS to_p, title FROM blocks WHERE greatest(2, from_p) <= least(5, to_p)""")
def clamped(spark, sf):
    found = rs.blocks(rs.parse_blocks(_block_replies(spark, sf)), ["run_id"])
    windowed = found.withColumns({"start_paragraph": F.lit(2), "end_paragraph": F.lit(5)})
    return rs.clamp_blocks(windowed).select("run_id", "from_p", "to_p", "title")


def _raw_blocks(spark, sf):
    n, q = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("run_id"), n.alias("from_p"), (n + q % 4).alias("to_p"),
        F.concat(F.lit("T"), F.repeat(F.lit("x"), q % 5)).alias("title"),
        F.concat(F.lit("b"), n.cast("string"), F.lit(" "), F.col("l_partkey").cast("string")).alias("body"),
        F.col("l_partkey").alias("batch_id"), F.col("l_suppkey").alias("pos"), F.col("l_extendedprice").alias("price"))


_MERGE = """b AS (
  SELECT l_orderkey AS run_id, l_linenumber AS f, l_linenumber + l_quantity::INT % 4 AS t, 'T' || repeat('x', l_quantity::INT % 5) AS title,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_linenumber + l_quantity::INT % 4, l_partkey, l_suppkey, l_extendedprice) AS o FROM lineitem),
m AS (SELECT *, max(t) OVER (PARTITION BY run_id ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM b),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR f > reach THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY o) AS island FROM m),
merged AS (
  SELECT run_id, min(f)::INT AS from_p, CASE WHEN count(*) > 1 THEN least(7, max(t)) ELSE max(t) END::INT AS to_p,
         arg_max(title, length(title) * 1000 - o) AS title FROM g GROUP BY run_id, island)"""


def _merged(**kw):
    def run(spark, sf):
        rows = _raw_blocks(spark, sf).withColumn("n", F.lit(7))
        return bl.merge_blocks(rows, arrival=("batch_id", "pos", "price"), cap="n", **kw).select("run_id", "from_p", "to_p", "title")
    return run


query("g1_merged_blocks", f"WITH {_MERGE} SELECT * FROM merged")(_merged())
query("g1_merged_blocks_sliced", f"WITH {_MERGE} SELECT * FROM merged")(_merged(slice_rows=2))


@query("g1_merged_bodies", """WITH b AS (
  SELECT l_orderkey AS run_id, l_linenumber AS f, l_linenumber + l_quantity::INT % 4 AS t, 'b' || l_linenumber || ' ' || l_partkey AS body,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_linenumber + l_quantity::INT % 4, l_partkey, l_suppkey, l_extendedprice) AS o FROM lineitem),
m AS (SELECT *, max(t) OVER (PARTITION BY run_id ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM b),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR f > reach THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY o) AS island FROM m)
SELECT run_id, min(f)::INT AS from_p, list_reduce(list(body ORDER BY o), lambda a, x:
  CASE WHEN contains(a, x) THEN a WHEN contains(x, a) THEN x ELSE a || chr(10) || chr(10) || x END) AS body
FROM g GROUP BY run_id, island""")
def merged_bodies(spark, sf):
    return bl.merge_blocks(_raw_blocks(spark, sf), arrival=("batch_id", "pos", "price")).select("run_id", "from_p", "body")


@query("g2_fallback_blocks", f"""WITH {base.WINDOWS}
SELECT doc_id AS run_id, min(span_id)::INT AS from_p, max(span_id)::INT AS to_p, 'Section ' || (k + 1)::INT AS title,
       string_agg(text, ' ' ORDER BY span_id) AS body
FROM placed WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) GROUP BY doc_id, k""")
def fallback(spark, sf):
    """Runs that already have a block: the documents labelled toxic."""
    paragraphs = sh.spans(documents(spark, sf).withColumnRenamed("doc_id", "run_id"), ["run_id"], sep="\n")
    have = table(spark, sf, "labels").filter("toxic = 1").select(F.col("doc_id").alias("run_id"))
    return bl.fallback_blocks(paragraphs, have)


class Summarizer:
    """Map: one block per window over its first half; even windows answer {}.

    Reduce: bodies under headings, or headings only, which makes the stage
    fall back to the bodies.
    """

    def generate(self, model, prompt, temperature):
        if prompt.startswith("Reduce:\n"):
            blocks = json.loads(prompt.split("\n", 1)[1])
            if len(blocks) % 2:
                return ca.Reply("\n".join(f"## Block {i}: {b['title']}" for i, b in enumerate(blocks)))
            return ca.Reply("\n".join(f"## Block {i}: {b['title']}\n{b['body']}" for i, b in enumerate(blocks)))
        ids = [int(n) for n in re.findall(r"^\[(\d+)\] ", prompt, re.M)]
        if (ids[0] - 1) // 7 % 2:
            return ca.Reply("{}")
        half = ids[len(ids) // 2]
        block = {"from_paragraph": max(1, ids[0] - 2), "to_paragraph": half, "title": f"T{ids[0]}", "body": f"Body {ids[0]}-{half}"}
        return ca.Reply("```json\n" + json.dumps({"blocks": [block]}) + "\n```")


def _condensed(spark, sf):
    texts = documents(spark, sf).select(F.col("doc_id").cast("string").alias("run_id"), "text")
    return st.condense(texts, "Map:\n{{paragraph_lines}}", "Reduce:\n{{candidate_blocks_json}}", st.ModelSetup(Summarizer, "m"), sep="\n")


_CONDENSED = base.WINDOWS + """,
w AS (SELECT doc_id, k, list(span_id ORDER BY span_id) AS ids FROM placed GROUP BY doc_id, k),
b AS (SELECT doc_id, k, ids[1] AS f, ids[len(ids) // 2 + 1] AS t FROM w WHERE k % 2 = 0),
n AS (SELECT doc_id, count(*) AS c FROM b GROUP BY doc_id)"""


@query("g3_condensed_blocks", f"""WITH {_CONDENSED}
SELECT doc_id::VARCHAR AS run_id, f::INT AS from_p, t::INT AS to_p, 'T' || f AS title, 'Body ' || f || '-' || t AS body FROM b""")
def condensed_blocks(spark, sf):
    return _condensed(spark, sf).extra["blocks"]


@query("g3_condensed_texts", f"""WITH {_CONDENSED}
SELECT doc_id::VARCHAR AS run_id, 0::INT AS part, 's08' AS stage,
  CASE WHEN c % 2 = 1 THEN string_agg('Body ' || f || '-' || t, chr(10) || chr(10) ORDER BY f)
       ELSE string_agg('Body ' || f || '-' || t, chr(10) ORDER BY f) END || chr(10) AS text
FROM b JOIN n USING (doc_id) GROUP BY doc_id, c""")
def condensed_texts(spark, sf):
    return _condensed(spark, sf).texts
