"""Registry and shared pieces of the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.session import ARROW_BYTES, ship_package
from lectern.sources.files import deal_out

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
            ship_package(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deal_out(table(spark, sf_dir, "documents"), "doc_id")


# -- SQL building blocks ------------------------------------------------------


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


# Lines of each document, numbered after dropping blank ones.
SPLIT = f"""split AS (
  SELECT doc_id, source, lang,
         list_filter(list_transform(string_split(text, chr(10)), lambda x: {sql_strip('x')}),
                     lambda x: x <> '') AS xs
  FROM documents)"""
SPANS = SPLIT + """,
spans AS (
  SELECT doc_id, source, lang, unnest(xs) AS text, generate_subscripts(xs, 1)::INT AS span_id
  FROM split)"""


def sql_wrap(p: str, cap: int) -> str:
    """Word-greedy pieces of one paragraph, as a list."""
    cuts = f"list_transform(range(1, length(b.cur)+1, {cap}), lambda i: substring(b.cur, i, {cap}))"
    none = "[]::VARCHAR[]"
    fold = f"""list_reduce(
      list_transform(list_filter(regexp_split_to_array({p}, '\\s+'), lambda w: w <> ''),
                     lambda w: {{'cur': w, 'out': {none}}}),
      lambda a, b: CASE
        WHEN a.cur <> '' AND length(a.cur) + 1 + length(b.cur) <= {cap}
          THEN {{'cur': a.cur || ' ' || b.cur, 'out': a.out}}
        WHEN length(b.cur) <= {cap}
          THEN {{'cur': b.cur, 'out': list_concat(a.out, CASE WHEN a.cur = '' THEN {none} ELSE [a.cur] END)}}
        ELSE {{'cur': '', 'out': list_concat(list_concat(a.out, CASE WHEN a.cur = '' THEN {none} ELSE [a.cur] END), {cuts})}}
      END,
      {{'cur': '', 'out': {none}}})"""
    return fold


def sql_chunks(cap: int) -> str:
    """CTEs ending in chunks(doc_id, chunk_id, text): packing under a budget."""
    return SPANS + f""",
folded AS (SELECT *, CASE WHEN length(text) > {cap} THEN {sql_wrap('text', cap)} END AS f FROM spans),
pieces AS (
  SELECT doc_id, span_id,
         CASE WHEN f IS NULL THEN [text]
              ELSE list_concat(f.out, CASE WHEN f.cur = '' THEN []::VARCHAR[] ELSE [f.cur] END) END AS ps
  FROM folded),
docs AS (SELECT doc_id, flatten(list(ps ORDER BY span_id)) AS ps FROM pieces GROUP BY doc_id),
packed AS (
  SELECT doc_id, list_reduce(
    list_transform(ps, lambda p: {{'cur': p, 'out': []::VARCHAR[]}}),
    lambda a, b: CASE
      WHEN length(a.cur) + 2 + length(b.cur) <= {cap}
        THEN {{'cur': a.cur || chr(10) || chr(10) || b.cur, 'out': a.out}}
      ELSE {{'cur': b.cur, 'out': list_append(a.out, a.cur)}} END) AS r
  FROM docs),
lists AS (SELECT doc_id, list_append(r.out, r.cur) AS cs FROM packed),
chunks AS (SELECT doc_id, generate_subscripts(cs, 1)::INT AS chunk_id, unnest(cs) AS text FROM lists)"""


def sql_batches(size: int, chars: int) -> str:
    """CTEs ending in batched(doc_id, span_id, text, batch_id)."""
    return SPANS + f""",
walked AS (
  SELECT doc_id, list_reduce(
    list_transform(list(length('[' || span_id || '] ' || text) + 1 ORDER BY span_id),
                   lambda c: {{'n': 1::BIGINT, 'c': c::BIGINT, 'b': 1::BIGINT, 'out': []::BIGINT[]}}),
    lambda a, s: CASE
      WHEN a.n > 0 AND (a.n >= {size} OR a.c + s.c > {chars})
        THEN {{'n': 1::BIGINT, 'c': s.c, 'b': a.b + 1, 'out': list_append(a.out, a.b + 1)}}
      ELSE {{'n': a.n + 1, 'c': a.c + s.c, 'b': a.b, 'out': list_append(a.out, a.b)}} END,
    {{'n': 0::BIGINT, 'c': 0::BIGINT, 'b': 1::BIGINT, 'out': []::BIGINT[]}}) AS r
  FROM spans GROUP BY doc_id),
batched AS (
  SELECT s.doc_id, s.source, s.span_id, s.text, w.r.out[s.span_id]::INT AS batch_id
  FROM spans s JOIN walked w USING (doc_id))"""


WINDOWS = SPANS + """,
counts AS (SELECT doc_id, max(span_id) AS n FROM spans GROUP BY doc_id),
placed AS (
  SELECT s.doc_id, s.span_id, s.text, k, n
  FROM spans s JOIN counts USING (doc_id),
       unnest(CASE WHEN (span_id - 1) % 7 = 0 AND span_id > 1
                   THEN [(span_id - 1) // 7 - 1, (span_id - 1) // 7]
                   ELSE [(span_id - 1) // 7] END) AS t(k)
  WHERE k < greatest(1, ceil((n - 1) / 7.0)))"""
