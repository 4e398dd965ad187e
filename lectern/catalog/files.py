"""Files and tables written from the given tables and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.catalog.base import query, table
from lectern.session import shared_folder
from lectern.sources import files, folders, sinks


def folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("a3_a8_text_files", """
SELECT CAST(doc_id AS VARCHAR) AS run_id,
       CASE WHEN text = '' OR ends_with(text, chr(10)) THEN text ELSE text || chr(10) END AS text
FROM (SELECT doc_id, CASE WHEN doc_id % 50 = 7 THEN '' ELSE text END AS text FROM documents)
WHERE doc_id IS NOT NULL AND text IS NOT NULL""")
def text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final texts as plain files, some of them empty, one folder a run, scanned back as whole texts."""
    path = folder(spark, "final-texts")
    docs = table(spark, sf_dir, "documents").filter("doc_id IS NOT NULL")
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 50 == 7, "").otherwise(F.col("text")))
    sinks.write_texts(docs.select(F.col("doc_id").cast("string").alias("run_id"), F.lit("s10").alias("stage"), "text"), path)
    scan = files.whole_texts(spark, path, ".txt", every=True)
    return scan.select(F.regexp_extract("path", r"run_id=([^/]+)/[^/]+$", 1).alias("run_id"), "text")


@query("a6_json_lines", "SELECT conv_id, turn, role, text FROM conversations")
def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns as a JSON-lines log, read back under their schema."""
    path = folder(spark, "lines")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    sinks.write_lines(rows, path)
    return files.json_lines(spark, path, ", ".join(f"{k} {t}" for k, t in rows.dtypes))


@query("a9_existing_outputs", """
SELECT CAST(o_orderkey AS VARCHAR) AS run_id, 's03' AS stage,
       CASE WHEN o_orderstatus = 'O' THEN 'first' WHEN o_orderstatus = 'P' THEN 'second' ELSE 'third' END AS text
FROM orders""")
def existing_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One output per order under the three policies in turn: refuse (nothing is there yet), skip what
    is there, overwrite finished orders."""
    path = folder(spark, "outputs")
    status = F.coalesce("o_orderstatus", F.lit("?"))
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"), F.lit("s03").alias("stage"), status.alias("status"))
    saved = lambda which, text, policy: sinks.save_runs(
        rows.filter(which).select("run_id", "stage", F.lit(text).alias("text")), path, policy, buckets=16)
    saved("status <> 'P'", "first", "fail")
    saved("status IN ('O', 'P')", "second", "skip")
    saved("status NOT IN ('O', 'P')", "third", "overwrite")
    return sinks.read_table(spark, path).select("run_id", "stage", "text")


_MEDIA_SQL = """
SELECT CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN '.cache/' WHEN 2 THEN '_old/' ELSE 'd' || doc_id % 7 || '/e/' END
    || CASE doc_id % 3 WHEN 0 THEN '.' WHEN 1 THEN '_' ELSE '' END || 'talk' || doc_id
    || CASE doc_id % 4 WHEN 0 THEN '.wav' WHEN 1 THEN '.MP3' WHEN 2 THEN '.txt' ELSE '.Flac' END AS rel_path,
  CASE WHEN doc_id % 6 = 0 THEN '' ELSE coalesce(text, '') END AS content
FROM documents WHERE doc_id IS NOT NULL"""


@query("a1_recordings", f"""SELECT rel_path, lower(regexp_extract(rel_path, '[.]([^.]+)$', 1)) AS ext, strlen(content)::BIGINT AS bytes,
  sha256(content) AS sha256, row_number() OVER (ORDER BY rel_path)::BIGINT AS run_index
FROM ({_MEDIA_SQL}) WHERE rel_path NOT LIKE '%.txt'""")
def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of files, some hidden, empty, in hidden folders or of other kinds, listed, numbered and fingerprinted."""
    path = folder(spark, "media")
    names = {0: "", 1: ".cache/", 2: "_old/"}
    doc = F.col("doc_id")
    choose = lambda by, values, rest: F.coalesce(*(F.when(doc % by == k, v) for k, v in values.items()), rest)
    rows = table(spark, sf_dir, "documents").filter("doc_id IS NOT NULL").select(
        F.concat(choose(5, names, F.concat(F.lit("d"), doc % 7, F.lit("/e/"))), choose(3, {0: ".", 1: "_"}, F.lit("")),
                 F.lit("talk"), doc, choose(4, {0: ".wav", 1: ".MP3", 2: ".txt"}, F.lit(".Flac"))).alias("path"),
        F.when(doc % 6 == 0, "").otherwise(F.coalesce("text", F.lit(""))).alias("content"))
    folders.write_files(rows, path)
    found = files.numbered(files.recordings(spark, path, content=True))
    return found.select("rel_path", "ext", "bytes", F.sha2("content", 256).alias("sha256"), F.col("run_index").cast("bigint").alias("run_index"))


@query("a5_json_rows", """
SELECT 'n' || c_nationkey || '.json' AS file, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1)::INT AS pos,
  c_custkey::BIGINT AS id, c_name AS name FROM customer WHERE c_nationkey % 6 <> 5
UNION ALL SELECT DISTINCT 'n' || c_nationkey || '.json', -1, NULL::BIGINT, 'not a JSON list of such rows' FROM customer WHERE c_nationkey % 6 = 5""")
def json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as one JSON array per nation, some of them spoilt, read back as rows and rejects."""
    path = folder(spark, "json-rows")
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("bigint").alias("id"), F.col("c_name").alias("name"), "c_nationkey")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("id", "name"))), lambda r: F.to_json(r))
    body = F.concat(F.lit("["), F.array_join(listed, ","), F.when(F.col("c_nationkey") % 6 == 5, "").otherwise("]"))
    arrays = rows.groupBy("c_nationkey").agg(body.alias("content"))
    folders.write_files(arrays.select(F.concat(F.lit("n"), "c_nationkey", F.lit(".json")).alias("path"), "content"), path)
    good, bad = files.json_rows(spark, path, "id BIGINT, name STRING")
    name = F.regexp_extract("path", r"([^/]+)$", 1).alias("file")
    return good.select(name, "pos", "id", "name").unionByName(
        bad.select(name, F.lit(-1).alias("pos"), F.lit(None).cast("bigint").alias("id"), F.col("problem").alias("name")))


@query("a7_manifests", """
SELECT 'sup' || s_suppkey AS run_id, 's03' AS stage, CASE WHEN s_suppkey % 3 = 0 THEN 'failed' ELSE 'success' END AS status,
  sha256(s_name) AS inputs_signature, (s_suppkey % 4)::INT AS inputs, s_suppkey % 5 = 0 AS dry_run FROM supplier""")
def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manifest file per supplier's run and stage, read back as a table."""
    path = folder(spark, "manifests")
    key = F.col("s_suppkey")
    entry = F.struct(F.lit("in").alias("path"), F.lit("00").alias("sha256"), key.cast("bigint").alias("bytes"))
    manifest = F.struct(
        F.lit("s03").alias("stage"), F.when(key % 3 == 0, "failed").otherwise("success").alias("status"),
        F.create_map(F.lit("_inputs_signature"), F.sha2(F.col("s_name").cast("binary"), 256)).alias("params"),
        F.array_repeat(entry, (key % 4).cast("int")).alias("inputs"), (key % 5 == 0).alias("dry_run"))
    rows = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("sup"), key, F.lit("/s03/manifest.json")).alias("path"), F.to_json(manifest).alias("content"))
    folders.write_files(rows, path)
    return files.manifests(spark, path).select(
        "run_id", "stage", "status", "inputs_signature", F.size("inputs").alias("inputs"), "dry_run")
