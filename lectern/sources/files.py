"""File scans: recordings, transcripts, subtitles, JSON rows, manifests."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lectern import schemas as S
from lectern.functions import text as tx
from lectern.operators import ordered, timeline
from lectern.sources import folders


class FormatError(ValueError):
    """A file does not have the expected shape."""


def _local_path(path: Column) -> Column:
    return F.regexp_replace(path, "^file:(//)?", "")


def deal_out(scan: DataFrame, *keys: str) -> DataFrame:
    """Spread a scan of few, large files over all task slots.

    Text work is CPU-bound and row-local. A large table already has more
    splits than slots and is left alone; a single file is not. Use on plain
    scans only.
    """
    slots = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= slots else scan.repartition(slots, *keys)


def recordings(spark: SparkSession, root: str, *, content: bool = False) -> DataFrame:
    """A1: media files under ``root`` at any depth, any letter case of suffix, hidden and empty ones too.

    Folders are listed by tasks. Without ``content`` files are never opened. Order by
    ``rel_path`` (or use ``numbered``) to get the reference order.
    """
    found = folders.walk(spark, root)
    ext = F.lower(F.regexp_extract("rel_path", r"[^/]\.([^./]+)$", 1))
    kept = found.select(
        folders.full_path(root, F.col("rel_path")).alias("path"), "rel_path", ext.alias("ext"), "bytes", "modified",
    ).filter(F.col("ext").isin(*S.MEDIA_EXTENSIONS))
    return folders.contents(kept, root) if content else kept


def numbered(recordings: DataFrame) -> DataFrame:
    """Recordings with ``run_index`` by relative path and ``total_runs``."""
    rows = ordered.number_all(recordings, ["rel_path"], "run_index")
    return rows.withColumn("total_runs", F.lit(rows.count()))


def whole_texts(spark: SparkSession, path: str, suffix: str = "", *, every: bool = False) -> DataFrame:
    """A3: one row per text file; ``chunk_id`` from a numeric file stem.

    Spark's scan passes over files of no bytes and hidden ones; with ``every`` tasks list the folder once and
    read them all, so many small files make no more tasks than there are slots.
    """
    if every:
        found = folders.walk(spark, path).filter(F.col("rel_path").endswith(suffix) & (F.col("rel_path") != "_SUCCESS"))
        rows = folders.contents(found.repartition(4 * spark.sparkContext.defaultParallelism, "rel_path"), path).select(
            _local_path(folders.full_path(path, F.col("rel_path"))).alias("path"), F.col("content").cast("string").alias("text"))
    else:
        rows = spark.read.option("recursiveFileLookup", True)
        if suffix:
            rows = rows.option("pathGlobFilter", f"*{suffix}")
        rows = rows.text(path, wholetext=True).select(
            _local_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("text")
        )
    stem = F.regexp_extract("path", r"(\d+)\.[^./]*$", 1)
    return rows.withColumn("chunk_id", stem.try_cast("int"))


def subtitles(
    spark: SparkSession, path: str, *, suffix: str = ".srt", strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """A4: (cues, rejected blocks) of every subtitle file under ``path``."""
    parsed = timeline.parse_cues(whole_texts(spark, path, suffix), ["path", "chunk_id"])
    return timeline.split_cues(parsed, strict)


def json_rows(spark: SparkSession, path: str, row: str, glob: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """A5: files holding a JSON array of rows -> (rows, rejected files).

    ``pos`` keeps the order inside each file. A file that is not a list, or
    not JSON, or has a row with a field of another type, is a reject.
    """
    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob).text(path, wholetext=True)
        .select(_local_path(F.col("_metadata.file_path")).alias("path"), F.col("value"))
    )
    parsed = files.withColumn("_rows", F.from_json("value", f"array<struct<{row}>>", {"mode": "PERMISSIVE"}))
    is_list = tx.strip(F.col("value")).startswith("[") & F.try_parse_json("value").isNotNull()
    # a field that is there but null after the cast has another type
    told = F.from_json("value", "array<map<string, string>>", {"mode": "PERMISSIVE"})
    names = spark.createDataFrame([], row).columns
    lost = F.exists(F.arrays_zip(F.col("_rows").alias("r"), told.alias("m")), lambda x: reduce(
        or_, [x["r"][n].isNull() & F.try_element_at(x["m"], F.lit(n)).isNotNull() for n in names]))
    fine = is_list & F.col("_rows").isNotNull() & ~F.coalesce(lost, F.lit(True))
    bad = ~F.coalesce(fine, F.lit(False))
    good = parsed.filter(~bad).select("path", F.posexplode("_rows").alias("pos", "r")).select("path", "pos", "r.*")
    return good, parsed.filter(bad).select("path", F.lit("not a JSON list of such rows").alias("problem"))


def require_no_rejects(rejects: DataFrame) -> None:
    first = rejects.head()
    if first is not None:
        raise FormatError(f"{first['path']}: {first['problem']}")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON-lines log."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(path)


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """Stage manifests; run id from the folder above the stage folder."""
    raw = (
        spark.read.schema(S.MANIFEST).option("multiLine", True)
        .option("recursiveFileLookup", True).option("pathGlobFilter", "manifest.json").json(path)
    )
    where = F.col("_metadata.file_path")
    return raw.select(
        "*", F.regexp_extract(where, r"([^/]+)/[^/]+/manifest\.json$", 1).alias("run_id")
    ).withColumn("inputs_signature", F.try_element_at("params", F.lit("_inputs_signature")))


def template_files(spark: SparkSession, roots: list[str]) -> DataFrame:
    """Prompt template folders -> templates(root, root_priority, name, body)."""
    out = None
    for priority, root in enumerate(roots):
        rows = whole_texts(spark, root, ".txt").select(
            F.lit(root).alias("root"), F.lit(priority).alias("root_priority"),
            F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("text").alias("body"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out
