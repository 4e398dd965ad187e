"""Table and text sinks with an existing-output policy."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.errors import AnalysisException

from lectern.operators import ordered
from lectern.session import write_and_read
from lectern.sources import folders

BUCKETS = 256
BUCKET = "run_bucket"
#: Tasks that write to one folder.
SLOTS = 8


class ExistingOutputError(RuntimeError):
    """Outputs exist and the policy is to fail."""


def with_bucket(df: DataFrame, run: str = "run_id", buckets: int = BUCKETS) -> DataFrame:
    """A fixed number of folders per stage, however many runs there are."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(run), F.lit(buckets)).cast("int"))


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def save_runs(
    rows: DataFrame,
    path: str,
    on_exists: str = "fail",
    *,
    keys=("run_id", "stage"),
    buckets: int = BUCKETS,
    stage_first: bool = True,
) -> DataFrame:
    """Write rows per run and stage under the chosen policy.

    overwrite replaces only the incoming keys, skip writes only new keys, fail
    refuses when any key exists. Only the buckets touched are rewritten, in one job that
    swaps folders when it ends, so a failed job leaves the old rows in place.
    Returns what was written: a table of its own, or, where there is nothing older and without ``stage_first``, the
    table at ``path``, good until that is written again.
    """
    if on_exists not in ("overwrite", "skip", "fail"):
        raise ValueError(f"unknown policy '{on_exists}'")
    spark = rows.sparkSession
    keys = list(keys)
    incoming = with_bucket(rows, keys[0], buckets)
    old = read_table(spark, path)
    if old is None and not stage_first:
        _writer(incoming, keys).mode("append").parquet(path)
        return spark.read.schema(incoming.schema).parquet(path).select(*rows.columns)
    if old is None:
        staged = incoming
    else:
        existing = old.select(BUCKET, *keys).distinct()
        if on_exists == "fail":
            hit = existing.join(incoming.select(*keys), keys, "left_semi").head()
            if hit is not None:
                raise ExistingOutputError(f"outputs already exist for {[hit[k] for k in keys]}")
            staged = incoming
        elif on_exists == "skip":
            staged = incoming.join(existing.drop(BUCKET), keys, "left_anti")
        else:
            staged = write_and_read(incoming, "staged")
            touched = staged.select(*_folders(keys)).distinct()
            rest = old.join(F.broadcast(touched), touched.columns, "left_semi").select(*staged.columns)
            if _scattered(old):
                both = _dealt(staged.withColumn("_new", F.lit(True)).unionByName(rest.withColumn("_new", F.lit(False))), keys)
                # Dealt as they are written, so the newest of a key are found without another shuffle.
                newest = F.max("_new").over(Window.partitionBy(*_folders(keys), "_slot", *[k for k in keys if k != "stage"]))
                left = both.withColumn("_newest", newest).filter(F.col("_new") | ~F.col("_newest")).drop("_new", "_newest", "_slot")
            else:
                left = _dealt(staged, keys).drop("_slot").unionByName(_spared(rest, staged, keys))
            _partitioned(left, keys).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
            return staged.drop(BUCKET)
    staged = write_and_read(staged, "staged")
    _writer(staged, keys).mode("append").parquet(path)
    return staged.drop(BUCKET)


def _folders(keys: list[str]) -> list[str]:
    return (["stage"] if "stage" in keys else []) + [BUCKET]


def _dealt(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with their slot: few files for a folder, and rows of a key in one task."""
    return df.withColumn("_slot", F.pmod(F.xxhash64(*keys), F.lit(SLOTS))).repartition(*_folders(keys), "_slot")


def _scattered(table: DataFrame) -> bool:
    """Whether folders hold so many files that their rows are dealt again."""
    files = table.inputFiles()
    return len(files) > 4 * SLOTS * len({f.rsplit("/", 1)[0] for f in files})


def _spared(rest: DataFrame, staged: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the rest whose keys are not staged. Most stay in the tasks that read them, and so in few files;
    of those that may be staged only names are compared, and the few that are not are fetched by name."""
    named = lambda df, tag: df.select(*[F.col(k).alias(f"{tag}{k}") for k in keys]).distinct()
    same = lambda tag, other: reduce(and_, [F.col(f"{tag}{k}").eqNullSafe(F.col(f"{other}{k}")) for k in keys])
    near, far = ordered.maybe_among(rest, staged, keys)
    kept = named(near, "").join(named(staged, "_s_"), same("", "_s_"), "left_anti")
    kept = write_and_read(kept, "spared")
    if kept.isEmpty():
        return far
    return far.unionByName(ordered.maybe_among(near, kept, keys)[0].join(named(kept, "_k_"), same("", "_k_"), "left_semi"))


def _partitioned(df: DataFrame, keys: list[str]):
    return df.write.option("compression", "zstd").partitionBy(*_folders(keys))


def _writer(df: DataFrame, keys: list[str]):
    return _partitioned(_dealt(df, keys).drop("_slot"), keys)


def write_lines(df: DataFrame, path: str, mode: str = "error") -> None:
    """A6 sink: JSON lines."""
    df.write.mode(mode).json(path)


def write_manifests(manifests: DataFrame, path: str, mode: str = "append") -> None:
    """A7 sink: parquet by stage; append-only, the latest outcome counts."""
    manifests.write.mode(mode).partitionBy("stage").parquet(path)


def write_texts(texts: DataFrame, path: str, mode: str = "error", run: str = "run_id") -> None:
    """Final texts as plain files, one folder per stage and run, each written by a task.

    A non-empty text ends with one newline, an empty one is an empty file; a null text is no text and has no
    file. ``part`` orders the pieces of a text. Names that Spark's partition folders escape are escaped alike.
    """
    spark = texts.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(folder):
        if mode == "ignore":
            return
        if mode == "error":
            raise ExistingOutputError(f"{path} exists")
        if mode == "overwrite":
            fs.delete(folder, True)
    place = F.concat(_named("stage"), F.lit("/"), _named(run), F.lit("/part-00000.txt"))
    body = F.when(F.col("text") == "", "").otherwise(F.concat(F.regexp_replace("text", r"\n\z", ""), F.lit("\n")))
    part = F.col("part") if "part" in texts.columns else F.lit(0)
    folders.write_files(texts.filter("text IS NOT NULL").select(place.alias("path"), part.alias("part"), body.alias("content")), path, "part")


#: The characters that partition folders escape as % and two hexadecimal digits, beside
#: control characters, and the name of a null or empty value.
ESCAPED = "\"#%'*/:=?\\{[]^\x7f"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _named(column: str) -> Column:
    """Folder name column=value."""
    value = F.col(column).cast("string")
    code = lambda c: F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))
    strange = value.rlike("[\\x00-\\x1f" + "".join("\\" + c for c in ESCAPED[:-1]) + "\\x7f]")
    letters = F.split(value, "")
    special = lambda c: (F.ascii(c) < 32) | F.lit(ESCAPED).contains(c)
    escaped = F.array_join(F.transform(letters, lambda c: F.when((c != "") & special(c), code(c)).otherwise(c)), "")
    plain = F.when(strange, escaped).otherwise(value)
    return F.concat(F.lit(f"{column}="), F.when(value.isNull() | (value == ""), NO_VALUE).otherwise(plain))
