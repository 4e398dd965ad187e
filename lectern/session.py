"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Bytes of an Arrow batch, so that the memory of Python workers follows neither from the rows of a task nor from the length of texts.
ARROW_BYTES = 2 << 20
_shipped: set[str] = set()


def build_session(app: str = "lectern", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
        .config("spark.sql.variant.allowDuplicateKeys", "true")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers where it is not installed."""
    name = f"lectern-{spark.sparkContext.applicationId}.zip"
    if name in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="lectern-")) / name
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(name)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach; named by the cluster in its settings."""
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="lectern-")
        spark.conf.set(CHECKPOINT_KEY, named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors and is computed once."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def write_and_read(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Store a table in the shared folder and scan it back (columns prunable); packed closely, as it is read few times."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("error").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
