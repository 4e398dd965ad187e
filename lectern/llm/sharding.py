"""Shards by jump consistent hashing (Lamping and Veach, 2014): no ring, no table.

A key's shard follows from the key and the number of shards alone. One more shard
takes about 1/(n+1) of the keys, from all others, and no key moves between old shards.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.words import mix

#: Factor of the generator in the published algorithm.
FACTOR = np.uint64(2862933555777941757)
SLICES = 1024


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key, 0 to shards - 1."""
    state, at = keys.astype(np.uint64), np.zeros(len(keys), np.int64)
    nxt, live = np.zeros(len(keys), np.int64), np.arange(len(keys))
    while len(live):
        at[live] = nxt[live]
        state[live] = state[live] * FACTOR + np.uint64(1)
        draw = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
        nxt[live] = ((at[live] + 1) * (2.0**31 / draw)).astype(np.int64)
        live = live[nxt[live] < shards]
    return at


def shards_of(key: Column, *counts: int) -> Column:
    """Array of the shards of an integer key, one for each number of shards. A null key is one more
    key of its own."""

    @F.pandas_udf("array<int>")
    def of(ids: pd.Series, absent: pd.Series) -> pd.Series:
        mixed = mix(ids.to_numpy(np.int64).view(np.uint64) + absent.to_numpy(bool) * np.uint64(0x5BD1E995))
        return pd.Series(list(np.stack([jump(mixed, n).astype(np.int32) for n in counts], axis=1)), dtype=object)

    return of(F.coalesce(key.cast("bigint"), F.lit(0)), key.isNull())


def shard_of(key: Column, shards: int) -> Column:
    return shards_of(key, shards)[0]


def number(df: DataFrame, group: str, by: list[str], out: str, slices: int = SLICES) -> DataFrame:
    """Number the rows of each group from 0 without a gap.

    A group is cut into `slices` by a hash of by[0]; rows are numbered in their slice and
    the sizes of the slices before are added. So no task gets a whole group. What is
    broadcast has at most groups x slices rows (groups: the number of shards). Rows alike in
    all of `by` are numbered in any order; rows that share by[0] stay in one slice.
    """
    cut = df.withColumn("_slice", F.pmod(F.xxhash64(by[0]), F.lit(slices)).cast("int"))
    sizes = cut.groupBy(group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(group, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(group, "_slice").orderBy(*by)
    return (
        cut.withColumn("_row", F.row_number().over(within))
        .join(F.broadcast(sizes), [group, "_slice"])
        .withColumn(out, F.col("_before") + F.col("_row") - 1)
        .drop("_slice", "_row", "_before")
    )


def assign(docs: DataFrame, shards: int = 16, slices: int = SLICES) -> DataFrame:
    """Shard, gapless slot and the shard after one more is appended, for every row.

    A null text counts as empty (size 1, checksum 0); a null doc_id is a key like any other;
    rows with equal doc_id share a shard and get a slot each; no rows give no rows. Columns
    other than doc_id and text are not read. Only numbers are shuffled.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shards_of(F.col("doc_id"), shards, shards + 1).alias("_shards"),
    ).select("*", F.col("_shards")[0].alias("shard"), F.col("_shards")[1].alias("grown_shard")).drop("_shards")
    return number(rows, "shard", ["doc_id", "text_crc32", "size"], "slot", slices)


def write_shards(docs: DataFrame, path: str, shards: int = 16) -> None:
    """Rows of `docs` as Parquet, one folder per shard; a shard is written by many tasks."""
    docs.withColumn("shard", shard_of(F.col("doc_id"), shards)).write.partitionBy("shard").parquet(path)
