"""Ordered work inside a key that may hold a large share of all rows.

A running total over ``partitionBy(run)`` puts a whole run in one task. Here
each key is cut into slices of consecutive ordinals; slices are totalled with
map-side combine, the (few) slice totals are accumulated per key, and the
carry is joined back on (key, slice), so no task sees more than one slice.
When no ordinal reaches the slice size every key already fits and a plain
window does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.functions import text as tx
from lectern.session import cut_lineage

SLICE_ROWS = 1 << 18
# Pieces that one task gathers at a time on the way to a whole text.
GATHER_ROWS = 1 << 14
# Numbers that keys are hashed to when rows are told apart without a shuffle, 64 to a word of bits.
PICKS = 1 << 24


@dataclass(frozen=True)
class Running:
    """One running measure: kind is sum, count, max or min."""

    name: str
    kind: str
    source: Column | None = None
    inclusive: bool = True


def largest(df: DataFrame, ordinal: str) -> int:
    """One-value probe that decides whether slicing is needed at all."""
    return df.agg(F.max(ordinal)).head()[0] or 0


def _fold(kind: str, value: Column) -> Column:
    return {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}[kind](value)


def _combine(kind: str, carry: Column, local: Column) -> Column:
    if kind in ("sum", "count"):
        return F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0))
    return (F.greatest if kind == "max" else F.least)(carry, local)


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    measures: list[Running],
    *,
    slice_rows: int = SLICE_ROWS,
    upper: int | None = None,
) -> DataFrame:
    """Add running measures in ``order`` within ``keys``.

    ``order[0]`` must be a non-negative integer that is (nearly) unique within
    a key; ``upper`` is its largest value when the caller knows it.
    """
    values = {f"_v{i}": (F.lit(1).cast("long") if m.kind == "count" else m.source)
              for i, m in enumerate(measures)}
    df = df.withColumns(values)
    if upper is None:
        upper = largest(df, order[0])
    if upper < slice_rows:
        return _plain(df, keys, order, measures).drop(*values)

    sliced = df.withColumn("_slice", F.floor(F.col(order[0]) / slice_rows))
    totals = sliced.groupBy(*keys, "_slice").agg(
        *[_fold(m.kind, F.col(f"_v{i}")).alias(f"_t{i}") for i, m in enumerate(measures)]
    )
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carry = totals.select(
        *keys, "_slice",
        *[_fold(m.kind, F.col(f"_t{i}")).over(before).alias(f"_c{i}")
          for i, m in enumerate(measures)],
    )
    local = _plain(
        sliced.join(carry, [*keys, "_slice"], "left"), [*keys, "_slice"], order, measures
    )
    out = local.withColumns({
        m.name: _combine(m.kind, F.col(f"_c{i}"), F.col(m.name))
        for i, m in enumerate(measures)
    })
    return out.drop("_slice", *values, *[f"_c{i}" for i in range(len(measures))])


def _plain(df, keys, order, measures):
    base = Window.partitionBy(*keys).orderBy(*order)
    out = {}
    for i, m in enumerate(measures):
        frame = base.rowsBetween(Window.unboundedPreceding, 0 if m.inclusive else -1)
        value = _fold(m.kind, F.col(f"_v{i}")).over(frame)
        out[m.name] = F.coalesce(value, F.lit(0)) if m.kind in ("sum", "count") else value
    return df.withColumns(out)


def number_rows(df, keys, order, name, **kw) -> DataFrame:
    """1-based position of each row within its key."""
    return running(df, keys, order, [Running(name, "count")], **kw)


def clamped_level(
    df: DataFrame,
    keys: list[str],
    seq: str,
    delta: str,
    name: str,
    *,
    slice_rows: int = SLICE_ROWS,
    upper: int | None = None,
    start: DataFrame | None = None,
) -> DataFrame:
    """Counter that follows ``delta`` but never goes below zero.

    level = S - least(0, min S), with S the running sum from the start level.
    ``start`` is an optional (keys, start_level) table of one row per key.
    A slice is summed up by its total and its lowest running sum; both chain
    over slices, so rows are shuffled once however hot a key is.
    """
    if upper is None:
        upper = largest(df, seq)
    one = upper < slice_rows
    sliced = df.withColumn("_slice", F.lit(0) if one else F.floor(F.col(seq) / slice_rows))
    local = _local_sums(sliced, keys if one else [*keys, "_slice"], seq, delta)
    if one:
        local = local.withColumns({"_s0": F.lit(0), "_low0": F.lit(None).cast("bigint")})
    else:
        chained = _local_sums(sliced, [*keys, "_slice"], seq, delta).groupBy(*keys, "_slice").agg(
            F.sum(delta).alias("_t"), F.min("_s").alias("_m")
        )
        before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        carry = chained.withColumn("_s0", F.coalesce(F.sum("_t").over(before), F.lit(0))).withColumn(
            "_low0", F.min(F.col("_s0") + F.col("_m")).over(before)
        ).drop("_t", "_m")
        local = local.join(carry, [*keys, "_slice"], "left")
    base = F.lit(0)
    if start is not None:
        local = local.join(start, keys, "left")
        base = F.coalesce(F.col("start_level"), F.lit(0))
    low = F.least(F.col("_low0"), F.col("_s0") + F.col("_low"))
    level = F.col("_s0") + F.col("_s") + base - F.least(F.lit(0), low + base)
    return local.withColumn(name, level).drop("_slice", "_s", "_low", "_s0", "_low0", "start_level")


def _local_sums(df, keys, seq, delta):
    """Running sum ``_s`` and its running minimum ``_low`` in one sort."""
    frame = Window.partitionBy(*keys).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_s", F.sum(delta).over(frame)).withColumn("_low", F.min("_s").over(frame))


def number_all(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Global 1-based rank by a total order, without a single-task window.

    Rows are range-sorted; each sorted partition knows its own positions and
    the partition sizes (one row per partition) give the offsets.
    """
    mask = (1 << 33) - 1
    ranked = cut_lineage(
        df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_at", 33))
    sizes = ranked.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_part",
        F.coalesce(
            F.sum("_n").over(
                Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_offset"),
    )
    # One row per partition of the sort: bounded by the shuffle width.
    return (
        ranked.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_at").bitwiseAND(mask) + 1)
        .drop("_at", "_part", "_offset")
    )


def attach(
    facts: DataFrame,
    dim: DataFrame,
    keys: list[str],
    ordinal: str,
    *,
    slice_rows: int = SLICE_ROWS,
    upper: int | None = None,
    how: str = "inner",
) -> DataFrame:
    """Join per-key values onto rows of possibly huge keys.

    ``dim`` has one row per key. Each key's row is repeated once per slice of
    that key, so a hot key spreads over as many tasks as it has slices.
    """
    if upper is None:
        upper = largest(facts, ordinal)
    if upper < slice_rows:
        return facts.join(dim, keys, how)
    sliced = facts.withColumn("_slice", F.floor(F.col(ordinal) / slice_rows))
    spread = sliced.select(*keys, "_slice").distinct().join(dim, keys)
    return sliced.join(spread, [*keys, "_slice"], how).drop("_slice")


def maybe_among(rows: DataFrame, ids: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose keys may be among ids, rows whose keys are not): by one of PICKS numbers that keys are hashed
    to. No row is shuffled for it, and what goes to all tasks is at most PICKS / 64 words of bits."""
    number = F.pmod(F.xxhash64(*keys), F.lit(PICKS))
    word, bit = F.shiftright(number, 6).cast("int").alias("_word"), number.bitwiseAND(63).cast("int").alias("_bit")
    bits = F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits")
    few = F.broadcast(ids.select(word, bit).groupBy("_word").agg(bits).withColumnRenamed("_word", "_w"))
    marked = rows.withColumns({"_word": word, "_bit": bit})
    among = (F.col("_word") == F.col("_w")) & (F.getbit("_bits", "_bit") == 1)
    return tuple(marked.join(few, among, how).drop("_word", "_bit") for how in ("left_semi", "left_anti"))


def assemble(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    text: str,
    *,
    sep: str = "\n\n",
    drop_blank: bool = False,
    terminate: bool = True,
    runs: DataFrame | None = None,
    part_rows: int | None = None,
    upper: int | None = None,
) -> DataFrame:
    """Ordered pieces -> whole texts (keys, part, text).

    A text is one row, part 0, at any size: a long one is gathered in pieces by
    many tasks, and the pieces are joined. Only a caller that names ``part_rows``
    gets a key with more ordinals as several parts; joining them in order with
    ``sep`` gives the whole text, stripped at both ends. ``runs`` adds an empty
    text for keys without rows.
    """
    if drop_blank:
        rows = rows.filter(~tx.is_blank(F.col(text)))
    if upper is None:
        upper = largest(rows, order[0])
    item = F.struct(*order, F.col(text).alias("_text"))

    def joined(col: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(col), lambda x: x["_text"]), sep)

    if upper < (part_rows or GATHER_ROWS):
        out = rows.groupBy(*keys).agg(F.collect_list(item).alias("_items")).select(
            *keys, F.lit(0).alias("part"), tx.strip(joined(F.col("_items"))).alias("text"),
            F.lit(True).alias("_last"),
        )
    else:
        out = _assemble_parts(rows, keys, order, text, item, joined, part_rows or GATHER_ROWS)
    if upper >= GATHER_ROWS and part_rows is None:
        parts = F.array_sort(F.collect_list(F.struct("part", "text")))
        out = out.groupBy(*keys).agg(parts.alias("_parts")).select(
            *keys, F.lit(0).alias("part"), F.array_join(F.col("_parts.text"), sep).alias("text"), F.lit(True).alias("_last")
        )
    if runs is not None:
        out = runs.select(*keys).distinct().join(out, keys, "left").select(
            *keys,
            F.coalesce("part", F.lit(0)).alias("part"),
            F.coalesce("text", F.lit("")).alias("text"),
            F.coalesce("_last", F.lit(True)).alias("_last"),
        )
    if terminate:
        out = out.withColumn(
            "text", F.when(F.col("_last"), tx.newline_terminated(F.col("text"))).otherwise(F.col("text"))
        )
    return out.drop("_last")


def _assemble_parts(rows, keys, order, text, item, joined, part_rows):
    solid = F.when(~tx.is_blank(F.col(text)), F.struct(*order))
    edges = rows.groupBy(*keys).agg(
        F.min(solid).alias("_first"), F.max(solid).alias("_final")
    )
    part = lambda o: F.floor(o / part_rows).cast("int")
    # One row per (key, part): the join key spreads a hot key over its parts.
    spread = edges.filter(F.col("_first").isNotNull()).select(
        "*",
        F.explode(F.sequence(part(F.col("_first")[order[0]]), part(F.col("_final")[order[0]]))).alias("_p"),
    )
    inside = (
        rows.withColumn("_p", part(F.col(order[0])))
        .join(spread, [*keys, "_p"])
        .filter((F.struct(*order) >= F.col("_first")) & (F.struct(*order) <= F.col("_final")))
    )
    parts = inside.groupBy(*keys, "_p").agg(
        F.collect_list(item).alias("_items"),
        F.first("_first").alias("_first"), F.first("_final").alias("_final"),
    )
    whole = joined(F.col("_items"))
    is_first = F.col("_p") == part(F.col("_first")[order[0]])
    is_last = F.col("_p") == part(F.col("_final")[order[0]])
    solid_parts = parts.select(
        *keys,
        (F.col("_p") - part(F.col("_first")[order[0]])).alias("part"),
        is_first.alias("_head"), is_last.alias("_last"), whole.alias("text"),
    ).withColumn(
        "text", F.when(F.col("_head"), tx.lstrip(F.col("text"))).otherwise(F.col("text"))
    ).withColumn(
        "text", F.when(F.col("_last"), tx.rstrip(F.col("text"))).otherwise(F.col("text"))
    ).drop("_head")
    blank = edges.filter(F.col("_first").isNull()).select(
        *keys, F.lit(0).alias("part"), F.lit(True).alias("_last"), F.lit("").alias("text")
    )
    return solid_parts.unionByName(blank).select(*keys, "part", "text", "_last")
