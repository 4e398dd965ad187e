"""Overlapping summary blocks: merging, fallback, payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


from lectern.operators import ordered, shaping


def merge_blocks(
    blocks: DataFrame,
    run: str = "run_id",
    arrival: tuple[str, ...] = ("batch_id", "pos"),
    cap: str | None = None,
    *,
    slice_rows: int = ordered.SLICE_ROWS,
    upper: int | None = None,
) -> DataFrame:
    """G1: blocks that overlap become one; touching numbers count as overlap.

    Islands are found with running maxima that slice long runs. One merged
    block is one value, so its members meet in one group by definition.
    ``cap`` names a column with the paragraph count, used when merging.
    """
    order = ["from_p", "to_p", *arrival]
    if upper is None:
        upper = ordered.largest(blocks, "from_p")
    kw = dict(slice_rows=slice_rows, upper=upper)
    reach = ordered.running(
        blocks, [run], order, [ordered.Running("_reach", "max", F.col("to_p"), inclusive=False)], **kw
    )
    # Islands do not touch, so the start of an island identifies it.
    opens = F.when(F.col("_reach").isNull() | (F.col("from_p") > F.col("_reach")), F.col("from_p"))
    islands = ordered.running(
        reach.withColumn("_open", opens), [run], order,
        [ordered.Running("_island", "max", F.col("_open"))], **kw,
    )
    members = F.array_sort(F.collect_list(F.struct(*order, "title", "body")))
    merged = islands.groupBy(run, "_island").agg(
        members.alias("_m"), *([F.max(cap).alias("_cap")] if cap else [])
    )
    top = F.array_max(F.transform("_m", lambda m: m.to_p))
    if cap:
        top = F.when(F.size("_m") > 1, F.least(top, F.col("_cap"))).otherwise(top)
    return merged.select(
        run,
        F.col("_island").cast("int").alias("from_p"),
        top.cast("int").alias("to_p"),
        merged_title(F.col("_m")).alias("title"),
        merged_body(F.col("_m")).alias("body"),
    )


def merged_title(members: Column) -> Column:
    """The longest title, the earliest of equals."""
    return F.aggregate(
        members, F.lit(""),
        lambda best, m: F.when(F.length(m.title) > F.length(best), m.title).otherwise(best),
    )


def merged_body(members: Column) -> Column:
    """Fold: contained text is dropped, other text follows after a blank line."""
    def join(acc: Column, m: Column) -> Column:
        return F.when(F.contains(acc, m.body), acc).when(F.contains(m.body, acc), m.body).otherwise(
            F.concat(acc, F.lit("\n\n"), m.body)
        )

    # contains(x, '') holds, so the empty start value gives way to the first body.
    return F.aggregate(members, F.lit(""), join)


def fallback_blocks(
    paragraphs: DataFrame, merged: DataFrame | None, run: str = "run_id", *, upper: int | None = None, bare: DataFrame | None = None, **kw
) -> DataFrame:
    """Runs without any block, or the ``bare`` ones of a caller that knows them, get one block per paragraph window."""
    if bare is None:
        bare = paragraphs.select(run).distinct().join(merged.select(run).distinct(), run, "left_anti")
    rows = ordered.attach(paragraphs, bare, [run], "span_id", upper=upper)
    return shaping.windows(rows, run, **kw).select(
        run,
        F.col("start_paragraph").alias("from_p"), F.col("end_paragraph").alias("to_p"),
        F.concat(F.lit("Section "), F.col("batch_id").cast("string")).alias("title"),
        F.array_join(F.transform("rows", lambda r: r.text), " ").alias("body"),
    )


def candidate_json(blocks: DataFrame, run: str = "run_id") -> DataFrame:
    """Ordered blocks of a run as the JSON payload of its reduce prompt.

    One prompt is one value; its size is what the model accepts.
    """
    rows = F.array_sort(F.collect_list(F.struct(
        F.col("from_p").alias("from_paragraph"), F.col("to_p").alias("to_paragraph"), "title", "body"
    )))
    return blocks.groupBy(run).agg(F.to_json(rows).alias("candidate_blocks_json"))


def block_bodies(blocks: DataFrame, run: str = "run_id") -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct("from_p", "to_p", "body")))
    return blocks.groupBy(run).agg(F.array_join(F.transform(rows, lambda b: b.body), "\n\n").alias("bodies"))
