"""Model replies -> validated rows. Everything is row-local: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lectern.functions import payload as pl, text as tx
from lectern.functions.folds import let

DUPLICATE_KEYS = "spark.sql.variant.allowDuplicateKeys"


def _lenient(df: DataFrame) -> DataFrame:
    # A repeated key keeps its last value, as JSON readers usually do.
    df.sparkSession.conf.set(DUPLICATE_KEYS, "true")
    return df


def parse_decisions(replies: DataFrame, response: str = "response") -> DataFrame:
    """Add ``parsed`` decisions, or null with ``parse_error``.

    One invalid row makes the whole reply unusable.
    """
    rows = _lenient(replies).withColumn("_json", pl.best_json(F.col(response)))
    rows = rows.withColumn("_list", pl.unwrap_list(F.col("_json")))
    rows = rows.withColumn("_rows", F.transform("_list", pl.decision))
    whole = F.forall("_rows", lambda d: d.isNotNull())
    return rows.withColumn("parsed", F.when(whole, F.col("_rows"))).withColumn(
        "parse_error",
        F.when(F.col("_json").isNull(), "LLM response is not valid JSON")
        .when(F.col("_list").isNull(), "LLM response is not a JSON array")
        .when(F.col("parsed").isNull(), "Invalid decision object"),
    ).drop("_json", "_list", "_rows")


def decisions(parsed: DataFrame, keep: list[str]) -> DataFrame:
    """One row per decision, ``pos`` being its place in the reply."""
    # Outer, then filtered on the position: see shaping.explode_rows.
    return parsed.select(*keep, F.posexplode_outer("parsed").alias("pos", "d")).filter("pos IS NOT NULL").select(
        *keep, "pos", "d.span_id", "d.action", "d.label", "d.reason")


def parse_blocks(replies: DataFrame, response: str = "response") -> DataFrame:
    """Add ``parsed`` blocks; a bad block is dropped, the rest stay."""
    rows = _lenient(replies).withColumn(
        "_json", F.when(~tx.is_blank(F.col(response)), pl.whole_or_first_fence(F.col(response)))
    )
    inner = let(
        pl.as_object(F.col("_json")),
        lambda obj: F.when(
            F.map_contains_key(obj, "blocks"), pl.as_list(F.try_element_at(obj, F.lit("blocks")))
        ).otherwise(F.array().cast("array<variant>")),
    )
    items = F.coalesce(pl.as_list(F.col("_json")), F.when(pl.as_object(F.col("_json")).isNotNull(), inner))
    rows = rows.withColumn("_items", items)
    return rows.withColumn(
        "parsed", F.filter(F.transform("_items", pl.block), lambda b: b.isNotNull())
    ).withColumn(
        "parse_error",
        F.when(tx.is_blank(F.col(response)), "response is empty")
        .when(F.col("_json").isNull(), "response is not valid JSON")
        .when(F.col("_items").isNull(), "response is not a list of blocks"),
    ).drop("_json", "_items")


def blocks(parsed: DataFrame, keep: list[str]) -> DataFrame:
    return parsed.select(*keep, F.posexplode_outer("parsed").alias("pos", "b")).filter("pos IS NOT NULL").select(
        *keep, "pos", "b.from_p", "b.to_p", "b.title", "b.body")


def clamp_blocks(blocks: DataFrame, lo: str = "start_paragraph", hi: str = "end_paragraph") -> DataFrame:
    """E5: range cut to the window it was asked about; nothing left -> dropped."""
    return blocks.withColumns({
        "from_p": F.greatest("from_p", lo), "to_p": F.least("to_p", hi),
    }).filter(F.col("from_p") <= F.col("to_p"))
