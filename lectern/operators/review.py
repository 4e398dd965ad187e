"""Decisions applied to spans, review tables and reports, line changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions import text as tx
from lectern.operators import ordered, shaping
from lectern.session import write_and_read


def apply_decisions(
    spans: DataFrame, decisions: DataFrame, run: str = "run_id", batch: str | None = "batch_id"
) -> DataFrame:
    """the last decision per span of the batch it belongs to; default KEEP."""
    keys = [run, *([batch] if batch else []), "span_id"]
    last = decisions.groupBy(*keys).agg(
        F.max_by(F.struct("action", "label", "reason"), "pos").alias("_d")
    )
    return spans.join(last, keys, "left").select(
        *spans.columns,
        F.coalesce("_d.action", F.lit("KEEP")).alias("action"),
        F.col("_d.label").alias("label"), F.col("_d.reason").alias("reason"),
    )


def kept(decided: DataFrame) -> DataFrame:
    return decided.filter(F.col("action") == "KEEP").drop("action", "label", "reason")


def removed(decided: DataFrame) -> DataFrame:
    return decided.filter(F.col("action") == "REMOVE").drop("action")


def split_spans(spans: DataFrame, decisions: DataFrame, run: str = "run_id") -> tuple[DataFrame, DataFrame]:
    """F2 over separate tables: (kept by anti join, removed by semi join)."""
    remove = decisions.filter(F.col("action") == "REMOVE").select(run, "span_id")
    return spans.join(remove, [run, "span_id"], "left_anti"), spans.join(remove, [run, "span_id"], "left_semi")


def sentence_table(decided: DataFrame, run: str = "run_id") -> DataFrame:
    """every sentence with the verdict of its span."""
    return shaping.sentences(decided, [run, "span_id", "action", "label", "reason"])


def review_counts(sentences: DataFrame, run: str = "run_id") -> DataFrame:
    """sentences, kept and removed per run."""
    return sentences.groupBy(run).agg(*_tally())


def _tally() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("sentences"),
        F.count_if(F.col("action") == "KEEP").alias("keep"),
        F.count_if(F.col("action") == "REMOVE").alias("remove"),
    ]


# The markup of the review page.
_HEAD = """<!doctype html>
<html lang="en">
<head>
  <meta charset="utf-8">
  <title>s06 removal report</title>
  <style>
    body { font-family: sans-serif; margin: 24px; color: #111827; }
    h1 { margin-bottom: 8px; }
    .summary { margin-bottom: 16px; color: #374151; }
    table { border-collapse: collapse; width: 100%; }
    th, td { border: 1px solid #d1d5db; padding: 8px; vertical-align: top; }
    th { background: #f3f4f6; text-align: left; }
    tr.status-KEEP td.status { background: #ecfdf5; color: #065f46; font-weight: 600; }
    tr.status-REMOVE td.status { background: #fef2f2; color: #991b1b; font-weight: 600; }
    .empty { color: #6b7280; font-style: italic; }
  </style>
</head>
<body>
  <h1>s06 removal report</h1>"""
_TABLE = """  <table>
    <thead>
      <tr>
        <th>#</th>
        <th>span_id</th>
        <th>status</th>
        <th>label</th>
        <th>reason</th>
        <th>sentence</th>
      </tr>
    </thead>
    <tbody>"""
_EMPTY = '  <p class="empty">No sentences available.</p>'
_TABLE_END = "    </tbody>\n  </table>"
_FOOT = "</body>\n</html>"


def report_row(number: Column) -> Column:
    def cell(value: Column, css: str = "") -> Column:
        return F.concat(F.lit(f"        <td{css}>"), value, F.lit("</td>\n"))

    def shown(name: str) -> Column:
        return tx.html_escape(F.coalesce(F.col(name), F.lit("")))

    return F.concat(
        F.lit('      <tr class="status-'), F.col("action"), F.lit('">\n'),
        cell(number.cast("string")), cell(F.col("span_id").cast("string")),
        cell(shown("action"), ' class="status"'), cell(shown("label")), cell(shown("reason")),
        cell(shown("sentence")), F.lit("      </tr>"),
    )


#: Bytes up to which a page is one value where the caller sets a limit, the ordinals of a part of a longer one,
#: and roughly the bytes of a row's markup.
PAGE_BYTES, PAGE_PART, ROW_BYTES = 64 << 20, 1 << 12, 256


def review_report(
    sentences: DataFrame, runs: DataFrame, run: str = "run_id", *,
    slice_rows: int = ordered.SLICE_ROWS, part_rows: int | None = None,
    upper: int | None = None, page_bytes: int | None = None,
) -> DataFrame:
    """one HTML page per run, or its parts of ``part_rows`` ordinals each.

    Head and foot are two more rows of the page. Numbering never gathers a run
    in one task; a whole page is one value. With ``page_bytes`` only the pages beyond it
    come in parts, for a value has to fit a task and 2 GB; joined by line breaks they are the page.
    """
    if page_bytes is not None:
        size = F.sum(F.octet_length("sentence") + ROW_BYTES)
        long = write_and_read(sentences.groupBy(run).agg(size.alias("_n")).filter(F.col("_n") > page_bytes).select(run), "long-pages")
        if not long.isEmpty():
            pages = [review_report(sentences.join(long, run, how), runs.join(long, run, how), run, slice_rows=slice_rows, part_rows=rows, upper=upper)
                     for how, rows in (("left_anti", None), ("left_semi", part_rows or PAGE_PART))]
            return pages[0].unionByName(pages[1])
    if upper is None:
        upper = ordered.largest(sentences, "span_id")
    numbered = ordered.number_rows(
        sentences, [run], ["span_id", "sentence_id"], "no", slice_rows=slice_rows, upper=upper
    )
    tally = sentences.groupBy(run).agg(*_tally(), F.max("span_id").cast("bigint").alias("last"))
    counts = runs.select(run).distinct().join(tally, run, "left").na.fill(
        0, ["sentences", "keep", "remove", "last"]
    )
    summary = F.format_string(
        '  <p class="summary">sentences: %d | KEEP: %d | REMOVE: %d</p>', "sentences", "keep", "remove"
    )
    some = F.col("sentences") > 0
    start = F.lit(0).cast("bigint")
    head = counts.select(run, start.alias("at"), F.lit(-1).alias("sub"), F.concat_ws(
        "\n", F.lit(_HEAD), summary, F.when(some, F.lit(_TABLE)).otherwise(F.lit(_EMPTY))).alias("row"))
    foot = counts.select(run, (F.col("last") + 1).alias("at"), F.lit(0).alias("sub"), F.concat_ws(
        "\n", F.when(some, F.lit(_TABLE_END)), F.lit(_FOOT)).alias("row"))
    body = numbered.select(
        run, F.col("span_id").cast("bigint").alias("at"), F.col("sentence_id").alias("sub"),
        report_row(F.col("no")).alias("row"),
    )
    return ordered.assemble(
        body.unionByName(head).unionByName(foot), [run], ["at", "sub"], "row", sep="\n",
        part_rows=part_rows, upper=upper + 1,
    )


def line_changes(
    before: DataFrame, after: DataFrame, keys: list[str], text: str = "text"
) -> DataFrame:
    """multiset line difference: how often each line was removed or added.

    Both sides are counted in one shuffle with map-side combine; equal lines
    never need numbering, so a line repeated everywhere is no hot spot.
    """
    def lines(df: DataFrame, sign: int) -> DataFrame:
        split = F.split(F.col(text), "\r\n|\n|\r")
        # A final line break ends the last line, it does not start another.
        whole = F.when(F.element_at(split, -1) == "", F.slice(split, 1, F.size(split) - 1)).otherwise(split)
        return df.select(*keys, F.explode_outer(whole).alias("line"), F.lit(sign).alias("_n")).filter(
            F.col("line").isNotNull()
        )

    delta = lines(after, 1).unionByName(lines(before, -1)).groupBy(*keys, "line").agg(
        F.sum("_n").alias("_n")
    )
    return delta.filter("_n <> 0").select(
        *keys, "line", F.when(F.col("_n") > 0, "added").otherwise("removed").alias("change"),
        F.abs("_n").alias("times"),
    )
