"""Text to rows, rows to text: paragraphs, sentences, chunks, batches, windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lectern import schemas as S
from lectern.functions import folds, text as tx
from lectern.operators import ordered


def explode_rows(df: DataFrame, items: Column, keep: list[str], pos: str, value: str) -> DataFrame:
    """One row per array element, numbered from 1.

    The outer form plus a filter on the position: with the inner form the
    optimizer adds a size check below the generator, and pushing that check
    down evaluates the (costly) array expression again.
    """
    return df.select(*keep, F.posexplode_outer(items).alias("_pos", value)).filter(
        F.col("_pos").isNotNull()
    ).select(*keep, (F.col("_pos") + 1).alias(pos), value)


def spans(texts: DataFrame, keep: list[str], text: str = "text", sep: str = "\n\n") -> DataFrame:
    """B1: numbered non-blank paragraphs; numbering starts at 1 after filtering."""
    return explode_rows(texts, tx.paragraphs(F.col(text), sep), keep, "span_id", "text")


def sentences(rows: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """B2: numbered sentences."""
    return explode_rows(rows, tx.sentences(F.col(text)), keep, "sentence_id", "sentence")


def wrapped(paragraphs: DataFrame, keep: list[str], max_chars: int, text: str = "text") -> DataFrame:
    """Pieces of each paragraph, over-long ones wrapped at words."""
    body = tx.strip(F.col(text))
    pieces = F.when(F.length(body) <= max_chars, F.array(body)).otherwise(
        folds.wrap_paragraph(body, max_chars)
    )
    return explode_rows(paragraphs, pieces, keep, "piece_id", "piece")


def text_chunks(
    texts: DataFrame,
    keep: list[str],
    max_chars: int = S.TEXT_CHUNK_CHARS,
    text: str = "text",
    sep: str = "\n\n",
) -> DataFrame:
    """Budgeted chunks, numbered from 1. No shuffle: one row's work."""
    chunks = folds.chunk_text(F.col(text), max_chars, sep)
    return explode_rows(texts, chunks, keep, "chunk_id", "text")


def numbered_line(number: Column, text: Column) -> Column:
    return F.concat(F.lit("["), number.cast("string"), F.lit("] "), text)


def span_batches(
    spans: DataFrame,
    run: str = "run_id",
    max_size: int = S.SPAN_BATCH_SIZE,
    max_chars: int = S.SPAN_BATCH_CHARS,
    *,
    slice_rows: int = 1 << 13,
    upper: int | None = None,
) -> DataFrame:
    """Greedy batches of at most ``max_size`` spans and ``max_chars`` characters.

    Where a batch ends depends only on where it starts, and a batch never
    spans more than ``max_size`` rows. So each slice of consecutive spans is
    folded on its own, once per possible entry offset, and the small
    entry -> exit maps are chained per run. Span ids are dense from 1.
    """
    if slice_rows < max_size:
        raise ValueError("slice_rows must be >= max_size")
    chars = (F.length(numbered_line(F.col("span_id"), F.col("text"))) + 1).alias("chars")
    if upper is None:
        upper = ordered.largest(spans, "span_id")
    if upper <= slice_rows:
        return _batched_runs(spans, run, chars, max_size, max_chars)
    starts = _chained_starts(
        spans.select(run, "span_id", chars), run, F.col("span_id") - 1,
        max_size, max_chars, slice_rows,
    )
    flags = starts.select(run, "_slice", "base", F.posexplode("starts").alias("_i", "first")).select(
        run, (F.col("first") + F.col("_slice") * slice_rows).cast("int").alias("span_id"),
        (F.col("base") + F.col("_i") + 1).cast("int").alias("_batch"),
    )
    # Each start covers the spans up to the next start of the same run.
    return ordered.running(
        spans.join(flags, [run, "span_id"], "left"), [run], ["span_id"],
        [ordered.Running("batch_id", "max", F.col("_batch"))],
        slice_rows=slice_rows, upper=upper,
    ).drop("_batch")


def _batched_runs(spans, run, chars, max_size, max_chars):
    """Every run fits one slice: fold and cut within one grouping."""
    rest = [c for c in spans.columns if c not in (run, "span_id")]
    grouped = spans.groupBy(run).agg(
        F.array_sort(F.collect_list(F.struct("span_id", chars, *rest))).alias("rows")
    ).withColumn(
        "starts", _batch_starts(F.col("rows"), F.lit(0), max_size, max_chars)["starts"]
    )
    nxt = F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.size("rows") + 1))
    cut = grouped.withColumn("ends", nxt).select(
        run, "rows", F.posexplode(F.arrays_zip("starts", "ends")).alias("_i", "b")
    ).select(
        run, (F.col("_i") + 1).cast("int").alias("batch_id"),
        F.explode(F.slice("rows", F.col("b.starts"), F.col("b.ends") - F.col("b.starts"))).alias("r"),
    )
    return cut.select(run, "r.span_id", *[F.col("r")[c].alias(c) for c in rest], "batch_id")


def _batch_starts(rows: Column, entry: Column, max_size: int, max_chars: int) -> Column:
    """Fold from row ``entry`` (0-based): 1-based positions where batches start."""
    zero = F.struct(
        entry.cast("int").alias("pos"), F.lit(0).alias("n"), F.lit(0).alias("chars"),
        F.array().cast("array<int>").alias("starts"),
    )

    def step(acc: Column, row: Column) -> Column:
        fresh = (acc.n == 0) | (acc.n >= max_size) | (acc.chars + row.chars > max_chars)
        pos = acc.pos + 1
        return F.struct(
            pos.alias("pos"),
            F.when(fresh, F.lit(1)).otherwise(acc.n + 1).alias("n"),
            F.when(fresh, row.chars).otherwise(acc.chars + row.chars).alias("chars"),
            F.when(fresh, F.array_append(acc.starts, pos)).otherwise(acc.starts).alias("starts"),
        )

    rest = F.slice(rows, entry + 1, F.greatest(F.size(rows) - entry, F.lit(0)))
    return F.aggregate(rest, zero, step)


def _chained_starts(sized, run, at, max_size, max_chars, slice_rows):
    # The first max_size rows of a slice are also sent to the slice before it,
    # which needs them to see where its last batch ends.
    home = F.floor(at / slice_rows)
    local = at % slice_rows
    halo = F.when((local < max_size) & (home > 0), F.array(home, home - 1)).otherwise(F.array(home))
    slices = (
        sized.withColumn("_slice", F.explode(halo))
        .groupBy(run, "_slice")
        .agg(F.array_sort(F.collect_list(F.struct("span_id", "chars"))).alias("rows"))
    )
    # No start among the next rows means the run ends inside the open batch:
    # the exit then lies past every row of the next slice.
    walked = slices.select(
        run, "_slice",
        F.transform(
            F.sequence(F.lit(0), F.lit(max_size - 1)),
            lambda o: F.filter(
                _batch_starts(F.col("rows"), o, max_size, max_chars)["starts"],
                lambda p: p <= slice_rows + max_size,
            ),
        ).alias("walks"),
    ).select(
        run, "_slice",
        F.transform(
            "walks", lambda w: F.filter(w, lambda p: p <= slice_rows)
        ).alias("inside"),
        F.transform(
            "walks",
            lambda w: F.coalesce(
                F.array_min(F.filter(w, lambda p: p > slice_rows)) - slice_rows - 1, F.lit(max_size)
            ),
        ).alias("exits"),
    )
    hops = walked.select(
        run, "_slice", "exits",
        F.transform("inside", lambda w: F.size(w)).alias("counts"),
    )
    chain = hops.groupBy(run).agg(
        F.array_sort(F.collect_list(F.struct("_slice", "exits", "counts"))).alias("hops")
    )
    zero = F.struct(
        F.lit(0).alias("entry"), F.lit(0).alias("base"),
        F.array().cast("array<struct<slice:bigint,entry:int,base:int>>").alias("out"),
    )
    entries = chain.select(
        run,
        F.explode(
            F.aggregate(
                "hops", zero,
                lambda acc, hop: F.struct(
                    F.get(hop.exits, acc.entry).alias("entry"),
                    (acc.base + F.get(hop.counts, acc.entry)).alias("base"),
                    F.array_append(
                        acc.out,
                        F.struct(hop["_slice"].alias("slice"), acc.entry.alias("entry"),
                                 acc.base.alias("base")),
                    ).alias("out"),
                ),
                lambda acc: acc.out,
            )
        ).alias("e"),
    ).select(run, F.col("e.slice").alias("_slice"), "e.entry", "e.base")
    return walked.join(entries, [run, "_slice"]).select(
        run, "_slice", "base", F.get("inside", F.col("entry")).alias("starts")
    )


def windows(
    paragraphs: DataFrame,
    run: str = "run_id",
    size: int = S.WINDOW_SIZE,
    overlap: int = S.WINDOW_OVERLAP,
    ordinal: str = "span_id",
) -> DataFrame:
    """Overlapping windows of consecutive paragraphs, bounded groups.

    Paragraph p falls in window floor((p-1)/step) and in the earlier ones it
    overlaps. A later window that holds only overlap is dropped.
    """
    overlap = min(overlap, size - 1)
    step = size - overlap
    p = F.col(ordinal) - 1
    latest = F.floor(p / step)
    earliest = F.greatest(F.lit(0), F.ceil((p - size + 1) / step))
    placed = paragraphs.withColumn("_k", F.explode(F.sequence(earliest, latest)))
    grouped = placed.groupBy(run, "_k").agg(
        F.array_sort(F.collect_list(F.struct(F.col(ordinal).alias("id"), "text"))).alias("rows")
    )
    return grouped.filter((F.col("_k") == 0) | (F.size("rows") > overlap)).select(
        run,
        (F.col("_k") + 1).cast("int").alias("batch_id"),
        F.element_at("rows", 1)["id"].alias("start_paragraph"),
        F.element_at("rows", -1)["id"].alias("end_paragraph"),
        "rows",
    )


def render_lines(rows: Column) -> Column:
    """B7: '[id] text' lines of an ordered array of (id, text)."""
    return F.array_join(F.transform(rows, lambda r: numbered_line(r.id, r.text)), "\n")


def batch_lines(batched: DataFrame, run: str = "run_id", ordinal: str = "span_id") -> DataFrame:
    """B7 over span rows: one numbered text per (run, batch)."""
    return batched.groupBy(run, "batch_id").agg(
        F.array_sort(F.collect_list(F.struct(F.col(ordinal).alias("id"), "text"))).alias("rows")
    ).select(
        run, "batch_id", F.size("rows").alias("span_count"), render_lines(F.col("rows")).alias("lines")
    )


def reassemble(chunks: DataFrame, keys: list[str], ordinal: str = "chunk_id",
               text: str = "text", **kw) -> DataFrame:
    """Chunk outputs in order; empty ones stay as empty elements."""
    return ordered.assemble(chunks, keys, [ordinal], text, **kw)


def final_condensed(text: Column, fallback: Column) -> Column:
    """Drop block headings; nothing left means the joined block bodies."""
    cleaned = tx.drop_block_headings(text)
    return F.when(cleaned == "", tx.strip(F.coalesce(fallback, F.lit("")))).otherwise(cleaned)
