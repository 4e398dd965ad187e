"""Chunk timelines, transcript indexes and subtitle merging."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lectern import schemas as S
from lectern.functions import text as tx, timecode as tc
from lectern.operators import ordered


class SubtitleError(ValueError):
    """A subtitle block has no usable timing line."""


class MissingTranscriptError(FileNotFoundError):
    """A chunk has no transcript or subtitle file."""


def durations(recordings: DataFrame, nominal: float = S.CHUNK_SECONDS) -> DataFrame:
    """``duration_s`` from the audio header, nominal when unreadable."""
    return recordings.withColumn("duration_s", tc.wav_seconds(F.col("content"), F.lit(float(nominal))))


def segments(recordings: DataFrame, seconds: int = S.CHUNK_SECONDS, run: str = "run_id") -> DataFrame:
    """Fixed-length cuts; the short tail is kept. Row-local, no shuffle."""
    if seconds <= 0:
        raise ValueError("seconds must be > 0")
    count = F.ceil(F.col("duration_s") / seconds)
    starts = F.when(count > 0, F.sequence(F.lit(0).cast("bigint"), count - 1)).otherwise(
        F.array().cast("array<bigint>")
    )
    return recordings.select(
        run, "duration_s", F.explode_outer(starts).alias("_k")
    ).filter("_k IS NOT NULL").select(
        run,
        (F.col("_k") + 1).cast("int").alias("chunk_id"),
        (F.col("_k") * seconds).cast("double").alias("start_s"),
        F.least((F.col("_k") + 1) * seconds, F.col("duration_s")).cast("double").alias("end_s"),
        F.format_string("%04d.wav", F.col("_k") + 1).alias("filename"),
    )


def timeline(chunks: DataFrame, run: str = "run_id", **kw) -> DataFrame:
    """start = sum of earlier durations; both ends rounded after summing."""
    summed = ordered.running(
        chunks, [run], ["chunk_id"],
        [ordered.Running("_start", "sum", F.col("duration_s"), inclusive=False)], **kw,
    )
    return summed.select(
        *chunks.columns,
        F.round("_start", 3).alias("start_s"),
        F.round(F.col("_start") + F.col("duration_s"), 3).alias("end_s"),
    )


def parse_cues(subtitles: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """A4 + C4: subtitle text -> cue rows with ``problem`` for unusable ones."""
    blocks = F.filter(tx.literal_split(tx.strip(F.col(text)), "\n\n"), lambda b: ~tx.is_blank(b))
    rows = subtitles.select(*keep, F.posexplode_outer(blocks).alias("_pos", "_block")).filter("_pos IS NOT NULL")
    lines = F.filter(
        F.transform(F.split("_block", "\r\n|\n|\r"), tx.rstrip), lambda x: x != ""
    )
    rows = rows.withColumn("_lines", lines).filter(F.size("_lines") >= 2)
    head = F.when(F.element_at("_lines", 1).rlike(r"(?U)\A\d+\z"), F.lit(2)).otherwise(F.lit(1))
    rows = rows.withColumn("_at", head).withColumn("_timing", F.element_at("_lines", F.col("_at")))
    ends = F.split("_timing", "-->", 2)
    rows = rows.withColumns({
        "_start": tx.strip(F.get(ends, F.lit(0))), "_end": tx.strip(F.get(ends, F.lit(1))),
    }).withColumns({"start_ms": tc.parse_ms(F.col("_start")), "end_ms": tc.parse_ms(F.col("_end"))})
    problem = F.when(
        ~F.col("_timing").contains("-->"), F.concat(F.lit("Invalid SRT timing line: "), "_timing")
    ).when(
        F.col("start_ms").isNull() | F.col("end_ms").isNull(),
        F.concat(F.lit("Invalid SRT timestamp: "), "_timing"),
    )
    return rows.select(
        *keep,
        (F.col("_pos") + 1).cast("int").alias("cue_pos"),
        "start_ms", "end_ms",
        F.slice("_lines", F.col("_at") + 1, F.size("_lines")).alias("text_lines"),
        problem.alias("problem"),
    )


def split_cues(parsed: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good cues, rejects). Strict mode fails the job on the first bad cue."""
    if strict:
        checked = F.when(F.col("problem").isNotNull(), F.raise_error(F.col("problem")).cast("int")).otherwise(F.lit(0))
        return parsed.filter(checked == 0).drop("problem"), parsed.limit(0)
    return parsed.filter(F.col("problem").isNull()).drop("problem"), parsed.filter(F.col("problem").isNotNull())


def shift_cues(
    cues: DataFrame, index: DataFrame, run: str = "run_id", *, slice_rows: int = ordered.SLICE_ROWS,
    upper: int | None = None,
) -> DataFrame:
    """Cues moved by their chunk's start and numbered once per run.

    Joined on (run, chunk), so a long recording spreads over its chunks.
    """
    offsets = index.select(
        run, "chunk_id",
        F.coalesce((F.col("start_s") * 1000).cast("bigint"), F.lit(0)).alias("_offset"),
    )
    if upper is None:
        upper = ordered.largest(index, "chunk_id")
    moved = cues.join(offsets, [run, "chunk_id"]).withColumns({
        "start_ms": F.col("start_ms") + F.col("_offset"),
        "end_ms": F.col("end_ms") + F.col("_offset"),
    }).drop("_offset")
    numbered = ordered.number_rows(
        moved, [run], ["chunk_id", "cue_pos"], "cue_no", slice_rows=slice_rows, upper=upper
    )
    return numbered


def merge_transcripts(texts: DataFrame, run: str = "run_id", **kw) -> DataFrame:
    """Chunk texts in numeric order, stripped, blank ones dropped."""
    clean = texts.withColumn("text", tx.strip(F.col("text")))
    return ordered.assemble(clean, [run], ["chunk_id"], "text", drop_blank=True, **kw)


def cue_block(number, start_ms, end_ms, lines):
    timing = F.concat(tc.format_ms(start_ms), F.lit(" --> "), tc.format_ms(end_ms))
    head = F.array(number.cast("string"), timing)
    return tx.strip(F.array_join(F.concat(head, lines), "\n"))


def render_subtitles(numbered: DataFrame, run: str = "run_id", **kw) -> DataFrame:
    """Numbered cues -> subtitle text per run."""
    blocks = numbered.select(
        run, "chunk_id", "cue_pos",
        cue_block(F.col("cue_no"), F.col("start_ms"), F.col("end_ms"), F.col("text_lines")).alias("block"),
    )
    return ordered.assemble(blocks, [run], ["chunk_id", "cue_pos"], "block", **kw)


def transcript_index(
    chunks: DataFrame, files: DataFrame, run: str = "run_id", strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(index rows, rows lacking a text or subtitle file).

    ``files(run, chunk_id, kind, name)`` with kind 'txt' or 'srt'.
    """
    found = files.groupBy(run, "chunk_id").agg(
        F.min(F.when(F.col("kind") == "txt", F.col("name"))).alias("txt_filename"),
        F.min(F.when(F.col("kind") == "srt", F.col("name"))).alias("srt_filename"),
    )
    joined = chunks.select(
        run, "chunk_id", F.col("filename").alias("chunk_filename"), "start_s", "end_s"
    ).join(found, [run, "chunk_id"], "left")
    lacking = F.col("txt_filename").isNull() | F.col("srt_filename").isNull()
    missing = joined.filter(lacking)
    if strict:
        first = missing.select(run, "chunk_id").head()
        if first is not None:
            raise MissingTranscriptError(f"run {first[0]}: no transcript for chunk {first[1]}")
    return joined.filter(~lacking), missing
