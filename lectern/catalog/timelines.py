"""C and A4: durations, segments, timelines, subtitles, transcript index."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.catalog.base import query, sql_strip, table
from lectern.functions import timecode as tc
from lectern.operators import ordered, timeline as tl


def _turns(spark, sf):
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("run_id"), (F.col("turn") + 1).cast("int").alias("chunk_id"), "role", "text",
        (F.length("text") / 16.0).cast("double").alias("duration_s"))


@query("c1_wav_durations", """SELECT conv_id AS run_id, (turn + 1)::INT AS chunk_id,
  CASE WHEN turn % 5 = 0 THEN 30.0::DOUBLE ELSE (length(text) * 100)::DOUBLE / 16000.0 END AS duration_s
FROM conversations""")
def wav_durations(spark, sf):
    """RIFF headers whose data size follows the text length; every fifth is broken."""
    def le(value, width):
        big = F.lpad(F.hex(value), 2 * width, "0")
        return F.concat(*[F.substring(big, 2 * i - 1, 2) for i in range(width, 0, -1)])

    size = F.length("text").cast("bigint") * 200
    header = F.concat(
        F.lit("52494646"), le(size + 44, 4), F.lit("57415645"),
        F.lit("4C495354"), le(F.lit(8), 4), F.lit("0102030405060708"),
        F.lit("666D7420"), le(F.lit(16), 4), F.lit("01000100"), le(F.lit(16000), 4), le(F.lit(32000), 4),
        F.lit("02001000"), F.lit("64617461"), le(size, 4),
    )
    broken = F.when(F.col("chunk_id") % 5 == 1, F.lit("00")).otherwise(F.lit(""))
    wavs = _turns(spark, sf).drop("duration_s").withColumn("content", F.unhex(F.concat(broken, header)))
    return tl.durations(wavs).select("run_id", "chunk_id", "duration_s")


@query("c2_segments", """WITH r AS (SELECT conv_id, sum(length(text)) / 16.0::DOUBLE AS d FROM conversations GROUP BY conv_id)
SELECT conv_id AS run_id, (k + 1)::INT AS chunk_id, (k * 30)::DOUBLE AS start_s,
       least((k + 1) * 30, d)::DOUBLE AS end_s, lpad((k + 1)::VARCHAR, 4, '0') || '.wav' AS filename
FROM r, unnest(range(0, ceil(d / 30)::BIGINT)) AS t(k)""")
def segments(spark, sf):
    runs = _turns(spark, sf).groupBy("run_id").agg((F.sum(F.length("text")) / 16.0).alias("duration_s"))
    return tl.segments(runs)


_TIMELINE = """line AS (
  SELECT conv_id AS run_id, (turn + 1)::INT AS chunk_id, text, role,
    round(coalesce(sum(length(text) / 16.0::DOUBLE) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 3) AS start_s,
    round(sum(length(text) / 16.0::DOUBLE) OVER (PARTITION BY conv_id ORDER BY turn), 3) AS end_s
  FROM conversations)"""


@query("c3_timeline", f"WITH {_TIMELINE} SELECT run_id, chunk_id, start_s, end_s FROM line")
def timeline(spark, sf):
    return tl.timeline(_turns(spark, sf)).select("run_id", "chunk_id", "start_s", "end_s")


query("c3_timeline_sliced", f"WITH {_TIMELINE} SELECT run_id, chunk_id, start_s, end_s FROM line")(
    lambda spark, sf: tl.timeline(_turns(spark, sf), slice_rows=3).select("run_id", "chunk_id", "start_s", "end_s"))


@query("c4_time_codes", """SELECT conv_id, turn,
  CASE WHEN turn % 4 = 3 THEN NULL
       WHEN turn % 4 = 2 THEN (length(text)::BIGINT * 7919) // 100 * 100
       ELSE length(text)::BIGINT * 7919 END AS ms
FROM conversations""")
def time_codes(spark, sf):
    """Comma, point, one-digit fraction and malformed spellings, read back."""
    ms = F.length("text").cast("bigint") * 7919
    shown = tc.format_ms(ms)
    spelled = F.when(F.col("turn") % 4 == 3, F.replace(shown, F.lit(":"), F.lit("-"))).when(
        F.col("turn") % 4 == 2, F.substring(F.replace(shown, F.lit(","), F.lit(".")), F.lit(1), F.length(shown) - 2)
    ).when(F.col("turn") % 4 == 1, F.replace(shown, F.lit(","), F.lit("."))).otherwise(shown)
    return table(spark, sf, "conversations").select("conv_id", "turn", tc.parse_ms(spelled).alias("ms"))


def _subtitles(turns):
    """Two cues per turn, the second only for every other turn, plus noise."""
    n = F.length("text").cast("bigint")
    first = F.concat_ws("\n", F.lit("1"), F.concat(tc.format_ms(n), F.lit(" --> "), tc.format_ms(n * 2)), F.col("role"), F.lit("said"))
    second = F.concat_ws("\n", F.concat(tc.format_ms(n * 2), F.lit(" --> "), tc.format_ms(n * 3)), F.lit("more"))
    lone = F.lit("lone line")
    even = F.col("chunk_id") % 2 == 0
    return turns.withColumn("text", F.concat_ws("\n\n", first, lone, F.when(even, second)))


_CUES = _TIMELINE + """,
cues AS (
  SELECT run_id, chunk_id, 1 AS cue_pos, length(text)::BIGINT AS a, length(text)::BIGINT * 2 AS b, [role, 'said'] AS lines, start_s FROM line
  UNION ALL
  SELECT run_id, chunk_id, 3, length(text)::BIGINT * 2, length(text)::BIGINT * 3, ['more'], start_s FROM line WHERE chunk_id % 2 = 0),
moved AS (
  SELECT run_id, chunk_id, cue_pos, a + trunc(start_s * 1000)::BIGINT AS start_ms, b + trunc(start_s * 1000)::BIGINT AS end_ms, lines,
         row_number() OVER (PARTITION BY run_id ORDER BY chunk_id, cue_pos) AS cue_no FROM cues)"""


def _shifted(spark, sf, **kw):
    turns = _turns(spark, sf)
    cues, _ = tl.split_cues(tl.parse_cues(_subtitles(turns), ["run_id", "chunk_id"]))
    return tl.shift_cues(cues, tl.timeline(turns), **kw)


@query("a4_subtitle_cues", f"""WITH {_CUES}
SELECT run_id, chunk_id, cue_pos::INT AS cue_pos, a AS start_ms, b AS end_ms, array_to_string(lines, '|') AS lines FROM cues""")
def subtitle_cues(spark, sf):
    cues, _ = tl.split_cues(tl.parse_cues(_subtitles(_turns(spark, sf)), ["run_id", "chunk_id"]))
    return cues.select("run_id", "chunk_id", "cue_pos", "start_ms", "end_ms", F.array_join("text_lines", "|").alias("lines"))


@query("c5_shifted_cues", f"WITH {_CUES} SELECT run_id, chunk_id, start_ms, end_ms, cue_no FROM moved")
def shifted_cues(spark, sf):
    return _shifted(spark, sf).select("run_id", "chunk_id", "start_ms", "end_ms", "cue_no")


query("c5_shifted_cues_sliced", f"WITH {_CUES} SELECT run_id, chunk_id, start_ms, end_ms, cue_no FROM moved")(
    lambda spark, sf: _shifted(spark, sf, slice_rows=2).select("run_id", "chunk_id", "start_ms", "end_ms", "cue_no"))


@query("c6_merged_transcripts", f"""WITH t AS (
  SELECT conv_id AS run_id, turn, CASE WHEN turn % 3 = 1 THEN '' ELSE {sql_strip('text')} END AS x FROM conversations),
j AS (SELECT run_id, string_agg(x, chr(10) || chr(10) ORDER BY turn) FILTER (WHERE x <> '') AS t FROM t GROUP BY run_id)
SELECT run_id, 0::INT AS part, CASE WHEN t IS NULL THEN '' ELSE t || chr(10) END AS text FROM j""")
def merged_transcripts(spark, sf):
    turns = _turns(spark, sf)
    texts = turns.withColumn("text", F.when(F.col("chunk_id") % 3 == 2, F.lit(" \n\t")).otherwise(F.concat(F.lit(" "), F.col("text"), F.lit("\n"))))
    return tl.merge_transcripts(texts, runs=turns.select("run_id"))


_MS = "lpad((({x}) // 3600000)::VARCHAR, greatest(2, length((({x}) // 3600000)::VARCHAR))::INT, '0') || ':' || lpad((({x}) // 60000 % 60)::VARCHAR, 2, '0') || ':' || lpad((({x}) // 1000 % 60)::VARCHAR, 2, '0') || ',' || lpad((({x}) % 1000)::VARCHAR, 3, '0')"


@query("c7_subtitle_text", f"""WITH {_CUES}
SELECT run_id, 0::INT AS part, string_agg(cue_no || chr(10) || {_MS.format(x='start_ms')} || ' --> ' || {_MS.format(x='end_ms')} || chr(10) || array_to_string(lines, chr(10)),
  chr(10) || chr(10) ORDER BY cue_no) || chr(10) AS text
FROM moved GROUP BY run_id""")
def subtitle_text(spark, sf):
    return tl.render_subtitles(_shifted(spark, sf), upper=ordered.largest(_turns(spark, sf), "chunk_id"))


def _index(spark, sf):
    turns = _turns(spark, sf)
    chunks = tl.timeline(turns).withColumn("filename", F.format_string("%04d.wav", "chunk_id"))
    files = turns.select(
        "run_id", "chunk_id",
        F.explode(F.filter(F.array(
            F.when(F.col("chunk_id") % 7 != 0, F.struct(F.lit("txt").alias("kind"), F.format_string("%04d.txt", "chunk_id").alias("name"))),
            F.when(F.col("chunk_id") % 5 != 0, F.struct(F.lit("srt").alias("kind"), F.format_string("%04d.srt", "chunk_id").alias("name"))),
        ), lambda x: x.isNotNull())).alias("f"),
    ).select("run_id", "chunk_id", "f.kind", "f.name")
    return tl.transcript_index(chunks, files)


@query("c8_transcript_index", f"""WITH {_TIMELINE}
SELECT run_id, chunk_id, lpad(chunk_id::VARCHAR, 4, '0') || '.wav' AS chunk_filename, start_s, end_s,
       lpad(chunk_id::VARCHAR, 4, '0') || '.txt' AS txt_filename, lpad(chunk_id::VARCHAR, 4, '0') || '.srt' AS srt_filename
FROM line WHERE chunk_id % 7 <> 0 AND chunk_id % 5 <> 0""")
def transcript_index(spark, sf):
    return _index(spark, sf)[0]


@query("c8_missing_transcripts", f"""WITH {_TIMELINE}
SELECT run_id, chunk_id, chunk_id % 7 <> 0 AS has_text, chunk_id % 5 <> 0 AS has_subtitle
FROM line WHERE chunk_id % 7 = 0 OR chunk_id % 5 = 0""")
def missing_transcripts(spark, sf):
    return _index(spark, sf)[1].select(
        "run_id", "chunk_id", F.col("txt_filename").isNotNull().alias("has_text"),
        F.col("srt_filename").isNotNull().alias("has_subtitle"))
