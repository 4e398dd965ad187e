import io
import wave

import pytest
from pyspark.sql import functions as F

from lectern.functions import timecode as tc
from lectern.operators import timeline as tl


def wav(seconds, rate=16000):
    buf = io.BytesIO()
    with wave.open(buf, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(b"\0\0" * int(seconds * rate))
    return bytearray(buf.getvalue())


def test_durations_and_timeline(make):
    df = make([("r", 1, wav(30)), ("r", 2, wav(12.5)), ("r", 3, bytearray(b"junk")), ("r", 4, bytearray())],
              "run_id STRING, chunk_id INT, content BINARY")
    rows = tl.timeline(tl.durations(df, 30)).orderBy("chunk_id").collect()
    assert [(r.start_s, r.end_s) for r in rows] == [(0, 30), (30, 42.5), (42.5, 72.5), (72.5, 102.5)]


def test_segments_keep_tail(make):
    df = make([("r", 42.5), ("none", 0.0)], "run_id STRING, duration_s DOUBLE")
    assert [tuple(r)[1:] for r in tl.segments(df).orderBy("chunk_id").collect()] == [
        (1, 0.0, 30.0, "0001.wav"), (2, 30.0, 42.5, "0002.wav")]


def merged(make, srts, starts):
    subs = make([("r", i, s) for i, s in enumerate(srts, 1)], "run_id STRING, chunk_id INT, text STRING")
    index = make([("r", i, s) for i, s in enumerate(starts, 1)], "run_id STRING, chunk_id INT, start_s DOUBLE")
    cues, _ = tl.split_cues(tl.parse_cues(subs, ["run_id", "chunk_id"]))
    return tl.render_subtitles(tl.shift_cues(cues, index)).head().text


def test_subtitle_merge(make):
    tide, ebb = "7\n00:00:02,340 --> 00:00:04,010\nhigh tide\n", "3\n00:00:11,875 --> 00:00:13,125\nlow tide\n"
    assert merged(make, [tide, ebb], [1.5, 3590.0]) == (
        "1\n00:00:03,840 --> 00:00:05,510\nhigh tide\n\n2\n01:00:01,875 --> 01:00:03,125\nlow tide\n")
    assert "00:01:24,250 --> 00:01:26,875" in merged(make, ["9\n00:00:07.250 --> 00:00:09.875\nspring"], [77.0])
    assert "00:00:08,200 -->" in merged(make, ["00:00:08,2 --> 00:00:09,6\nneap"], [None])


def test_bad_cues(make):
    text = "1\n00:00:01,0 --> 00:00:02,0\nok\n\nlone\n\nno timing\nhere\n\n00:0x:00,1 --> 00:00:01,0\nq"
    parsed = tl.parse_cues(make([("p", text)], "path STRING, text STRING"), ["path"])
    good, bad = tl.split_cues(parsed)
    assert (good.count(), bad.count()) == (1, 2)
    with pytest.raises(Exception, match="Invalid SRT timing line"):
        tl.split_cues(parsed, strict=True)[0].collect()


@pytest.mark.parametrize("value,ms", [
    ("01:02:03,4", 3723400), ("00:00:00.12345", 123), ("0:0:1,5.3", None), ("00:00:01", None), ("1:2,3", None),
    ("00:00:01,", 1000), ("00:00:01.5,3", None),
])
def test_time_codes(make, value, ms):
    assert make([(value,)], "v STRING").select(tc.parse_ms(F.col("v"))).head()[0] == ms


def test_negative_time_shows_zero(make):
    assert make([(-5,)], "v LONG").select(tc.format_ms(F.col("v"))).head()[0] == "00:00:00,000"


def test_index_keeps_start_and_reports_missing(make):
    chunks = make([("r", 1, "0001.wav", 0.0, 30.0), ("r", 2, "0002.wav", 30.0, 31.0)],
                  "run_id STRING, chunk_id INT, filename STRING, start_s DOUBLE, end_s DOUBLE")
    files = make([("r", 1, "txt", "0001.txt"), ("r", 1, "srt", "0001.srt"), ("r", 2, "txt", "0002.txt")],
                 "run_id STRING, chunk_id INT, kind STRING, name STRING")
    index, missing = tl.transcript_index(chunks, files)
    row = index.head()
    assert (row.start_s, row.txt_filename, row.srt_filename) == (0.0, "0001.txt", "0001.srt")
    assert missing.head().chunk_id == 2
    with pytest.raises(tl.MissingTranscriptError):
        tl.transcript_index(chunks, files, strict=True)


def test_transcript_merge(make):
    df = make([("r", 2, "b\n"), ("r", 10, " c"), ("r", 1, "a"), ("r", 3, " ")], "run_id STRING, chunk_id INT, text STRING")
    assert tl.merge_transcripts(df).head().text == "a\n\nb\n\nc\n"
