"""File scans and sinks on temporary folders."""

import hashlib
import json

import pytest

from lectern import schemas as S
from lectern.operators import incremental as inc
from lectern.sources import files, sinks


def put(root, name, data):
    target = root / name
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_bytes(data if isinstance(data, bytes) else data.encode())


def test_recordings(spark, tmp_path):
    for name in ("lecture.wav", "nested/lecture.MP3", "nested/ignore.txt", "x.Opus.bak", "deep/er/no_suffix", "z.flac"):
        put(tmp_path, name, b"abc")
    rows = files.numbered(files.recordings(spark, str(tmp_path))).orderBy("run_index").collect()
    assert [(r.rel_path, r.run_index, r.total_runs, r.bytes) for r in rows] == [
        ("lecture.wav", 1, 3, 3), ("nested/lecture.MP3", 2, 3, 3), ("z.flac", 3, 3, 3)]
    assert "content" not in files.recordings(spark, str(tmp_path)).columns
    prints = inc.artifacts(files.recordings(spark, str(tmp_path), content=True))
    assert {r.sha256 for r in prints.collect()} == {hashlib.sha256(b"abc").hexdigest()}


def test_transcripts_and_subtitles(spark, tmp_path):
    put(tmp_path, "0001.txt", "a\r\nb\n")
    put(tmp_path, "0002.txt", "c")
    put(tmp_path, "0001.srt", "1\n00:00:00,100 --> 00:00:00,900\na\n\nx\ny\n")
    texts = files.whole_texts(spark, str(tmp_path), ".txt").orderBy("chunk_id").collect()
    assert [(r.chunk_id, r.text) for r in texts] == [(1, "a\r\nb\n"), (2, "c")]
    cues, bad = files.subtitles(spark, str(tmp_path))
    assert cues.head().start_ms == 100 and bad.head().problem.startswith("Invalid SRT timing line")
    with pytest.raises(Exception, match="Invalid SRT timing line"):
        files.subtitles(spark, str(tmp_path), strict=True)[0].collect()


def test_json_rows(spark, tmp_path):
    row = {"id": 1, "start_time": 0, "end_time": 30.0, "filename": "0001.wav", "sha256": "x"}
    put(tmp_path, "a/chunks.json", json.dumps([row, {**row, "id": 2}], indent=2))
    put(tmp_path, "b/chunks.json", json.dumps(row))
    put(tmp_path, "c/chunks.json", "[1, ")
    put(tmp_path, "d/chunks.json", json.dumps([{**row, "id": 3}, {**row, "id": "three"}]))
    rows, bad = files.json_rows(spark, str(tmp_path), S.CHUNK_ROW, "chunks.json")
    assert [(r.pos, r.id, r.start_time, r.filename) for r in rows.orderBy("pos").collect()] == [(0, 1, 0.0, "0001.wav"), (1, 2, 0.0, "0001.wav")]
    assert bad.count() == 3
    with pytest.raises(files.FormatError):
        files.require_no_rejects(bad)


def test_json_lines_round_trip(spark, make, tmp_path):
    df = make([(1, "l", None, "t")], S.REMOVED_SPANS)
    sinks.write_lines(df, str(tmp_path / "log"))
    assert files.json_lines(spark, str(tmp_path / "log"), S.REMOVED_SPANS).collect() == df.collect()


def test_manifests(spark, tmp_path):
    doc = {"stage": "s05", "status": "success", "started_at": "2024-01-01T00:00:00+00:00", "finished_at": "2024-01-01T00:00:09Z",
           "params": {"model": "m", "_inputs_signature": "sig"}, "inputs": [{"path": "/a", "sha256": "f", "bytes": 3}], "outputs": [],
           "commands": [], "tool_versions": {"t": "1"}, "llm_calls": [], "errors": [], "dry_run": False}
    put(tmp_path, "run-1/s05_asr_cleanup/manifest.json", json.dumps(doc, indent=2))
    row = files.manifests(spark, str(tmp_path)).head()
    assert (row.run_id, row.stage, row.inputs_signature, row.inputs[0].bytes) == ("run-1", "s05", "sig", 3)
    out = str(tmp_path / "table")
    sinks.write_manifests(files.manifests(spark, str(tmp_path / "run-1" / "..")).drop("commands"), out)
    assert spark.read.parquet(out).filter("stage = 's05'").count() == 1


def test_text_sink(spark, make, tmp_path):
    df = make([("a", "s07", 0, "one\n\ntwo\n"), ("b", "s07", 0, "")], "run_id STRING, stage STRING, part INT, text STRING")
    sinks.write_texts(df, str(tmp_path / "out"))
    parts = list((tmp_path / "out" / "stage=s07" / "run_id=a").glob("part-*"))
    assert [p.read_text() for p in parts] == ["one\n\ntwo\n"]


def test_text_sink_writes_empty_files(make, tmp_path):
    rows = [("a", "s07", 0, ""), ("a", "s07", 1, "one\n"), ("b", "s07", 0, ""), ("c/ :d", "s07", 0, ""), ("e", "s07", 0, None)]
    sinks.write_texts(make(rows, "run_id STRING, stage STRING, part INT, text STRING"), str(tmp_path / "out"))
    found = {p.parent.name: p.read_text() for p in (tmp_path / "out" / "stage=s07").glob("*/part-*")}
    assert found == {"run_id=a": "one\n", "run_id=b": "", "run_id=c%2F %3Ad": ""}


def test_templates_from_folders(spark, tmp_path):
    put(tmp_path, "mine/s07_editorial.txt", "CUSTOM {{text}}")
    put(tmp_path, "std/s07_editorial.txt", "STD {{text}}")
    from lectern.operators import prompts as pr

    best = pr.resolve_templates(files.template_files(spark, [str(tmp_path / "mine"), str(tmp_path / "std")]))
    assert best.head().body == "CUSTOM {{text}}"


def test_few_files_are_dealt_out(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "t"))
    dealt = files.deal_out(spark.read.parquet(str(tmp_path / "t")), "id")
    assert dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and dealt.count() == 10
    many = spark.range(100, numPartitions=20)
    assert files.deal_out(many) is many


def test_hidden_and_empty_recordings(spark, tmp_path):
    for name in ("_a.wav", ".b.mp3", ".c/_d/e.flac", "f.wav", "g/.wav", "h.wav.txt"):
        put(tmp_path, name, b"" if name == "f.wav" else b"abc")
    (tmp_path / "empty/deep").mkdir(parents=True)
    rows = files.recordings(spark, str(tmp_path), content=True).collect()
    assert sorted((r.rel_path, r.ext, r.bytes, r.content) for r in rows) == [
        (".b.mp3", "mp3", 3, b"abc"), (".c/_d/e.flac", "flac", 3, b"abc"), ("_a.wav", "wav", 3, b"abc"), ("f.wav", "wav", 0, b"")]
    with pytest.raises(Exception, match="nowhere"):
        files.recordings(spark, str(tmp_path / "nowhere")).collect()


def test_text_sink_names_and_empty_texts(spark, make, tmp_path):
    rows = [("s10", "a/b=c", 0, "one\n"), ("s10", "a/b=c", 1, "two"), ("s10", "ř %1", 0, ""), ("s10", "none", 0, None), ("s10", None, 0, "x\n"), ("s10", "tab\t", 0, "y")]
    df = make(rows, "stage STRING, run_id STRING, part INT, text STRING")
    path = str(tmp_path / "out")
    sinks.write_texts(df, path)
    found = {p.parent.name: p.read_text() for p in (tmp_path / "out").rglob("*.txt")}
    assert found == {"run_id=a%2Fb%3Dc": "one\ntwo\n", "run_id=ř %251": "", "run_id=__HIVE_DEFAULT_PARTITION__": "x\n", "run_id=tab%09": "y\n"}
    assert {r.run_id: r.value for r in spark.read.text(path, wholetext=True).select("run_id", "value").collect()} == {
        "a/b=c": "one\ntwo\n", None: "x\n", "tab\t": "y\n"}  # Spark reads the names back; it sees no empty file
    assert files.whole_texts(spark, path, ".txt", every=True).count() == 4
    assert (tmp_path / "out/_SUCCESS").read_text() == "4 files, 12 bytes\n"
    assert not list((tmp_path / "out").rglob(".*"))
    with pytest.raises(sinks.ExistingOutputError):
        sinks.write_texts(df, path)
    sinks.write_texts(df.limit(0), path, mode="ignore")
    assert len(list((tmp_path / "out").rglob("*.txt"))) == 4


def test_failed_sink_leaves_no_file(spark, make, tmp_path):
    from pyspark.sql import functions as F
    from lectern.sources import folders

    rows = make([(f"{i}.txt",) for i in range(40)], "path STRING")
    bad = rows.withColumn("content", F.when(F.col("path") == "33.txt", F.raise_error(F.lit("broken"))).otherwise("x"))
    with pytest.raises(Exception, match="broken"):
        folders.write_files(bad, str(tmp_path / "out"))
    assert not (tmp_path / "out/_SUCCESS").exists()


def test_small_texts_are_read_by_few_tasks(spark, make, tmp_path):
    sinks.write_texts(make([(f"r{i}", "s10", "" if i % 3 == 0 else f"t{i}") for i in range(40)], "run_id STRING, stage STRING, text STRING"), f"{tmp_path}/t")
    scan = files.whole_texts(spark, f"{tmp_path}/t", ".txt", every=True)
    assert sorted(r.text for r in scan.collect()) == sorted("" if i % 3 == 0 else f"t{i}\n" for i in range(40))
    assert "FileScan text" not in scan._jdf.queryExecution().executedPlan().toString()  # one task per 32 files or fewer
