"""Transcripts on disk to published text, all stages, two recordings at once."""

from pyspark.sql import functions as F

from fakes import Staged
from lectern.operators import incremental as inc, runlog as rl, timeline as tl
from lectern.plans import stages as st
from lectern.sources import files, sinks


def test_all_stages(spark, make, tmp_path):
    spoken = {"talk": ["One uh idea.", "audience chatter"], "other": ["Two.", " "]}
    for run, chunks in spoken.items():
        for i, text in enumerate(chunks, 1):
            target = tmp_path / "in" / run / f"{i:04d}"
            target.parent.mkdir(parents=True, exist_ok=True)
            target.with_suffix(".txt").write_text(text + "\n")
            target.with_suffix(".srt").write_text(f"1\n00:00:00,000 --> 00:00:01,000\n{text.strip() or 'noise'}\n")
    run_id = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    transcripts = files.whole_texts(spark, str(tmp_path / "in"), ".txt").withColumn("run_id", run_id)
    cues, bad = files.subtitles(spark, str(tmp_path / "in"))
    assert bad.isEmpty()
    chunks = tl.timeline(transcripts.select("run_id", "chunk_id", F.lit(30.0).alias("duration_s")))
    subtitles = tl.render_subtitles(tl.shift_cues(cues.withColumn("run_id", run_id), chunks))
    assert "2\n00:00:30,000 --> 00:00:31,000\naudience chatter\n" in {r.run_id: r.text for r in subtitles.collect()}["talk"]

    setup = st.ModelSetup(Staged, "m")
    merged = tl.merge_transcripts(transcripts).drop("part")
    cleaned = st.text_transform(merged, "s05", "clean:{{text}}", setup)
    content = st.classify(cleaned.texts, "classify:\n{{span_lines}}", "fix {{original_prompt}}", setup)
    edited = st.text_transform(content.texts, "s07", "edit:{{text}}", setup)
    condensed = st.condense(edited.texts, "map:\n{{paragraph_lines}}", "reduce:{{candidate_blocks_json}}", setup)
    signed = edited.texts.withColumn("signature", F.sha2("text", 256)).drop("part", "stage")
    manifests = signed.select("run_id", F.lit("s08").alias("stage"), F.lit("success").alias("status"), F.lit("1").alias("finished_at"),
                              F.when(F.col("run_id") == "talk", F.col("signature")).otherwise("old").alias("inputs_signature"))
    source = inc.fresh_source(signed, condensed.texts.select("run_id", "text"), manifests)
    assert {r.run_id: r.input_source_stage for r in source.collect()} == {"talk": "s08", "other": "s07"}
    translated = st.text_transform(source, "s09", "translate:{{text}}", setup)
    polished = st.text_transform(translated.texts, "s10", "polish:{{text}}", setup)

    path = str(tmp_path / "texts")
    for result in (edited, condensed, translated, polished):
        sinks.save_runs(result.texts, path, "fail", buckets=4)
    best = inc.best_output(spark.read.parquet(path).drop(sinks.BUCKET))
    assert {r.run_id: (r.stage, r.text) for r in best.collect()} == {
        "talk": ("s10", "polish(translate(One idea.))\n"), "other": ("s10", "polish(translate(Two.))\n")}
    done = spark.read.parquet(path).select("run_id", "stage", F.lit("success").alias("status"), F.lit("1").alias("finished_at"))
    row = rl.stage_matrix(done, first="s07", last="s10").filter("run_id = 'talk'").head()
    assert tuple(row)[1:] == ("success",) * 4
