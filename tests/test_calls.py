"""Budgets, costs, calling, repair rounds and whole st."""

import os
import time

import pytest
from pyspark.sql import functions as F

from fakes import Broken, Chatty, Condenser, Never, Picky, Silent, Slow, Tallying, Upper
from lectern.operators import calls as ca, ordered, prompts as pr
from lectern.plans import stages as st


def prompts(make, rows):
    return make([(*r, "s08", "chunk", 0, "openai", "gpt-5-mini", 0.1, None, None) for r in rows],
                "run_id STRING, batch_id INT, prompt STRING, stage STRING, phase STRING, retry_index INT, provider STRING, "
                "model STRING, temperature DOUBLE, in_tok LONG, out_tok LONG")


def test_preflight_cost_cap(make):
    df = prompts(make, [("big", 1, "very long prompt " * 5000), ("ok", 1, " ")])
    ready, rejected = ca.admit(df, caps=ca.Caps(cost_usd=1e-6))
    assert [r.breach for r in rejected.collect()] == ["cost_cap_usd"]
    assert [r.run_id for r in ready.collect()] == ["ok"]
    with pytest.raises(ca.BudgetError):
        ca.admit(df, caps=ca.Caps(cost_usd=1e-6), strict=True)
    local = df.withColumn("provider", F.lit("local"))
    assert ca.admit(local, caps=ca.Caps(cost_usd=1e-6))[1].isEmpty()


@pytest.mark.parametrize("slice_rows", [1 << 18, 2])
def test_runtime_caps(make, slice_rows):
    df = prompts(make, [("r", i, "p" * 20) for i in range(1, 7)]).withColumn(
        "out_tok", F.when(F.col("batch_id") >= 3, F.lit(50)).otherwise(F.lit(2)).cast("bigint"))
    costs = ca.running_costs(df, slice_rows=slice_rows)
    assert [tuple(r)[2:] for r in ca.cap_breaches(costs, caps=ca.Caps(tokens_out=10)).collect()] == [(3, "token_cap_output")]
    assert [tuple(r)[2:] for r in ca.cap_breaches(costs, caps=ca.Caps(calls=4)).collect()] == [(5, "max_calls")]
    last = costs.filter("batch_id = 6").head()
    assert (last.cum_in, last.cum_out, last.call_no) == (30, 204, 6)
    assert float(last.cum_cost) == pytest.approx(30 / 1e6 * 0.25 + 204 / 1e6 * 2.0)


def test_estimates(make):
    df = prompts(make, [("r", 1, "abcde"), ("r", 2, "  "), ("r", 3, " a ")])
    got = [(r.est_in, r.est_out) for r in ca.estimated(df).orderBy("batch_id").collect()]
    assert got == [(2, 2), (0, 0), (1, 1)]


def test_equal_prompts_share_a_reply(make):
    rows = [("r", i, f"p{i % 3}") for i in range(60)]
    df = prompts(make, rows).drop("in_tok", "out_tok")
    got = ca.call_model(df, Upper, tasks=3, hot_copies=10, salts=4)
    assert sorted((r.batch_id, r.response) for r in got.collect()) == [(i, f"P{i % 3}") for i in range(60)]
    known = got.select("model", "temperature", "prompt_hash", F.lit(20).cast("bigint").alias("copies"), "response", "in_tok", "out_tok").dropDuplicates(["prompt_hash"])
    assert ca.call_model(df, Never, known=known).count() == 60


def test_template_errors(make):
    templates = make([("t", "CUSTOM: {{text}}"), ("b", "Broken {{missing}}")], "name STRING, body STRING")
    rows = make([("t", "abc"), ("t", "{{text}}")], "name STRING, text STRING")
    good = templates.filter("name = 't'")
    assert sorted(r.prompt for r in pr.render(rows, good, {"text": F.col("text"), "more": F.lit("")}).collect()) == ["CUSTOM: abc", "CUSTOM: {{text}}"]
    with pytest.raises(pr.TemplateError, match="b: missing"):
        pr.render(rows, templates, {"text": F.col("text")})


def test_template_choice_and_audit(spark, make):
    rows = [("mine", 0, "s08_translate.txt", "old {{text}}"), ("built-in", 1, "s09_translate.txt", "new {{text}}"),
            ("built-in", 1, "s05_cleanup.txt", "Bad {{unknown}}"), ("mine", 0, "s07_editorial.txt", "{{text}}"),
            ("built-in", 1, "s07_editorial.txt", "no"), ("mine", 0, "s09_czech_editorial.txt", "older"), ("mine", 0, "s10_czech_editorial.txt", "newer")]
    best = pr.resolve_templates(make(rows, "root STRING, root_priority INT, name STRING, body STRING"))
    assert {r.template_key: r.body for r in best.collect()}.items() >= {
        "s09_translate.txt": "old {{text}}", "s07_editorial.txt": "{{text}}", "s05_cleanup.txt": "Bad {{unknown}}",
        "s10_czech_editorial.txt": "newer"}.items()
    audit = {r.template_key: (r.unknown, r.missing, r.verdict) for r in pr.audit_templates(best, pr.catalog(spark)).collect()}
    assert audit["s05_cleanup.txt"] == (["unknown"], ["text"], "reject")
    assert audit["s10_czech_editorial.txt"] == ([], ["text"], "warn")


def setup(model, **kw):
    return st.ModelSetup(model, "m", **kw)


def texts(make, *rows):
    return make(list(rows), "run_id STRING, text STRING")


def test_text_transform(make):
    df = texts(make, ("a", "First paragraph text.\n\nSecond paragraph text."), ("empty", " \n\n\t"))
    res = st.text_transform(df, "s07", "{{text}}", setup(Upper), max_chars=30, with_edits=True)
    assert {r.run_id: r.text for r in res.texts.collect()} == {
        "a": "FIRST PARAGRAPH TEXT.\n\nSECOND PARAGRAPH TEXT.\n", "empty": ""}
    log = res.calls.orderBy("batch_id").collect()
    assert [(r.run_id, r.batch_id, r.in_tok, r.cost_usd) for r in log] == [("a", 1, 1, 0.0), ("a", 2, 1, 0.0)]
    assert res.extra["line_changes"].count() == 4


def test_text_transform_over_budget(make):
    df = texts(make, ("a", "word " * 400), ("b", "short"))
    res = st.text_transform(df, "s07", "{{text}}", setup(Upper, provider="openai", caps=ca.Caps(tokens_in=100)))
    assert [(r.run_id, r.breach) for r in res.rejected.collect()] == [("a", "token_cap_input")]
    assert [(r.run_id, r.text) for r in res.texts.collect()] == [("b", "SHORT\n")]


def test_classify(make):
    df = texts(make, ("r", "Is this seat free?\n\nGlaciers carve valleys"), ("x", "hopeless"), ("e", " \n\n\t"))
    res = st.classify(df, "C {{span_lines}}", "Fix {{original_prompt}} {{bad_response}}", setup(Chatty))
    assert {r.run_id: r.text for r in res.texts.collect()} == {"r": "Glaciers carve valleys\n", "e": ""}
    log = res.calls.groupBy("run_id").count().collect()
    assert {r.run_id: r["count"] for r in log} == {"r": 2, "x": 4}
    assert [(r.run_id, r.breach) for r in res.rejected.collect()] == [("x", "invalid_json")]
    assert [tuple(r) for r in res.extra["removed"].select("span_id", "label", "reason", "text").collect()] == [
        (1, "SEATING", "asks for a seat", "Is this seat free?")]
    report = {r.run_id: r.text for r in res.extra["report"].collect()}
    assert "sentences: 2 | KEEP: 1 | REMOVE: 1" in report["r"] and "No sentences available" in report["e"]
    with pytest.raises(pr.TemplateError):
        st.classify(df, "C {{span_lines}}", "{{nope}}", setup(Chatty))


def test_condense(make):
    df = texts(make, ("r", "\n\n".join(f"Paragraph {i}" for i in range(1, 10))), ("e", " "))
    res = st.condense(df, "M{{paragraph_lines}}", "R{{candidate_blocks_json}}", setup(Condenser))
    assert {r.run_id: r.text for r in res.texts.collect()} == {"r": "Ships leave at dawn.\n\nWind from the west.\n\nAn island.\n", "e": ""}
    assert [tuple(r)[1:] for r in res.extra["blocks"].orderBy("from_p").collect()] == [
        (1, 3, "Harbour", "Ships leave at dawn."), (4, 9, "The long crossing", "Wind from the west.\n\nAn island.")]
    assert [r.phase for r in res.calls.orderBy("batch_id").collect()] == ["map", "map", "reduce"]


def test_condense_isolates_failures(make):
    df = texts(make, ("bad", "some text"), ("ok", "fine\n\nmore"))
    res = st.condense(df, "M{{paragraph_lines}}", "R{{candidate_blocks_json}}", setup(Broken))
    assert {r.run_id: r.text for r in res.texts.collect()} == {"ok": "fine more\n"}
    assert [(r.run_id, r.breach) for r in res.rejected.collect()] == [("bad", "invalid_json")]


@pytest.mark.parametrize("part_rows", [1 << 14, 5])
def test_report_numbers_every_sentence(make, part_rows):
    from lectern.operators import review as rv

    spans = make([("r", i, f"One <{i}>. Two & \"x\"'.", "REMOVE" if i % 2 else "KEEP", None, "why") for i in range(1, 21)],
                 "run_id STRING, span_id INT, text STRING, action STRING, label STRING, reason STRING")
    runs = make([("r",), ("none",)], "run_id STRING")
    parts = {}
    for r in rv.review_report(rv.sentence_table(spans), runs, part_rows=part_rows, slice_rows=part_rows).orderBy("part").collect():
        parts.setdefault(r.run_id, []).append(r.text)
    page = "\n".join(parts["r"])
    assert page.count("<td>why</td>") == 40 and "<td>40</td>" in page and "One &lt;7&gt;." in page
    assert "Two &amp; &quot;x&quot;&#x27;." in page and page.startswith("<!doctype html>") and page.endswith("</html>\n")
    assert (len(parts["r"]) > 1) == (part_rows == 5)
    assert "No sentences available" in "\n".join(parts["none"])


def test_long_pages_come_in_parts(make):
    from lectern.operators import review as rv

    spans = make([(r, i, f"One {i}. Two <x>.", "KEEP", None, "why") for r, n in (("long", 50), ("short", 3)) for i in range(n)],
                 "run_id STRING, span_id INT, text STRING, action STRING, label STRING, reason STRING")
    runs = make([("long",), ("short",), ("none",)], "run_id STRING")
    whole = {r.run_id: r.text for r in rv.review_report(rv.sentence_table(spans), runs).collect()}
    cut = rv.review_report(rv.sentence_table(spans), runs, page_bytes=5000, part_rows=7).orderBy("part").collect()
    assert rv.review_report(rv.sentence_table(spans), runs, page_bytes=10**6).count() == 3
    parts = {}
    for r in cut:
        parts.setdefault(r.run_id, []).append((r.part, r.text))
    assert {k: "\n".join(t for _, t in v) for k, v in parts.items()} == whole
    assert [p for p, _ in parts["long"]] == list(range(8)) and len(parts["none"]) == 1


def test_failed_call_stops_its_run_only(make):
    texts = make([("good", "one\n\ntwo"), ("bad", "boom\n\nfine"), ("none", "")], "run_id STRING, text STRING")
    out = st.text_transform(texts, "s07", "{{text}}", st.ModelSetup(Picky, "m"))
    assert {r.run_id: r.text for r in out.texts.collect()} == {"good": "ONE\n\nTWO\n", "none": ""}
    assert [(r.run_id, r.breach) for r in out.rejected.collect()] == [("bad", "ValueError: no answer")]
    assert {r.run_id for r in out.calls.collect()} == {"good"}


def test_long_text_survives_two_stages(make, monkeypatch):
    monkeypatch.setattr(ordered, "GATHER_ROWS", 3)
    text = "\n\n".join(f"piece {i}" for i in range(11))
    texts = make([("r", text)], "run_id STRING, text STRING")
    setup = st.ModelSetup(Picky, "m")
    one = st.text_transform(texts, "s07", "{{text}}", setup, max_chars=10).texts
    two = st.text_transform(one.select("run_id", "text"), "s09", "{{text}}", setup, max_chars=10).texts
    assert [r.text for r in two.collect()] == [text.upper() + "\n"]


def test_calls_beyond_the_limit_are_never_made(make, tmp_path):
    df = prompts(make, [("r", i, f"p{i}") for i in range(1, 8)] + [("s", 1, "q1"), ("s", 2, "q2")])
    for slice_rows in (1 << 18, 2):
        ready, over = ca.within_limit(df, 5, slice_rows=slice_rows)
        assert sorted((r.run_id, r.batch_id) for r in ready.collect()) == [*(("r", i) for i in range(1, 6)), ("s", 1), ("s", 2)]
        assert [tuple(r) for r in over.collect()] == [("r", "s08", "max_calls")]
    spent = make([("s", "s08", 4)], "run_id STRING, stage STRING, spent LONG")
    ready, over = ca.within_limit(df, 5, spent=spent)
    assert [r.batch_id for r in ready.filter("run_id = 's'").collect()] == [1]
    assert {r.run_id for r in over.collect()} == {"r", "s"}
    assert ca.within_limit(df.withColumn("provider", F.lit("local")), 1)[0].count() == 9


def test_stage_makes_as_many_calls_as_the_limit_allows(make, tmp_path):
    folder = str(tmp_path)
    df = texts(make, ("long", "\n\n".join(f"part {i} of it" for i in range(9))), ("short", "one part"))
    made = st.ModelSetup(lambda: Tallying(folder), "m", provider="openai", caps=ca.Caps(calls=4))
    res = st.text_transform(df, "s07", "{{text}}", made, max_chars=15)
    assert [(r.run_id, r.breach) for r in res.rejected.collect()] == [("long", "max_calls")]
    assert [r.run_id for r in res.texts.collect()] == ["short"]
    assert len(os.listdir(folder)) == 5


def test_repairs_count_towards_the_limit(make):
    df = texts(make, ("r", "Is this seat free?\n\nGlaciers carve valleys"), ("x", "hopeless"))
    res = st.classify(df, "C {{span_lines}}", "Fix {{original_prompt}} {{bad_response}}",
                      setup(Chatty, provider="openai", caps=ca.Caps(calls=3, tokens_in=10**6, tokens_out=10**6)))
    assert {r.run_id: r["count"] for r in res.calls.groupBy("run_id").count().collect()} == {"r": 2, "x": 3}
    assert ("x", "max_calls") in {(r.run_id, r.breach) for r in res.rejected.collect()}


def test_ledger_resumes_where_calls_were_broken_off(make, tmp_path):
    ledger, folder = f"{tmp_path}/ledger", str(tmp_path / "calls")
    os.mkdir(folder)
    df = prompts(make, [("r", i, f"p{i:03}") for i in range(60)]).drop("in_tok", "out_tok")
    ask = lambda make_model: ca.call_model(df, make_model, tasks=2, ledger=ledger, batch=5, in_flight=1)
    with pytest.raises(Exception, match="."):
        ask(lambda: Tallying(folder, last="p050"))
    stored = ca.ledger_replies(df.sparkSession, ledger).count()
    before = len(os.listdir(folder))
    got = {r.prompt: r.response for r in ask(lambda: Tallying(folder)).collect()}
    assert got == {f"p{i:03}": f"<p{i:03}>" for i in range(60)}
    assert len(os.listdir(folder)) - before == 60 - stored  # what the ledger holds was not called again
    assert ask(Never).count() == 60


def test_a_wave_reads_its_own_prompts_only(make, tmp_path, monkeypatch):
    written = []
    keep = ca.write_and_read
    monkeypatch.setattr(ca, "write_and_read", lambda df, name, *by: written.append((name, by)) or keep(df, name, *by))
    df = prompts(make, [("r", i, f"p{i:03}") for i in range(60)]).drop("in_tok", "out_tok")
    got = ca.call_model(df, Upper, tasks=2, ledger=f"{tmp_path}/ledger", batch=5)
    assert {r.prompt: r.response for r in got.collect()} == {f"p{i:03}": f"P{i:03}" for i in range(60)}
    assert ("unanswered", ("wave",)) in written and [n for n, _ in written].count("replies") == 1  # none per wave
    with pytest.raises(ca.ClientError, match="60 calls"):
        ca.call_model(df, Silent, tasks=2, ledger=f"{tmp_path}/silent", batch=30)


def test_workers_get_small_batches(spark):
    from lectern.catalog import QUERIES

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    QUERIES["m1_model_replies"](spark, "/root/testdata/sf0.001")
    long = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("x"), 20_000).alias("prompt"))
    sizes = long.mapInPandas(lambda batches: (b.iloc[:1].assign(prompt=str(len(b))) for b in batches), "prompt STRING")
    assert max(int(r.prompt) for r in sizes.collect()) < 200  # 2 MB of 40


def test_texts_are_not_stored_beside_their_prompts(make, monkeypatch):
    stored = {}
    keep = st.write_and_read
    monkeypatch.setattr(st, "write_and_read", lambda df, name, *by: stored.update({name: df.columns}) or keep(df, name, *by))
    res = st.text_transform(texts(make, ("r", "one")), "s07", "{{text}}", setup(Upper), with_edits=False)
    assert [r.text for r in res.texts.collect()] == ["ONE\n"] and "text" not in stored["prompts"] and "calls" not in stored


def test_first_prompts_are_stored_once(make, monkeypatch):
    rounds = []
    keep = ca.write_and_read
    monkeypatch.setattr(ca, "write_and_read", lambda df, name, *by: (name == "round" and rounds.append(keep(df, name, *by)) or None) or (rounds[-1] if name == "round" else keep(df, name, *by)))
    st.classify(texts(make, ("r", "Is this seat free?")), "C {{span_lines}}", "Fix {{original_prompt}} {{bad_response}}", setup(Chatty))
    assert rounds[0].filter("_original IS NOT NULL").isEmpty() and rounds[1].filter("_original IS NULL").isEmpty()


def test_calls_overlap(make):
    df = prompts(make, [("r", i, f"p{i}") for i in range(8)]).drop("in_tok", "out_tok")
    taken = []
    for in_flight in (1, 8):
        start = time.perf_counter()
        assert ca.call_model(df, Slow, tasks=1, in_flight=in_flight).count() == 8
        taken.append(time.perf_counter() - start)
    assert taken[0] - taken[1] > 2.5  # seven of eight half seconds


def test_copies_are_billed_once(make):
    df = prompts(make, [("r", i, f"p{i % 3}" * 8) for i in range(30)]).drop("in_tok", "out_tok")
    got = ca.call_model(df, Picky, hot_copies=5, salts=4)
    assert got.filter("called").count() == 3 and got.count() == 30
    costs = ca.running_costs(got)
    assert costs.agg(F.sum("in_tok")).first()[0] == 3 * 4


def test_broken_clients_end_the_stage(make):
    df = prompts(make, [("r", i, f"p{i}") for i in range(30)]).drop("in_tok", "out_tok")
    with pytest.raises(ca.ClientError, match="30 calls"):
        ca.call_model(df, Silent)
    few = ca.call_model(df.limit(3), Silent)
    assert few.filter("error IS NOT NULL AND response IS NULL").count() == 3


def test_lone_prompts_move_no_text(make, monkeypatch):
    kept = {}
    keep = ca.write_and_read
    monkeypatch.setattr(ca, "write_and_read", lambda df, name, *by: kept.update({name: keep(df, name, *by)}) or kept[name])
    df = prompts(make, [("r", i, f"p{max(i, 5)}") for i in range(30)]).drop("in_tok", "out_tok")
    got = ca.call_model(df, Upper, prompt_kept=False, in_place=True)
    assert sorted((r.batch_id, r.response, r.est_in) for r in got.collect()) == [(i, f"P{max(i, 5)}", 1) for i in range(30)]
    assert got.filter("called").count() == 25 and "prompt" not in got.columns
    assert kept["replies"].count() >= 20 and "prompt" not in kept["replies"].columns and {"run_id", "batch_id"} <= set(kept["replies"].columns)
    assert kept["shared-calls"].count() == 1 and kept["replies"].count() + kept["shared-replies"].count() <= 25
    lone = ca.call_model(df.filter("batch_id > 5"), Upper)
    assert "Exchange" not in lone._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.prompt for r in lone.collect()) == sorted(f"p{i}" for i in range(6, 30))


def test_condense_stores_no_prompt_twice(make, monkeypatch):
    stored = {}
    keep = st.write_and_read
    monkeypatch.setattr(st, "write_and_read", lambda df, name, *by: stored.update({name: df.columns}) or keep(df, name, *by))
    df = texts(make, ("r", "\n\n".join(f"Paragraph {i}" for i in range(1, 10))), ("e", " "))
    res = st.condense(df, "M{{paragraph_lines}}", "R{{candidate_blocks_json}}", setup(Condenser))
    assert "prompt" not in stored["mapped"] and "prompt" not in stored["reduced"]
    log = res.calls.orderBy("batch_id").collect()
    assert [len(r.prompt_hash) for r in log] == [64] * 3 and all(r.output_chars > 0 for r in log)


def test_rows_told_apart_by_bits(spark, monkeypatch):
    monkeypatch.setattr(ordered, "PICKS", 256)
    rows = spark.range(1000).withColumn("x", F.lit("text"))
    near, far = ordered.maybe_among(rows, spark.range(0, 40), ["id"])
    assert {r.id for r in near.collect()} >= set(range(40)) and near.count() + far.count() == 1000 and far.count() > 500
