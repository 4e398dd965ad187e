"""Stages that are run again do only what changed."""

import pytest

from fakes import Never, Refusing, Upper
from lectern.plans import run as rn, stages as st
from lectern.sources import sinks

SCHEMA = "run_id STRING, text STRING"


def run_stage(*args, **kw):
    return rn.run_stage(*args, buckets=2, **kw)


def run_steps(*args):
    return rn.run_steps(*args, buckets=2)


def step(model=Upper, template="say:{{text}}", stage="s07", **kw):
    setup = st.ModelSetup(model, "m", **kw)
    return rn.Step(stage, lambda t: st.text_transform(t, stage, template, setup), rn.model_params(setup, template))


def statuses(done):
    return {r.run_id: r.status for r in done.manifests.collect()}


def texts_of(spark, folder, stage="s07"):
    return {r.run_id: r.text for r in rn.stored_texts(spark, folder, stage).collect()}


def test_second_pass_does_nothing(spark, make, tmp_path):
    texts, folder = make([("a", "one"), ("b", "two"), ("c", None), ("d", "")], SCHEMA), str(tmp_path / "f")
    first = run_stage(texts, step(), folder)
    assert set(statuses(first).values()) == {"success"} and first.calls.count() == 2
    kept = texts_of(spark, folder)
    assert kept == {"a": "SAY:ONE\n", "b": "SAY:TWO\n", "c": "", "d": ""}
    again = run_stage(texts, step(Never), folder)
    assert set(statuses(again).values()) == {"skipped"} and again.calls is None
    # a skipped pass does not hide the success before it
    assert set(statuses(run_stage(texts, step(Never), folder)).values()) == {"skipped"}
    assert texts_of(spark, folder) == kept


def test_changed_text_template_and_force(spark, make, tmp_path):
    folder = str(tmp_path / "f")
    run_stage(make([("a", "one"), ("b", "two")], SCHEMA), step(), folder)
    revised = make([("a", "one"), ("b", "new"), ("c", "three")], SCHEMA)
    second = run_stage(revised, step(), folder)
    assert statuses(second) == {"a": "skipped", "b": "success", "c": "success"}
    assert {r.run_id for r in second.calls.collect()} == {"b", "c"}
    assert texts_of(spark, folder) == {"a": "SAY:ONE\n", "b": "SAY:NEW\n", "c": "SAY:THREE\n"}
    assert set(statuses(run_stage(revised, step(template="ask:{{text}}"), folder)).values()) == {"success"}
    assert texts_of(spark, folder)["a"] == "ASK:ONE\n"
    assert set(statuses(run_stage(revised, step(template="ask:{{text}}"), folder, force=True)).values()) == {"success"}


def test_existing_outputs_and_dry_run(spark, make, tmp_path):
    folder = str(tmp_path / "f")
    texts = make([("a", "one")], SCHEMA)
    dry = run_stage(texts, step(Never), folder, dry_run=True)
    assert statuses(dry) == {"a": "dry_run"} and rn.stored_texts(spark, folder, "s07") is None
    assert statuses(run_stage(texts, step(), folder)) == {"a": "success"}
    changed = make([("a", "other"), ("b", "two")], SCHEMA)
    with pytest.raises(sinks.ExistingOutputError):
        run_stage(changed, step(Never), folder, on_exists="fail")
    assert statuses(run_stage(changed, step(), folder, on_exists="skip")) == {"a": "skipped", "b": "success"}
    assert texts_of(spark, folder) == {"a": "SAY:ONE\n", "b": "SAY:TWO\n"}
    # unchanged work is skipped before the policy is asked
    assert statuses(run_stage(texts, step(Never), folder, on_exists="fail")) == {"a": "skipped"}
    with pytest.raises(ValueError):
        run_stage(make([(None, "x")], SCHEMA), step(), folder)


def test_steps_stop_where_a_run_fails(spark, make, tmp_path):
    folder = str(tmp_path / "f")
    texts = make([("a", "good"), ("b", "bad")], SCHEMA)
    steps = [step(Refusing), step(Upper, "then:{{text}}", "s09")]
    one, two = run_steps(texts, steps, folder)
    assert statuses(one) == {"a": "success", "b": "failed"} and statuses(two) == {"a": "success"}
    assert {r.run_id: r.error is not None for r in one.manifests.collect()} == {"a": False, "b": True}
    assert texts_of(spark, folder, "s09") == {"a": "THEN:SAY:GOOD\n"}
    # the failed run is tried again, the other is not
    one, two = run_steps(texts, steps, folder)
    assert statuses(one) == {"a": "skipped", "b": "failed"} and statuses(two) == {"a": "skipped"}
    mended = make([("a", "good"), ("b", "fine")], SCHEMA)
    one, two = run_steps(mended, steps, folder)
    assert statuses(one) == {"a": "skipped", "b": "success"} and statuses(two) == {"a": "skipped", "b": "success"}


def test_no_runs(spark, make, tmp_path):
    done = run_stage(make([], SCHEMA), step(Never), str(tmp_path / "f"))
    assert statuses(done) == {} and done.calls is None
