"""Signatures, skipping, source choice, stable ids, existing-output policy."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lectern.operators import incremental as inc
from lectern.sources import sinks

MANIFEST = "run_id STRING, stage STRING, status STRING, finished_at STRING, params MAP<STRING,STRING>, inputs_signature STRING"


def manifest(status, at, params=None, signature="sig", stage="s05"):
    return ("r", stage, status, at, params or {"model": "m", "x": "1"}, signature)


def selected(make, manifests, params=None, signature="sig", **kw):
    cand = make([("r", "s05", params or {"x": "1", "model": "m"}, signature)],
                "run_id STRING, stage STRING, params MAP<STRING,STRING>, inputs_signature STRING")
    return inc.select_work(cand, make(manifests, MANIFEST), **kw).count()


def test_unchanged_work_is_skipped(make):
    done = [manifest("success", "1")]
    assert selected(make, done) == 0
    assert selected(make, done, force=True) == 1
    assert selected(make, done, params={"model": "other", "x": "1"}) == 1
    assert selected(make, done, signature="new") == 1
    assert selected(make, []) == 1
    assert selected(make, [manifest("success", "1"), manifest("failed", "2")]) == 1
    # A skipped or dry run leaves the success in force.
    assert selected(make, [manifest("success", "1"), manifest("skipped", "2"), manifest("dry_run", "3")]) == 0


def test_input_signature(make):
    expected = make([("r", "s05", "/b"), ("r", "s05", "/a")], "run_id STRING, stage STRING, path STRING")
    found = inc.artifacts(make([("/a", "x")], "path STRING, content STRING"))
    row = inc.input_signatures(expected, found).head()
    sha = "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881"
    assert row.inputs_signature == f"/a:{sha}\n/b:<missing>"
    assert found.head().bytes == 1
    many = make([("r", "s05", f"/{i}") for i in range(50)], "run_id STRING, stage STRING, path STRING")
    bulk = [inc.input_signatures(e, found).head().inputs_signature for e in (many, many.orderBy(F.rand()), many.filter("path <> '/7'"))]
    assert bulk[0] == bulk[1] != bulk[2] and bulk[0].count("\n") == 49


def test_input_signature_is_gathered_in_pieces(make, monkeypatch):
    monkeypatch.setattr(inc.ordered, "GATHER_ROWS", 7)
    rows = [(r, s, f"/{i}") for i in range(50) for r, s in (("r", "s05"), ("r", "s06"), (None, "s05"))]
    expected = make(rows, "run_id STRING, stage STRING, path STRING").repartition(5)
    found = inc.artifacts(make([("/7", "x")], "path STRING, content STRING"))
    sha = "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881"
    want = "\n".join(f"{p}:{sha if p == '/7' else '<missing>'}" for p in sorted(f"/{i}" for i in range(50)))
    got = {(r.run_id, r.stage): r.inputs_signature for r in inc.input_signatures(expected, found).collect()}
    assert got == dict.fromkeys([("r", "s05"), ("r", "s06"), (None, "s05")], want)
    pieces = inc.line_pieces(expected.withColumn("line", F.col("path")), ["run_id", "stage"]).collect()
    assert len(pieces) > 20 and max(p._text.count("\n") + 1 for p in pieces) <= 7


def test_best_output_keeps_all_rows_of_the_chosen_stage(make):
    texts = make([("r", "s07", 0, "a"), ("r", "s09", 0, "b"), ("r", "s09", 1, "c"), ("q", "s05", 0, "d")], "run_id STRING, stage STRING, part INT, text STRING")
    assert sorted(r.text for r in inc.best_output(texts).collect()) == ["b", "c"]


def test_suffixes_of_any_length_are_taken(make):
    old = {"/in/a/x.wav": "x", "/in/b/x.wav": "x-2", "/in/c/x.wav": "x-30000000000"}
    assert ids(make, [*old, "/in/d/x.wav"], old)["/in/d/x.wav"] == "x-3"


def test_fresh_source(make):
    edited = make([(r, "edited", "now") for r in "abcd"], "run_id STRING, text STRING, signature STRING")
    condensed = make([(r, "short") for r in "acd"], "run_id STRING, text STRING")
    rows = [(r, "s08", st, str(i), {}, sig) for i, (r, st, sig) in enumerate([
        ("a", "success", "now"), ("b", "success", "now"), ("c", "success", "then"), ("d", "success", "now"), ("d", "failed", "now"), ("a", "skipped", "now")])]
    got = {r.run_id: (r.text, r.input_source_stage) for r in inc.fresh_source(edited, condensed, make(rows, MANIFEST)).collect()}
    assert got == {"a": ("short", "s08"), "b": ("edited", "s07"), "c": ("edited", "s07"), "d": ("edited", "s07")}


def loop_ids(paths, mapping, taken):
    used, out = set(taken) | set(mapping.values()), {}
    for p in sorted(paths):
        name = mapping.get(p)
        if name is None:
            stem = p.rsplit("/", 1)[-1]
            stem = stem[:stem.rindex(".")] if stem.rfind(".") > 0 else stem
            base = re.sub("[^A-Za-z0-9._-]+", "-", stem).strip("._-").lower() or "audio"
            name, k = base, 2
            while name in used:
                name, k = f"{base}-{k}", k + 1
        used.add(name)
        out[p] = name
    return out


def ids(make, paths, mapping, taken=(), **kw):
    df = inc.assign_run_ids(
        make([(p,) for p in paths], "path STRING"), make(list(mapping.items()), "path STRING, run_id STRING"),
        make([(t,) for t in taken], "name STRING"), **kw)
    return {r.path: r.run_id for r in df.collect()}


def test_id_literals(make):
    assert ids(make, ["/in/lecture.wav", "/in/nested/lecture.MP3"], {}) == {
        "/in/lecture.wav": "lecture", "/in/nested/lecture.MP3": "lecture-2"}
    old = {"/in/a/alpha.wav": "alpha", "/in/b/alpha.wav": "alpha-2"}
    assert ids(make, [*old, "/in/0/alpha.wav"], old) == {**old, "/in/0/alpha.wav": "alpha-3"}


@pytest.mark.parametrize("seed", range(6))
def test_ids_equal_loop(make, seed):
    rng = random.Random(seed)
    stems = ["a", "A", "a-2", "a-3", "a-2-2", "b", "b-2", "é", "..", "a-02", "b-4", ".hidden", "x.y"]
    paths = sorted({f"/in/{rng.choice('pqrstuv')}{rng.randint(0, 9)}/{rng.choice(stems)}.wav" for _ in range(40)})
    mapping = {p: f"m{i}" for i, p in enumerate(rng.sample(paths, 2))}
    if seed % 2:
        mapping[paths[0]] = "a-3"
    taken = [t for t in rng.sample(["a", "a-2", "b", "b-3", "a-5", "audio", "a-2-2"], 3) if t not in mapping.values()]
    assert ids(make, paths, mapping, taken, slice_rows=3 if seed % 2 else 1 << 18) == loop_ids(paths, mapping, taken)


def test_mapping_problems(make):
    rows = [("p1", "ok"), ("p2", "dup"), ("p3", "dup"), ("p4", ".."), ("p5", "a/b"), ("p6", ""), ("p7", "a\\b")]
    got = {(r.run_id, r.problem) for r in inc.mapping_problems(make(rows, "path STRING, run_id STRING")).collect()}
    assert got == {("dup", "duplicate assignment"), ("..", "invalid name"), ("a/b", "invalid name"), ("", "invalid name"), ("a\\b", "invalid name")}
    with pytest.raises(inc.MappingError):
        inc.check_mapping(make(rows, "path STRING, run_id STRING"))


def test_existing_output_policy(spark, make, tmp_path):
    path = str(tmp_path / "texts")
    schema = "run_id STRING, stage STRING, text STRING"

    def state():
        return {(r.run_id, r.text) for r in spark.read.parquet(path).collect()}

    sinks.save_runs(make([("a", "s05", "1"), ("b", "s05", "1")], schema), path, "fail", buckets=2)
    more = make([("b", "s05", "2"), ("c", "s05", "2")], schema)
    with pytest.raises(sinks.ExistingOutputError):
        sinks.save_runs(more, path, "fail", buckets=2)
    assert sinks.save_runs(more, path, "skip", buckets=2).count() == 1
    assert state() == {("a", "1"), ("b", "1"), ("c", "2")}
    sinks.save_runs(make([("b", "s05", "3"), ("d", "s05", "3")], schema), path, "overwrite", buckets=2)
    assert state() == {("a", "1"), ("b", "3"), ("c", "2"), ("d", "3")}


@pytest.mark.parametrize("picks,slots", [(1 << 24, 8), (64, 8), (64, 0)])
def test_overwrite_keeps_all_other_rows(spark, make, tmp_path, monkeypatch, picks, slots):
    from lectern.operators import ordered

    path, schema = str(tmp_path / "texts"), "run_id STRING, stage STRING, text STRING"
    monkeypatch.setattr(ordered, "PICKS", picks)  # few numbers: most other rows may be among the new ones
    stored = []
    keep = sinks.write_and_read
    monkeypatch.setattr(sinks, "write_and_read", lambda df, name, *by: stored.append((name, df.columns)) or keep(df, name, *by))
    sinks.save_runs(make([(f"r{i}", st, "old") for i in range(200) for st in ("s05", "s06")], schema), path, "fail", buckets=2)
    monkeypatch.setattr(sinks, "SLOTS", max(slots, 1))
    if not slots:
        monkeypatch.setattr(sinks, "_scattered", lambda table: True)
    rows = [(f"r{i}", "s05", "new") for i in range(0, 210, 3)]
    made = sinks.save_runs(make(rows, schema), path, "overwrite", buckets=2)
    want = {(f"r{i}", st): "old" for i in range(200) for st in ("s05", "s06")} | {(r, st): t for r, st, t in rows}
    got = spark.read.parquet(path).collect()
    assert {(r.run_id, r.stage): r.text for r in got} == want and len(got) == len(want)
    assert sorted(tuple(r) for r in made.select("run_id", "stage", "text").collect()) == sorted(rows)
    # old texts are stored at their place only
    assert all("text" not in cols for name, cols in stored if name != "staged") and "merged" not in dict(stored)


def test_first_outputs_are_stored_once(spark, make, tmp_path, monkeypatch):
    stored = []
    monkeypatch.setattr(sinks, "write_and_read", lambda df, name, *by: stored.append(name))
    path = str(tmp_path / "texts")
    made = sinks.save_runs(make([("a", "s05", "1")], "run_id STRING, stage STRING, text STRING"), path, "overwrite", buckets=2, stage_first=False)
    assert [tuple(r) for r in made.collect()] == [("a", "s05", "1")] and not stored


def test_best_output(make):
    df = make([("a", "s07", "x"), ("a", "s09", "y"), ("b", "s07", "z"), ("c", "s05", "n")], "run_id STRING, stage STRING, text STRING")
    assert {r.run_id: r.text for r in inc.best_output(df).collect()} == {"a": "y", "b": "z"}


def test_many_suffixes_of_one_base(make):
    paths = ["/in/img.wav", *(f"/in/img-{k}.wav" for k in range(2, 3000))]
    got = ids(make, paths, {})
    assert all(got[p] == p[4:-4] for p in paths)
