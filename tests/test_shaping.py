"""Splitting, packing, batching and reassembly against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from lectern.functions import folds, text as tx
from lectern.operators import ordered, shaping as sh


def chunks(make, text, cap, **kw):
    df = make([("r", text)], "run_id STRING, text STRING")
    return [r.text for r in sh.text_chunks(df, ["run_id"], cap, **kw).orderBy("chunk_id").collect()]


def test_chunk_literals(make):
    assert chunks(make, "A\n\nB paragraph\n\nC longer paragraph", 12) == ["A", "B paragraph", "C longer", "paragraph"]
    assert all(len(c) <= 50 for c in chunks(make, ("word " * 80).strip(), 50))
    assert chunks(make, "   \n\n\t", 10) == []
    assert chunks(make, "First paragraph text.\n\nSecond paragraph text.", 30) == ["First paragraph text.", "Second paragraph text."]
    with pytest.raises(ValueError):
        folds.chunk_text(F.col("x"), 0)


def loop_wrap(p, cap):
    out, held = [], ""
    for w in p.split():
        if held and len(held) + 1 + len(w) <= cap:
            held += " " + w
        else:
            if held:
                out.append(held)
            held = w if len(w) <= cap else ""
            if len(w) > cap:
                out += [w[i:i + cap] for i in range(0, len(w), cap)]
    return out + [held] if held else out


def loop_chunks(text, cap):
    pieces = []
    for p in (x.strip() for x in text.split("\n\n")):
        if p:
            pieces += [p] if len(p) <= cap else loop_wrap(p, cap)
    out = []
    for p in pieces:
        if out and len(out[-1]) + 2 + len(p) <= cap:
            out[-1] += "\n\n" + p
        else:
            out.append(p)
    return out


def test_chunks_equal_loop(make):
    rng = random.Random(1)
    texts = []
    for i in range(150):
        paras = [" ".join("é" * rng.choice([1, 3, 9, 30]) for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 8))]
        texts.append((i, rng.choice(["\n\n", "\n\n\n", " \n\n\t"]).join(paras)))
    df = make(texts, "run_id INT, text STRING")
    for cap in (7, 25):
        got = {}
        for r in sh.text_chunks(df, ["run_id"], cap).orderBy("run_id", "chunk_id").collect():
            got.setdefault(r.run_id, []).append(r.text)
        assert got == {i: loop_chunks(t, cap) for i, t in texts if loop_chunks(t, cap)}


def loop_batches(items, size, cap):
    out, n, c, b = [], 0, 0, 0
    for i, t in items:
        z = len(f"[{i}] {t}") + 1
        if n >= size or (n and c + z > cap):
            n = c = 0
        b += n == 0
        n, c = n + 1, c + z
        out.append((i, b))
    return out


@pytest.mark.parametrize("slice_rows", [1 << 13, 6, 16])
def test_batches_equal_loop(make, slice_rows):
    rng = random.Random(2)
    runs = {r: [(i, "x" * rng.choice([1, 20, 60, 200])) for i in range(1, rng.randint(2, 150))] for r in range(30)}
    df = make([(r, i, t) for r, items in runs.items() for i, t in items], "run_id INT, span_id INT, text STRING")
    got = {}
    for r in sh.span_batches(df, max_size=5, max_chars=150, slice_rows=slice_rows).collect():
        got.setdefault(r.run_id, []).append((r.span_id, r.batch_id))
    assert {r: sorted(v) for r, v in got.items()} == {r: loop_batches(items, 5, 150) for r, items in runs.items()}


def test_120_paragraphs_make_three_batches(make):
    df = make([("r", "\n\n".join(f"Lecture segment {i}" for i in range(120)))], "run_id STRING, text STRING")
    assert sh.span_batches(sh.spans(df, ["run_id"])).select("batch_id").distinct().count() == 3


def loop_windows(n, size, overlap):
    out, start = [], 0
    while start < n:
        end = min(n, start + size)
        out.append((start + 1, end))
        if end >= n:
            break
        start += size - overlap
    return out


@pytest.mark.parametrize("size,overlap", [(8, 1), (5, 3), (4, 0), (3, 7)])
def test_windows_equal_loop(make, size, overlap):
    df = make([(n, i, "t") for n in range(40) for i in range(1, n + 1)], "run_id INT, span_id INT, text STRING")
    got = {}
    for r in sh.windows(df, size=size, overlap=overlap).orderBy("run_id", "batch_id").collect():
        got.setdefault(r.run_id, []).append((r.start_paragraph, r.end_paragraph))
    assert got == {n: loop_windows(n, size, min(overlap, size - 1)) for n in range(1, 40)}


@pytest.mark.parametrize("part_rows, gather", [(None, 1 << 14), (None, 4), (4, 1 << 14)])
def test_reassembly_equals_join(make, monkeypatch, part_rows, gather):
    monkeypatch.setattr(ordered, "GATHER_ROWS", gather)
    rng = random.Random(3)
    rows = [(r, i, rng.choice(["", " ", "x\n", "y", "  z "])) for r in range(15) for i in range(rng.randint(1, 30))]
    want = {r: "\n\n".join(t for q, _, t in rows if q == r).strip() for r in range(15)}
    want = {r: t + "\n" if t else "" for r, t in want.items()} | {99: ""}
    df = make(rows, "run_id INT, chunk_id INT, text STRING")
    runs = make([(r,) for r in want], "run_id INT")
    got = {}
    for r in sh.reassemble(df, ["run_id"], part_rows=part_rows, runs=runs).orderBy("run_id", "part").collect():
        got.setdefault(r.run_id, []).append(r.text)
    assert {r: "\n\n".join(parts) for r, parts in got.items()} == want
    assert (max(map(len, got.values())) > 1) == (part_rows == 4)


@pytest.mark.parametrize("slice_rows", [1 << 18, 16])
def test_clamped_level_equals_loop(make, slice_rows):
    rng = random.Random(4)
    events = [(rng.choice("ab"), q, rng.choice([-1, -1, 0, 1, 1])) for q in range(1, 400)]
    level, want = {"a": 0, "b": 0}, []
    for k, q, d in events:
        level[k] = max(0, level[k] + d)
        want.append((q, level[k]))
    df = make(events, "k STRING, seq LONG, d INT")
    got = ordered.clamped_level(df, ["k"], "seq", "d", "g", slice_rows=slice_rows)
    assert sorted((r.seq, r.g) for r in got.collect()) == want


def test_global_numbers(make):
    df = make([(i * 7 % 501,) for i in range(501)], "x INT")
    assert all(r.n == r.x + 1 for r in ordered.number_all(df, ["x"], "n").collect())


def test_sentences_and_whitespace(make):
    df = make([(" One. Two! Three? four.five\r\n",)], "text STRING")
    got = [r.sentence for r in sh.sentences(df, []).collect()]
    assert got == ["One.", "Two!", "Three?", "four.five"]
    blank = make([(w,) for w in tx.WHITESPACE] + [("x",)], "t STRING")
    assert blank.filter(tx.is_blank(F.col("t"))).count() == len(tx.WHITESPACE)
    assert all(w.isspace() for w in tx.WHITESPACE)


def test_block_headings(make):
    text = "## Block 01: Intro\nA.\n\n## Block 02: Middle\nB.\n\nC."
    df = make([(text, "f"), ("  ## Block 3 : x", " f "), ("", None)], "t STRING, f STRING")
    got = [r[0] for r in df.select(sh.final_condensed(F.col("t"), F.col("f"))).collect()]
    assert got == ["A.\n\nB.\n\nC.", "f", ""]
