import re

import numpy as np
import pytest

import corpus_pipeline
from lectern.llm import cells, sigtree
from lectern.llm.words import as_bytes


def shingles(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_components(rows, percent=80):
    """(doc_id, n, component) of every row by all pairs; rows of one doc_id are one document."""
    sets = [shingles(t) for _, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, _) in enumerate(rows):
        for y in range(x):
            j = rows[y][0]
            if i is not None and j is not None and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return sorted(str((i, len(s), None if i is None else top(i))) for (i, _), s in zip(rows, sets))


def corpus(seed=11):
    """Bases of several lengths, chains of copies with more and more words changed, shared passages."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    passage = list(rng.choice(vocabulary, 60))
    rows, doc = [], 100
    for n in (1, 3, 5, 6, 12, 40, 41, 90, 300, 700):
        base = list(rng.choice(vocabulary, n))
        for k in range(9):
            text = list(base)
            for at in rng.integers(0, n, k * n // 70):
                text[at] = f"x{rng.integers(1 << 30)}"
            if k == 8:
                text += passage
            rows.append((doc, " ".join(text).replace("v1", "V1")))
            doc += 1
    for k in range(60):  # one passage in many, one chain of near copies of near copies
        rows.append((doc + k, " ".join([*rng.choice(vocabulary, 30), *passage])))
    return rows


def test_links_equal_all_pairs(spark, docs, monkeypatch):
    monkeypatch.setattr(cells, "CELL", 7)
    rows = corpus() + [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(2**60 + k, " ".join(f"big{k}w{i}" for i in range(9))) for k in (1, 2, 3, 7)]
    table = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id bigint, text string, token string, n int").repartition(3)
    got = sigtree.link(table).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == plain_components(rows)


def halves_and_wholes(seed, groups=12):
    """Texts whose shingles are all in longer texts of smaller doc_id, which link with none: sizes from 1 to 1 / 2."""
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        whole = [f"g{g}w{i}" for i in rng.permutation(240)]
        rows += [(10 * g + k, " ".join(whole + [f"g{g}k{k}o{i}" for i in range(700)])) for k in (0, 1)]
        rows += [(10 * g + k, " ".join(whole[: 240 * part // 100])) for k, part in ((2, 100), (3, 53), (4, 73))]
    return rows


@pytest.mark.parametrize("percent", [50, 70, 100])
def test_links_equal_all_pairs_at_any_percent(spark, percent):
    rows = corpus() + [(i + 1000, t) for i, t in halves_and_wholes(3)]
    got = sigtree.link(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), percent=percent).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == plain_components(rows, percent)


def test_no_rows(no_docs):
    assert sigtree.link(no_docs).count() == 0


@pytest.mark.parametrize("size", [500, 9, 2])
def test_trees_lose_no_pair(size):
    """Cells of all, of nine and of two texts: every link of two components is left, most pairs of nodes are pruned."""
    rows = corpus(12)
    sets = sigtree.shingle_sets(as_bytes([t for _, t in rows]))
    number, n = np.arange(len(rows)) // size, np.array([len(s) for s in sets])
    roots = np.arange(len(rows)) // 2 * 2
    want = {(y, x) for x in range(len(rows)) for y in range(x) if number[x] == number[y] and roots[x] != roots[y]
            and sigtree.linked(len(np.intersect1d(sets[x], sets[y])), n[x], n[y], 80)}
    a, b, looked = sigtree.tree_pairs(number, n, [sigtree.bitmap(s) for s in sets], roots, 80)
    pairs = {(min(p), max(p)) for p in zip(a.tolist(), b.tolist())}
    assert want <= pairs and len(pairs) == len(a) and all(number[x] == number[y] and roots[x] != roots[y] for x, y in pairs)
    if size == 500:
        every = len(rows) * (len(rows) - 1) / 2
        assert len(want) > 100 and looked < every / 2 and len(pairs) < every / 8


def test_a_short_text_does_not_blur_long_ones():
    """One cell holds a short text, unlike long ones, and linked pairs on both sides of a bitmap's width."""
    rng = np.random.default_rng(5)
    fresh = lambda n: rng.integers(0, 1 << 63, n).astype(np.uint64)
    sets = [fresh(40)] + [fresh(3000 + 20 * i) for i in range(40)]
    linked = []
    for n, m in ((60, 70), (250, 260), (1000, 1200), (4090, 4900)):  # widths 64, 256, 1024 and 4096, and twice that
        sets += [fresh(m)]
        sets += [sets[-1][:n]]
        linked.append((len(sets) - 2, len(sets) - 1))
    sets = [np.unique(x) for x in sets]
    a, b, _ = sigtree.tree_pairs(np.zeros(len(sets), np.int64), np.array([len(x) for x in sets]), [sigtree.bitmap(x) for x in sets], np.arange(len(sets)), 80)
    pairs = [(min(p), max(p)) for p in zip(a.tolist(), b.tolist())]
    assert set(linked) <= set(pairs) and len(pairs) == len(set(pairs)) and len(pairs) <= len(linked) + 2


def test_second_turn_finds_all_links(spark, monkeypatch):
    """Without the first turn every link is found by the trees."""
    monkeypatch.setattr(sigtree, "best_leads", lambda met: met.select("doc_id", "lead").limit(0))
    rows = corpus(13)
    got = sigtree.link(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == plain_components(rows)


def test_pipeline_stages_on_edge_rows(spark, docs, tmp_path):
    bench = tmp_path / "benchmark.parquet"
    spark.createDataFrame([(1, "says little it ends")], "item_id bigint, text string").write.parquet(str(bench))
    (name, good), (_, first), (_, clean), (_, mix), (_, shard) = corpus_pipeline.STAGES
    sf = str(tmp_path)
    kept = good(spark, docs, sf)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} <= {0, 3, 4, 8, 10, None}
    uncopied = first(spark, docs, sf)
    left = sorted(str(r.doc_id) for r in uncopied.collect())
    assert uncopied.columns == docs.columns and left == sorted(["0", "1", "2", "3", "None", "7", "8", "9", "10"])
    cleaned = clean(spark, docs, sf)
    assert cleaned.columns == docs.columns and {r.doc_id for r in docs.collect()} - {r.doc_id for r in cleaned.collect()} == {0, 4}
    assert mix(spark, docs, sf).columns == docs.columns
    assert shard(spark, docs, sf).count() == docs.count()
