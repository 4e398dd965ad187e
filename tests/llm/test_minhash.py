import numpy as np
import pytest
from test_sigtree_pipeline import corpus, halves_and_wholes, plain_components, shingles

from lectern.llm import cells, minhash
from lectern.llm.words import as_bytes

BIG = 1 << 60


def strings(found):
    return sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in found)


@pytest.mark.parametrize("cell", [7, 512])
def test_components_equal_all_pairs(spark, docs, monkeypatch, cell):
    monkeypatch.setattr(cells, "CELL", cell)
    rows = corpus() + [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(BIG + 1, "a b c d e f g h"), (BIG + 2, "zz"), (BIG + 3, "a b c d e f g h"), (BIG + 7, ""), (6, "zz"), (6, "A b c d e f g h")]
    table = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id bigint, text string, n int, sig string").repartition(3)
    got = minhash.link(table).collect()
    assert strings(got) == plain_components(rows, 85)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_other_threshold(spark):
    rows = corpus(5) + [(i + 1000, t) for i, t in halves_and_wholes(3)]
    got = minhash.link(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), percent=70, bands=64).collect()
    assert strings(got) == plain_components(rows, 70)


def test_second_turn_finds_what_the_leads_miss(spark, monkeypatch):
    """Without the first turn's links all come from the compared signatures."""
    monkeypatch.setattr(minhash, "likely_stars", lambda members, *_: members.select("lead", "doc_id", "n").limit(0))
    rows = corpus(7)
    got = minhash.link(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert strings(got) == plain_components(rows, 85)


def test_sets_and_minima():
    texts = [None, "", "a B c", "a b c d e f a b c d e f", "x " * 400, "p q r s t u"]
    keys, bounds = cells.shingles(as_bytes(texts), 5)
    assert np.diff(bounds).tolist() == [len(shingles(t)) for t in texts]
    low = minhash.minima(keys, bounds, 128)
    assert low.shape == (4, 128) and (low < 1 << 32).all()
    one = minhash.minima(*cells.shingles([b"p q r s t u"], 5), 128)
    assert np.array_equal(one[0], low[3])


def test_links_within_equal_sets():
    texts = [t for _, t in corpus(3)]
    keys, bounds = cells.shingles(as_bytes(texts), 5)
    a, b = cells.links_within(keys, bounds, 85)
    sets = [shingles(t) for t in texts]
    linked = lambda x, y: 100 * len(x & y) >= 85 * len(x | y)
    assert all(linked(sets[i], sets[j]) for i, j in zip(a, b))
    want = plain_components(list(enumerate(texts)), 85)
    assert len(texts) - len(a) == len({w.rsplit(", ", 1)[1] for w in want})


def test_contraction_of_a_long_chain(spark):
    links = spark.range(300).selectExpr("id * 11 % 301 a", "(id + 1) * 11 % 301 b").union(spark.range(400, 440).selectExpr("id a", "400L b"))
    got = {r.node: r.root for r in minhash.contracted(links).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, **{i: 400 for i in range(401, 440)}}


def test_no_rows_and_first_rows(spark, docs, no_docs):
    assert minhash.link(no_docs).count() == 0
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["0", "1", "2", "3", "None", "7", "8", "9", "10"])
