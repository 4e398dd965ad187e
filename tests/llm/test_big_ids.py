"""Ids beyond 2^53 beside a null keep their value in every operator and stage."""

import time

import numpy as np
import pytest

import corpus_pipeline
from lectern.llm import decontam, langid, minhash, pii, quality, sigtree

BIG = 1 << 60
IDS = [BIG + 1, BIG + 2, BIG + 3, BIG + 7, None]


@pytest.fixture(scope="module")
def big(spark):
    rows = [(i, f"text number {k} of its own, which says {k * 7} and mail{k}@example.org", "en", "a", BIG + k, BIG + 2 * k + 1 if k else None) for k, i in enumerate(IDS)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, other bigint").repartition(1).cache()


def ids(found, column="doc_id"):
    return sorted((r[column] for r in found.collect()), key=repr)


@pytest.mark.parametrize("find", [
    pii.detect, langid.identify, quality.assess, sigtree.link, minhash.link,
    lambda d: decontam.contamination(d, d.selectExpr("1 item_id", "'no such words' text").limit(1)),
])
def test_operators_keep_ids(big, find):
    assert ids(find(big)) == sorted(IDS, key=repr)


@pytest.mark.parametrize("link", [sigtree.link, minhash.link])
def test_links_tell_ids_apart(big, link):
    assert all(r.component_id == r.doc_id for r in link(big).collect())


def test_stages_keep_every_column(spark, big, tmp_path):
    spark.createDataFrame([(1, "no such words")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, big, str(tmp_path)).collect()
        given = {tuple(r) for r in big.collect()}
        assert {tuple(r) for r in kept} <= given, name
        assert len(kept) == 5 or name == "quality rules", name


def test_added_spans_are_merged_in_linear_time():
    field = pii.train()
    rng = np.random.default_rng(8)
    entry = lambda n: f"jo{n}@example.org call (21{n % 10}) 555-{n % 10000:04} token = {''.join(rng.choice(list('0123456789abcdef'), 40))} then"
    lines = [entry(int(n)) for n in rng.integers(10, 99_999, 6000)]
    taken = []
    for share in (1500, 6000):
        start = time.perf_counter()
        base, every = pii.find(["\n".join(lines[:share])], field)[0]
        taken.append(time.perf_counter() - start)
        assert len(base) >= share and len(every) > len(base)
        assert all(x[1] <= y[0] for x, y in zip(sorted(every), sorted(every)[1:]))
    assert taken[1] < 8 * taken[0]  # four times the text; with all pairs compared it took sixteen times
