import zlib
from collections import defaultdict

import numpy as np
import pytest

from lectern.llm import mixing, sharding


def plain_jump(key: int, shards: int) -> int:
    """The published algorithm for one key."""
    at, nxt = -1, 0
    while nxt < shards:
        at = nxt
        key = (key * 2862933555777941757 + 1) % 2**64
        nxt = int((at + 1) * (2.0**31 / ((key >> 33) + 1)))
    return at


def test_jump_equals_one_by_one_and_moves_only_to_the_new_shard():
    keys = np.random.default_rng(1).integers(0, 2**64, 4000, dtype=np.uint64)
    before, after = sharding.jump(keys, 16), sharding.jump(keys, 17)
    assert list(before) == [plain_jump(int(k), 16) for k in keys]
    assert set(after[before != after]) == {16}
    assert abs((before != after).mean() - 1 / 17) < 0.02
    assert np.bincount(before, minlength=16).min() > 150


def test_assign_edge_rows(docs, no_docs):
    rows = sharding.assign(docs, 4, slices=3).collect()
    assert len(rows) == docs.count() and sharding.assign(no_docs).count() == 0
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 4) and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    of = {r.doc_id: r for r in rows}
    assert (of[2].size, of[2].text_crc32) == (1, 0) == (of[1].size, of[1].text_crc32)
    text = "Übergänge größer 日本 😀 naïve\ncafé\ncafé\n".encode()
    assert (of[10].size, of[10].text_crc32) == (len(text) + 1, zlib.crc32(text))


def test_targets_fill_and_reshare(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 500), ("c", 0)], "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    # weights a 3, b 1, c 2, null 3; a and c stop at once, the rest of 2265 goes 1 : 3, null stops at 1000
    assert got == {"a": 20.0, "c": 0.0, None: 1000.0, "b": pytest.approx(1245.0)}


def test_mix_edge_rows_and_rows_of_the_mix(docs, no_docs):
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == docs.count() and mixing.mix_sources(no_docs).count() == 0
    assert all(0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size for r in rows)
    taken, most = defaultdict(int), defaultdict(int)
    for r in rows:
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r.size)
    assert all(abs(taken[r.source] - r.target) <= most[r.source] for r in rows)
    mixed = mixing.mix_sources(docs, whole_rows=True)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in rows)
    assert sorted(map(str, mixing.mix_sources(docs).collect())) == sorted(map(str, rows))


@pytest.mark.parametrize("bins", [1, 4096])
def test_pareto_order_keeps_to_the_target(spark, bins):
    rng = np.random.default_rng(3)
    rows = [(i, f"s{i % 3}", "w " * int(rng.integers(1, 60))) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    got = mixing.mix_sources(docs, bins=bins).collect()
    for source in ("s0", "s1", "s2"):
        mine = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 30
    # the exact order does not depend on the bins that find the sample's end
    assert {r.doc_id: r.taken for r in got} == {r.doc_id: r.taken for r in mixing.mix_sources(docs, bins=64).collect()}


def test_inclusion_is_as_likely_as_told(spark):
    """A tenth of the words of texts of three lengths: told probabilities add up to it, and hold per length."""
    rows = [(i, "s", "w " * (1, 10, 100)[i % 3]) for i in range(30_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    got = mixing.mix_sources(docs, share=0.1).collect()
    words = sum(r.size for r in got) / 10
    assert sum(r.size * r.probability for r in got) == pytest.approx(words)
    for size in (1, 10, 100):
        mine = [r for r in got if r.size == size]
        assert sum(r.copies for r in mine) / len(mine) == pytest.approx(mine[0].probability, abs=0.02)
    assert len({round(r.probability, 9) for r in got}) == 3


def test_short_texts_are_certain(spark):
    """Where most words are asked for, probabilities stop at 1 and the long texts' make up the rest."""
    rows = [(i, "s", "w " * (1 if i % 2 else 50)) for i in range(4000)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id bigint, source string, text string"), share=0.7).collect()
    assert {r.probability for r in got if r.size == 1} == {1.0} and all(r.copies == 1 for r in got if r.size == 1)
    assert sum(r.size * r.probability for r in got) == pytest.approx(got[0].target)
    long = [r for r in got if r.size == 50]
    assert sum(r.copies for r in long) / len(long) == pytest.approx(long[0].probability, abs=0.001)


def test_a_sample_may_end_among_equal_rows(spark):
    """A third of all rows share id and size: as many of them as fit, and rows of the mix as counted."""
    rows = [(i, "s", "a b c", i) for i in range(60)] + [(99, "s", f"x y {k}", k) for k in range(30)] + [(None, "t", "n n", 0)] * 40
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string, size bigint")
    for share in (0.2, 0.5, 0.55, 0.6, 0.65, 0.9, 1.5):
        counted = mixing.mix_sources(docs, share=share)
        mixed = mixing.mix_sources(docs, share=share, whole_rows=True)
        assert mixed.columns == docs.columns
        told = {(r.doc_id, r.source): r.n for r in counted.groupBy("doc_id", "source").agg({"copies": "sum"}).toDF("doc_id", "source", "n").collect()}
        found = {(r.doc_id, r.source): r["count"] for r in mixed.groupBy("doc_id", "source").count().collect()}
        assert found == {k: n for k, n in told.items() if n}
