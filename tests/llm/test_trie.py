import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from lectern.llm import trie


def rebuilt(rows):
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            given[conv].append(((0, 0) if turn is None else (1, turn), role or "", text or ""))
    given = {c: [t[1:] for t in sorted(turns)] for c, turns in given.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 9 for c in given}
    return {c: given.get(c - c % 5 if c >= 0 else c + -c % 5, [])[: heads[c]] + turns[heads[c]:] for c, turns in given.items()}


def plain_nodes(sequences):
    members, children = defaultdict(list), defaultdict(int)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for prefix in members:
        if prefix:
            children[prefix[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for prefix, mine in members.items():
        for d in range(len(prefix) + 1):
            leaves[prefix[:d]] += children[prefix] == 0
            saved[prefix[:d]] += (len(mine) - 1) * len(prefix[-1][1].encode()) if prefix else 0
    for prefix, mine in members.items():
        ends = ",".join(str(c) for c in sorted(mine) if len(sequences[c]) == len(prefix))
        yield (min(mine), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(mine), children[prefix],
               leaves[prefix], saved[prefix], hashlib.sha256(ends.encode()).hexdigest())


def rows_of(found):
    return sorted((tuple(r) for r in found.collect()), key=repr)


SCHEMA = "conv_id bigint, turn bigint, role string, text string, name string, bytes int, pos string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed", range(2))
def test_query_equals_plain_python(spark, tmp_path, seed):
    from lectern.llm.catalog import QUERIES

    rng = random.Random(seed)
    pick = lambda *xs: rng.choice(xs)
    rows = [(pick(None, *range(-12, 30), 2**60, 2**60 + 3), pick(None, 0, 1, 2, 3, 3, 40), pick(None, "", "user", "a"), pick(None, "", "a", "é", "x:")) for _ in range(900)]
    rows += [(c, i, "user", "x" * (i % 3)) for c, n in ((1000, 200), (1003, 170), (1004, 64)) for i in range(n)]
    rows += [(c, i, "user", "same") for c in range(2000, 2200) for i in range(3)]
    table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = rows_of(QUERIES["op12_prefix_trie"](spark, str(tmp_path)))
    assert got == sorted(plain_nodes(rebuilt(rows)), key=repr)


def test_plain_sequences_and_pieces_of_ids(spark, monkeypatch):
    """Without rebuilding; ids are digested in several pieces."""
    monkeypatch.setattr(trie, "PIECE", 3)
    rows = [(c, i, "user", f"t{(c >> i) & 1}") for c in range(64) for i in range(c % 7)] + [(100, 0, None, None)]
    turns, convs = trie.in_order(table(spark, rows))
    sequences = defaultdict(list)
    for c, _, role, text in rows:
        sequences[c].append((role or "", text or ""))
    assert rows_of(trie.nodes(turns, convs)) == sorted(plain_nodes(sequences), key=repr)


def test_empty_tables_and_sequences_without_turns(spark):
    turns, convs = trie.in_order(table(spark, []))
    assert trie.nodes(*trie.shared_history(turns, convs)).count() == 0
    alone = spark.createDataFrame([(5, 0), (7, 0)], "conv_id bigint, n bigint")
    (row,) = trie.nodes(turns, alone).collect()
    assert tuple(row) == (5, 0, None, 2, 0, 1, 0, hashlib.sha256(b"5,7").hexdigest())


def test_roles_and_texts_are_told_apart(spark):
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "", "abc"), (4, 0, None, "abc")]
    turns, convs = trie.in_order(table(spark, rows))
    assert trie.nodes(turns, convs).filter("depth = 1").count() == 3
