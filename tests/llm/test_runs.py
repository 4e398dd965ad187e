import hashlib
import random
import zlib

import numpy as np
import pytest

from lectern.llm import runs
from lectern.llm.catalog import QUERIES


def plain_runs(words):
    """(start, length, smallest period) of all runs by comparing words at every distance."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q) and j > i:
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_collapsed(words, found):
    dropped = {k for s, n, q in found for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in dropped)


def texts(seed, n=120):
    rng = random.Random(seed)
    for _ in range(n):
        size, kinds, words = rng.choice([0, 10, 60, 300]), rng.choice([1, 2, 3, 50]), []
        while len(words) < size:
            piece = [f"é{rng.randrange(kinds)}" for _ in range(rng.randint(1, 30))]
            words += (piece * rng.randint(1, 12))[: rng.randint(1, 200)] if rng.random() < 0.6 else piece
        yield rng.choice([" ", "\n", "\t\x0b "]).join(words)


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_comparing_all_words(seed):
    given = list(texts(seed))
    for text, (found, collapsed) in zip(given, runs.in_texts([t.encode() for t in given]), strict=True):
        assert found == plain_runs(text.split())
        assert collapsed == plain_collapsed(text.split(), found)


def test_grammar_gives_back_the_text_and_repeats_no_pair():
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 4, 3000)
    grammar = runs.Grammar(ids)
    assert grammar.rounds > 3 and len(grammar.begin)
    length = grammar.end - grammar.begin
    for symbol, at in zip(grammar.symbol, grammar.at):  # every occurrence spells what the first one does
        assert np.array_equal(ids[at : at + length[symbol]], ids[grammar.begin[symbol] : grammar.end[symbol]])
    ends = np.append(grammar.starts[1:], len(ids))
    last = [tuple(ids[a:b]) for a, b in zip(grammar.starts, ends)]
    pairs = list(zip(last, last[1:]))
    assert len(last) < len(ids) / 2 and max(sum(p == q for q in pairs) for p in set(pairs)) <= 2


def test_misleading_hashes_are_noticed():
    """Prefix hashes modulo 2^64 are equal for the halves of long Thue-Morse words."""
    bits = [bin(i).count("1") & 1 for i in range(4096)]
    words = ["ab"[b] for b in bits] * 3
    changed = bits[:2048] + [1 - b for b in bits[:2048]] * 5
    for w in (words, ["ab"[b] for b in changed]):
        assert next(runs.in_texts([" ".join(w).encode()]))[0] == plain_runs_fast(w)


def plain_runs_fast(words):
    ids = np.unique(words, return_inverse=True)[1]
    found = {}
    for s, e, q in sorted(runs.by_period(ids, 0).T.tolist(), key=lambda r: r[2]):
        found.setdefault((s, e - s), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def test_long_periodic_text_takes_linear_time():
    text = ("alpha beta gamma " * 7 + "delta ") * 20_000
    (found, collapsed), = runs.in_texts([text.encode()])
    assert found[0] == (0, 440_000, 22) or (0, 440_000, 22) in found
    assert collapsed.split()[:3] == ["alpha", "beta", "gamma"] and len(collapsed.split()) <= 22


def test_collapse_keeps_rows_and_ids(spark, docs, no_docs):
    big = spark.createDataFrame([(2**60 + 1, "x " * 30, "runs"), (2**60 + 2, None, "r"), (None, "a b", None), (2**60 + 2, "", "r")], "doc_id bigint, text string, runs string")
    got = {(r.doc_id, r.text): (len(r.runs), r.collapsed) for r in runs.collapse(big).collect()}
    assert got == {(2**60 + 1, "x " * 30): (1, "x"), (2**60 + 2, None): (0, ""), (None, "a b"): (0, "a b"), (2**60 + 2, ""): (0, "")}
    assert runs.collapse(docs).count() == docs.count() and runs.collapse(no_docs).count() == 0


def plain_row(doc_id, text):
    words = (text or "").replace("\x0b", " ").split() if text is not None else []
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None,) * 3
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
            hashlib.sha256(plain_collapsed(words, found).encode()).hexdigest())


def test_query_equals_plain_python(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts(9, 300))] + [(2**60 + 1, "é " * 40), (2**60 + 3, None), (None, "u v " * 30), (3, "u v " * 30), (3, "u v " * 30)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op13_word_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted((plain_row(*r) for r in rows), key=repr)
    assert sum(r[1] > 0 for r in got) > 50
