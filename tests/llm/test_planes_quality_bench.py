import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lectern.llm import bitplanes, decontam, quality


@pytest.mark.parametrize("planes", ["byte", "bit"])
@pytest.mark.parametrize("ids", [[], [0], [0, 0, 0], [2**32 - 1, 5], list(range(1000)) * 9])
def test_chunks_round_trip(planes, ids):
    ids = np.array(ids, "<u4")
    assert (bitplanes.unpack(memoryview(bitplanes.pack(ids, planes))) == ids).all()


@pytest.fixture(scope="module")
def tokenizer():
    names = pytest.importorskip("public_tokenizers")
    return names.path(bitplanes.TOKENIZER)


def test_encoder_equals_tokenizer(tokenizer):
    coder = bitplanes.encoder(tokenizer)
    texts = ["", " ", "The THE the, the. (the) the.) don't 'tis x's", "<|endoftext|> a<|startoftext|>", "a\xa0b\x85c\x1cd", "日本 İ Σας", "naïve ÉÈ ß µ ª",
             "é é", "12.5,3 a1b2 x_y", "| a | b |", "!!! ...", "ÿŸ÷×", "line\nline\ttab"]
    want = [np.array(x.ids, "<u4").tobytes() for x in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert coder.texts(texts) == want


def test_files_round_trip(spark, docs, no_docs, tokenizer, tmp_path):
    bitplanes.write(docs, str(tmp_path / "a"), tokenizer, file_bytes=1000)
    got = sorted(bitplanes.read(spark, str(tmp_path / "a")).collect(), key=lambda r: r.start)
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    coder, at = bitplanes.encoder(tokenizer), 0
    assert len(got) == len(rows)
    for r, (doc_id, text) in zip(got, rows):
        ids = [*coder.tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    bitplanes.write(no_docs, str(tmp_path / "b"), tokenizer)
    assert bitplanes.read(spark, str(tmp_path / "b")).count() == 0


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(runs)
    hit = {i + k for i, r in enumerate(runs) if times[r] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_quality_counts_and_edge_rows(docs, no_docs, spark):
    rng = np.random.default_rng(6)
    more = [" ".join(rng.choice(["a", "b", "ü", "c#", "\n", "d|e"], rng.integers(0, 80))) for _ in range(60)]
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(more)], "doc_id bigint, text string")
    both = docs.select("doc_id", "text").union(extra)
    rows = quality.assess(both).collect()
    texts = {r.doc_id: r.text or "" for r in both.collect()}
    assert len(rows) == both.count() and quality.assess(no_docs).count() == 0
    for r in rows:
        n = plain_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0]) and not (r.kept and r.base_failed)
    kept = quality.keep_good(docs)
    verdict = {r.doc_id: r.kept for r in quality.assess(docs).collect()}
    assert kept.columns == docs.columns and sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(
        str(r.doc_id) for r in docs.collect() if verdict[r.doc_id])


def test_posterior_tells_good_from_bad():
    rng = np.random.default_rng(8)
    good = rng.random(20_000) < 0.85
    vote = lambda p: rng.random(len(good)) < p
    marks = [np.where(vote(np.where(good, 0.005, 0.4)), 0, -1) for _ in quality.FAULTS]
    marks += [np.where(vote(np.where(good, 0.95, 0.6)), 1, -1) for _ in quality.RANGES]
    pattern = np.zeros(len(good), np.int64)
    for m in marks:
        pattern = pattern * 3 + m + 1
    kinds, at, counts = np.unique(pattern, return_inverse=True, return_counts=True)
    post, given, share = quality.fit(kinds, counts.astype(float))
    assert ((post[at] >= 0.5) == good).mean() > 0.97 and abs(share - 0.85) < 0.05


def plain_hits(text, items):
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    words, hit, found = fold(text), set(), set()
    for name, item in items:
        ws = fold(item)
        for win in {tuple(ws[i : i + 10]) for i in range(max(1, len(ws) - 9))} if ws and name is not None else ():
            for p in range(len(words) - len(win) + 1):
                if tuple(words[p : p + len(win)]) == win:
                    hit.update(range(p, p + len(win)))
                    found.add(str(name))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("most", [decontam.PATTERNS, 7])
def test_benchmark_hits_equal_brute_force(spark, docs, no_docs, most):
    rng = np.random.default_rng(9)
    word = lambda n: " ".join(rng.choice(["ab", "Cd", "é", "ef-g", "1"], n))
    items = [(i, word(n)) for i, n in enumerate([3, 9, 10, 11, 14, 30])] + [(20, ""), (21, None), (None, "ab ab"), (5, word(12)), (22, "This")]
    texts = [(100 + i, word(rng.integers(0, 40)) + " ... " + str(items[i % 6][1]).upper() + "!" + word(5)) for i in range(40)]
    table = docs.select("doc_id", "text", "n", "label").union(spark.createDataFrame([(*t, 1, "x") for t in texts], "doc_id bigint, text string, n int, label string"))
    bench = spark.createDataFrame([(*i, "q") for i in items], "item_id bigint, text string, doc_id string")
    got = decontam.contamination(table, bench, most=most).collect()
    want = sorted(str((r.doc_id, *plain_hits(r.text, items))) for r in table.collect())
    assert sorted(str((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)) for r in got) == want
    clean = decontam.keep_clean(table, bench, most=most)
    assert clean.columns == table.columns and clean.count() == sum(not r.contaminated for r in got)
    if most == 7:
        assert decontam.contamination(no_docs, bench).count() == 0
        assert not any(r.contaminated for r in decontam.contamination(docs, bench.limit(0)).collect())


def test_spans_give_back_the_original():
    text = "Zürich, ONE two -- three; four 😀 five".encode()
    scanner = decontam.Scanner([(" one two three ", ["1"]), (" four ", ["2"])])
    n, ranges, items = scanner.scan(text)
    spans = decontam.original(text, ranges)
    assert [text.decode()[a:b] for a, b in spans] in (["ONE two -- three", "four"], ["ONE two -- three; four"]) and items == {"1", "2"}
