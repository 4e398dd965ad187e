"""The pipeline's run() against plain Python, stage after stage, on whole tables with edge rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from test_sharding_mixing import plain_jump
from test_sigtree_pipeline import plain_components

import corpus_pipeline
from lectern.llm import mixing, quality
from lectern.llm.words import mix

SMALL = Path("/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_votes(text):
    """(vote of each rule, whether the base test fails)"""
    words = WORD.findall(text)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(runs)
    repeated = {i + k for i, r in enumerate(runs) if times[r] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    count = lambda pattern: len(re.findall(pattern, text))
    letters = count(r"[A-Za-z\x80-\U0010FFFF]")
    f = {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": count(r"[#*$%&|<>]"), "n_bars": count(r"[|<>]"),
        "n_repeat_words": len(repeated), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_upper": count("[A-Z]"),
        "n_letters": letters, "n_marks": count("[!?]"), "n_stops": count("[.!?]"), "n_other": sum(map(len, words)) - letters,
    }
    votes = []
    for _, key, base, most in quality.FAULTS:
        votes.append(0 if 100 * f[key] > most * max(1, f[base]) else -1)
    for _, key, base, (low, high), (least, most) in quality.RANGES:
        x = f[key] / max(1, f[base]) if base else f[key]
        votes.append(1 if low <= x <= high else 0 if x < least or x > most else -1)
    if not words:
        votes = [-1] * len(votes)
    return tuple(votes), len(words) < 10 or 100 * len(repeated) > 20 * len(words)


def plain_good(rows):
    told = [plain_votes(r["text"] or "") for r in rows]
    counts = Counter(v for v, _ in told)
    kinds = ["fault"] * len(quality.FAULTS) + ["range"] * len(quality.RANGES)
    prior = [[quality.PRIOR[k][c] for k in kinds] for c in (0, 1)]
    given, share, belief, post = prior, quality.GOOD_SHARE, quality.BELIEF * len(rows), {}
    for _ in range(quality.ROUNDS):
        for votes in counts:
            bad, good = (
                math.log(p) + sum(math.log(max(1e-12, given[c][r][v + 1])) for r, v in enumerate(votes))
                for c, p in ((0, 1 - share), (1, share)))
            post[votes] = 1 / (1 + math.exp(min(700, bad - good)))
        given = [
            [[sum(n * (post[v] if c else 1 - post[v]) for v, n in counts.items() if v[r] + 1 == kind) + belief * prior[c][r][kind]
              for kind in range(3)] for r in range(len(kinds))] for c in (0, 1)]
        given = [[[x / sum(three) for x in three] for three in rules] for rules in given]
        share = (sum(n * post[v] for v, n in counts.items()) + belief * quality.GOOD_SHARE) / (len(rows) + belief)
    return [r for r, (v, failed) in zip(rows, told) if not failed and post[v] >= quality.THRESHOLD]


def plain_first(rows):
    told = Counter(plain_components([(r["doc_id"], r["text"]) for r in rows]))
    heads = {i for i in {r["doc_id"] for r in rows} if i is not None and any(t.startswith(f"({i}, ") and t.endswith(f" {i})") for t in told)}
    return [r for r in rows if r["doc_id"] is None or r["doc_id"] in heads]


def plain_clean(rows, items):
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
    windows = set()
    for item in items:
        words = fold(item["text"]) if item["item_id"] is not None else []
        windows |= {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))} if words else set()
    sizes = {len(w) for w in windows}

    def hit(words):
        return any(tuple(words[i : i + n]) in windows for n in sizes for i in range(len(words) - n + 1))

    return [r for r in rows if not hit(fold(r["text"]))]


def plain_mix(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append((len(WORD.findall(r["text"] or "")), r))
    order = sorted(groups, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    size = {s: sum(n for n, _ in groups[s]) for s in order}
    target, free = {}, set(order)
    while free:  # fill by weight, stop what is above its bound, begin again
        level = (1.5 * sum(size.values()) - sum(target.values())) / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > 2 * size[s]}
        target.update({s: 2 * size[s] for s in above} if above else {s: level * weight[s] for s in free})
        free = free - above if above else set()
    out = []
    for s in order:
        whole = int(target[s] // size[s]) if size[s] else 0
        rest, before, mean = target[s] - whole * size[s], 0, size[s] / len(groups[s])
        ranked, sure, scale = [], set(), 0.0
        while size[s]:  # make certain what would exceed 1, begin again
            scale = (rest - sum(n for k, (n, _) in enumerate(groups[s]) if k in sure)) / sum(
                n * mean / (mean + n) for k, (n, _) in enumerate(groups[s]) if k not in sure)
            more = {k for k, (n, _) in enumerate(groups[s]) if n and k not in sure and scale * mean / (mean + n) > 1}
            sure |= more
            if not more:
                break
        for n, r in groups[s]:
            name = "null" if r["doc_id"] is None else str(r["doc_id"])
            u = (int(hashlib.md5(name.encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            p = min(1.0, scale * mean / (mean + n)) if n else 0.0
            ranked.append(((u / (1 - u)) * ((1 - p) / p) if p else math.inf, r["doc_id"] is None, r["doc_id"] or 0, n, r))
        for *_, n, r in sorted(ranked, key=lambda x: x[:4]):
            out += [r] * (whole + (n > 0 and rest > 0 and before + n / 2 <= rest))
            before += n
    return out


def plain_shard(row):
    text, i = (row["text"] or "").encode(), row["doc_id"]
    key = int(mix(np.array([0x5BD1E995 if i is None else i], np.uint64))[0])
    return i, len(text) + 1, zlib.crc32(text), "key", plain_jump(key, 16), plain_jump(key, 17)


@pytest.mark.skipif(not SMALL.is_dir(), reason="needs the given tables")
def test_run_equals_plain_python(spark, docs, tmp_path):
    rows = pq.read_table(SMALL / "documents.parquet").to_pylist()
    names = docs.columns
    edge = [r.asDict() | {"doc_id": None if r.doc_id is None else r.doc_id + 1_000_000} for r in docs.collect()]
    both = [{k: r.get(k) for k in names} for r in rows] + edge
    items = pq.read_table(SMALL / "benchmark.parquet").to_pylist()
    spark.createDataFrame([tuple(r[k] for k in names) for r in both], docs.schema).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(str(SMALL / "benchmark.parquet")).write.parquet(str(tmp_path / "benchmark.parquet"))

    good = plain_good(both)
    first = plain_first(good)
    clean = plain_clean(first, items)
    mixed = plain_mix(clean)
    assert len(both) > len(good) > len(first) > len(clean) > 20  # each stage has work in these tables
    assert mixing.WEIGHTS == (3, 1, 2) and len(mixed) > len(set(map(id, mixed)))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    told = Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got)
    assert told == Counter(map(plain_shard, mixed))
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run_on_no_rows(spark, no_docs, tmp_path):
    no_docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
