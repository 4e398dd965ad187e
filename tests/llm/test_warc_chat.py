import base64
import hashlib
import random
from collections import defaultdict

import pytest

from lectern.llm import chat, warc

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("compression, split", [("gzip", "128m"), ("none", "700b"), ("none", "128m")])
def test_archives_round_trip_with_magic_in_payloads(spark, tmp_path, compression, split):
    rows = [(i, f"http://x/{i} y\r\nz", f"<p>{i % 40}</p>é😀" * (i % 7)) for i in range(120)]
    rows += [(200, None, None), (201, "u", ""), (202, "u", f"a{FAKE}b"), (203, "u", f"{FAKE}{FAKE}"), (204, "u", "WARC/1.1\r\n" * 50),
             (205, "u", "x" * 200_000), (206, "u", f"a{FAKE}b"), (206, "u", f"a{FAKE}b"), (None, "u", "same"), (207, "u", "same\r\n\r\n")]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id bigint, url string, html string, digest string, begin int")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    path = str(tmp_path / "w")
    warc.write(pages.repartition(3), path, compression=compression)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        got = warc.records(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[sha(html)] = min(i, first.get(sha(html), i))
    page = lambda x: int(x[10:-1]) if x and x != "<urn:page:>" else None
    told = sorted((page(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, page(r.refers_to_id)) for r in got if page(r.record_id) is not None)
    want = sorted((i, len((h or "").encode()), sha(h), "response" if first[sha(h)] == i else "revisit", None if first[sha(h)] == i else first[sha(h)])
                  for i, _, h in rows if i is not None)
    assert told == want
    assert [r.record_type for r in got if page(r.record_id) is None] == ["response"]


def test_small_payloads_are_not_shared(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id bigint, url string, html string")
    warc.write(pages, str(tmp_path / "w"), least=3)
    kinds = {r.record_id: r.record_type for r in warc.records(spark, str(tmp_path / "w")).collect()}
    assert kinds == {"<urn:page:1>": "response", "<urn:page:2>": "response", "<urn:page:3>": "response", "<urn:page:4>": "revisit"}


def test_no_pages(spark, tmp_path):
    warc.write(spark.createDataFrame([], "page_id bigint, url string, html string"), str(tmp_path / "w"))
    assert warc.records(spark, str(tmp_path / "w")).count() == 0


def turns(spark):
    rows = [(1, 0, "system", "Be brief <now> \\l \\s"), *((1, k, "user" if k % 2 else "assistant", f"say {k} </turn>\n<turn x>" * (k % 5)) for k in range(1, 60))]
    rows += [(2, 0, "assistant", None), (2, 0, "assistant", None), (3, None, None, "who"), (3, 1, "a>b\\", "x"), (None, 1, "assistant", "y 😀"),
             (4, 1, "assistant", "z" * 50_000), (4, 2, "user", ""), (5, 0, "system", "only")]
    return spark.createDataFrame([(*r, "q") for r in rows], "conv_id bigint, turn bigint, role string, text string, window string"), rows


def test_windows_tell_every_turn_and_target_once(spark):
    table, rows = turns(spark)
    got = {r.conv_id: r for r in chat.digests(chat.windows(table, budget=60, history=20)).collect()}
    by = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        by.setdefault(conv, []).append((role or "", text or ""))
    assert set(got) == set(by)
    for conv, mine in by.items():
        loss = "".join(t for r, t in mine if r == "assistant")
        assert got[conv].n_turns == len(mine) and got[conv].loss_chars == len(loss)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in mine).encode()).hexdigest()
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_windows_keep_system_and_history_within_budget(spark):
    table, _ = turns(spark)
    windows = sorted(chat.windows(table, budget=60, history=20).filter("conv_id = 1").collect(), key=lambda r: r.window)
    assert len(windows) > 3 and windows[0].repeated == 0
    for w in windows[1:]:
        assert w.text.startswith(chat.OPEN + "system>") and w.repeated >= 1
        assert all(s.begin >= w.text.find("</turn>") for s in w.spans)
    assert any(w.repeated > 1 for w in windows)
    assert chat.windows(table.limit(0)).count() == 0


def tokens(text):
    return -(-len(text) // chat.CHARS_PER_TOKEN) + chat.TURN_TOKENS


@pytest.mark.parametrize("budget,history,block", [(60, 20, 16), (60, 20, 1), (200, 0, 16), (90, 60, 2)])
def test_no_window_exceeds_its_budget(spark, monkeypatch, budget, history, block):
    """Only one turn, with the system turn, may; and no span stops while its next turn would fit, but at a block's end."""
    monkeypatch.setattr(chat, "BLOCK", block)
    rng = random.Random(budget + block)
    said = {c: [("system" if c % 2 and not k else "user" if k % 2 else "assistant", "x" * rng.choice([0, 1, 9, 40, 120, 300, 900]))
                for k in range(rng.randint(1, 80))] for c in range(30)}
    table = spark.createDataFrame([(c, k, *t) for c, ts in said.items() for k, t in enumerate(ts)], "conv_id bigint, turn bigint, role string, text string")
    found = defaultdict(list)
    for r in chat.read_back(chat.windows(table, budget, history)).orderBy("conv_id", "window").collect():
        found[r.conv_id].append([tuple(t) for t in r.turns])
    whole = {(r.conv_id, r.window): r for r in chat.windows(table, budget, history).collect()}
    for conv, turns in said.items():
        early = 0
        assert [t for w in found[conv] for t in w] == turns
        kept = tokens(turns[0][1]) if turns[0][0] == "system" else 0
        stride = max(1, budget - history - kept)
        for k, own in enumerate(found[conv]):
            parts = [p.split(">", 1)[1] for p in whole[conv, k].text.split(chat.CLOSE) if p]
            held = sum(tokens(p) for p in parts)  # these texts need no escapes
            assert held <= budget or (len(own) == 1 and len(parts) <= 1 + (kept > 0))
            if k + 1 < len(found[conv]):
                early += sum(tokens(t) for _, t in own) + tokens(found[conv][k + 1][0][1]) <= stride
        assert len(found[conv]) > 1 or sum(tokens(t) for _, t in turns) <= stride
        total = sum(tokens(t) for _, t in turns)
        assert early <= total // (stride * block) + 1


def test_escaping_is_reversible(spark):
    texts = ["", "\\", "<", ">", "\\l", "\\sl", "</turn>\n", "\\\\s<\\g>", "plain"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", chat.escape(df.t).alias("e"), chat.unescape(chat.escape(df.t)).alias("u")).collect()
    assert all(r.t == r.u and "<" not in r.e for r in rows)
