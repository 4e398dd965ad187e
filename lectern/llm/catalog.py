"""Registered queries of this subpackage, each with its SQL twin where SQL can express it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import bitplanes, chat, decontam, langid, minhash, mixing, pii, quality, runs, sharding, sigtree, trie, warc
from lectern.llm.base import ORACLES, QUERIES, query, table
from lectern.session import shared_folder

__all__ = ["ORACLES", "QUERIES"]


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("op1_warc_chain")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as WARC archives, read them back by their boundary chain."""
    path = scratch(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    found = warc.records(spark, path)
    return found.select(
        warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_of(F.col("refers_to_id")).alias("refers_to"))


@query("op2_jump_shards")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard, slot and shard after growth of all documents."""
    return sharding.assign(table(spark, sf_dir, "documents"), 16)


CONTROL = "\\### Assistant: </turn> ok"


def esc_len(x: str) -> str:
    return f"(length({x}) + length({x}) - length(replace(replace(replace({x}, '\\', ''), '<', ''), '>', '')))"


#: Smaller than the operator's own, so that many of the given conversations need several windows.
OP3_BUDGET, OP3_HISTORY = 512, 128
OP3_SQL = f"""
WITH RECURSIVE every AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CONTROL}' UNION ALL SELECT -7, 1, 'assistant', '{CONTROL}'),
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos
      FROM every),
k AS (SELECT *, ceil(length(text) / 4.0)::BIGINT + 4 AS tokens,
        length('<turn >') + length('</turn>' || chr(10)) + {esc_len('role')} + {esc_len('text')} AS chars FROM t),
b AS (SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY pos) - tokens AS before_,
        first_value(CASE WHEN role = 'system' THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY pos) AS kept,
        first_value(CASE WHEN role = 'system' THEN chars END) OVER (PARTITION BY conv_id ORDER BY pos) AS sys
      FROM k),
s AS (SELECT *, greatest(1, {OP3_BUDGET - OP3_HISTORY} - kept) AS stride, before_ // ({chat.BLOCK} * greatest(1, {OP3_BUDGET - OP3_HISTORY} - kept)) AS block FROM b),
g AS (SELECT a.conv_id, a.block, a.before_, min(z.before_) AS next_
      FROM s a JOIN s z ON a.conv_id IS NOT DISTINCT FROM z.conv_id AND a.block = z.block
       AND z.before_ > a.before_ AND z.before_ + z.tokens > a.before_ + a.stride GROUP BY ALL),
starts AS (
  SELECT conv_id, block, min(before_) AS start_ FROM s GROUP BY ALL
  UNION ALL
  SELECT g.conv_id, g.block, g.next_
  FROM starts JOIN g ON starts.conv_id IS NOT DISTINCT FROM g.conv_id AND starts.block = g.block AND starts.start_ = g.before_),
o AS (SELECT conv_id, start_, lead(start_) OVER (PARTITION BY conv_id ORDER BY start_) AS next_ FROM starts),
z AS (SELECT s.*, o.start_, o.next_ FROM s JOIN o ON s.conv_id IS NOT DISTINCT FROM o.conv_id
       AND s.before_ >= o.start_ AND (o.next_ IS NULL OR s.before_ < o.next_)),
spans AS (SELECT conv_id, start_, sum(tokens) AS holds FROM z GROUP BY ALL),
per AS (
  SELECT z.conv_id, coalesce(max(sys), 0) AS sys, sum(chars + CASE WHEN z.next_ - before_ <= least({OP3_HISTORY}, {OP3_BUDGET} - kept - holds)
           AND NOT (pos = 1 AND role = 'system') THEN chars ELSE 0 END)::BIGINT AS own
  FROM z LEFT JOIN spans ON z.conv_id IS NOT DISTINCT FROM spans.conv_id AND z.next_ = spans.start_ GROUP BY z.conv_id),
w AS (SELECT conv_id, count(*) AS windows FROM starts GROUP BY conv_id),
d AS (SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
        coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY pos), '') AS loss
      FROM t GROUP BY conv_id)
SELECT d.conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
       (own + sys * (windows - 1))::BIGINT AS formatted_chars
FROM d JOIN per ON d.conv_id IS NOT DISTINCT FROM per.conv_id JOIN w ON d.conv_id IS NOT DISTINCT FROM w.conv_id"""


@query("op3_chat_windows", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations and one full of control strings; digests of what is read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), F.lit(CONTROL).alias("text"))
    return chat.digests(chat.windows(turns.unionByName(probe), OP3_BUDGET, OP3_HISTORY))


OP4_SQL = """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS docs FROM d GROUP BY source),
r AS (SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w,
        source_size * 2 AS cap, (sum(source_size) OVER () * 1.5)::DOUBLE AS everything FROM s),
l AS (SELECT *, (everything - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
        row_number() OVER o AS k
      FROM r WINDOW o AS (ORDER BY cap / w, source NULLS LAST)),
f AS (SELECT min(k) AS k FROM l WHERE level * w <= cap),
t AS (SELECT source, source_size, docs,
        CASE WHEN l.k < f.k OR f.k IS NULL THEN cap::DOUBLE ELSE (SELECT level FROM l WHERE l.k = f.k) * w END AS target
      FROM l, f),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
x AS (SELECT *, target - whole * source_size AS rest FROM e),
h AS (SELECT d.source, d.size, count(*) AS n, any_value(x.rest) AS rest, any_value(x.source_size) / (any_value(x.source_size) + d.size * any_value(x.docs)) AS fall
      FROM d JOIN x ON d.source IS NOT DISTINCT FROM x.source WHERE d.size > 0 GROUP BY d.source, d.size),
m AS (SELECT *, (rest - coalesce(sum(n * size) OVER (PARTITION BY source ORDER BY size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(n * size * fall) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS scale FROM h),
sc AS (SELECT source, arg_min(scale, size) AS scale FROM m WHERE scale * fall <= 1 GROUP BY source),
u AS (SELECT d.*, x.source_size, x.target, x.whole, x.rest,
        CASE WHEN size > 0 THEN least(1.0::DOUBLE, coalesce(sc.scale, 0) * (x.source_size / (x.source_size + size * x.docs))) ELSE 0 END AS p,
        (('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
      FROM d JOIN x ON d.source IS NOT DISTINCT FROM x.source LEFT JOIN sc ON d.source IS NOT DISTINCT FROM sc.source),
q AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) * ((1 - p) / p) END AS odds FROM u),
c AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY odds NULLS LAST, doc_id NULLS LAST, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto FROM q)
SELECT doc_id, source, size, source_size, target,
       (whole + CASE WHEN p > 0 AND upto + size / 2 <= rest THEN 1 ELSE 0 END)::INT AS copies,
       (size * (whole + CASE WHEN p > 0 AND upto + size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c"""


@query("op4_pareto_mix", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents to the sources' targets."""
    return mixing.mix_sources(table(spark, sf_dir, "documents")).drop("probability")


@query("op5_pii_crf")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents by patterns and the field."""
    found = pii.detect(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *(f"n_{k}" for k in pii.BASE), "base_sha256", "spans")


@query("op6_language")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learnt from those that are not held out."""
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op7_bit_planes")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, write the ids as compressed planes, read the files back."""
    import public_tokenizers

    path = scratch(spark, "planes")
    bitplanes.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path(bitplanes.TOKENIZER))
    return bitplanes.read(spark, path)


@query("op8_weak_supervision")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict for all documents."""
    return quality.assess(table(spark, sf_dir, "documents"))


UP, DOWN = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PLAIN_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UP}', '{DOWN}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP9_SQL = f"""
WITH i AS (SELECT item_id, {PLAIN_WORDS} AS ws FROM benchmark WHERE item_id IS NOT NULL),
iw AS (SELECT DISTINCT item_id, least(10, len(ws)) AS size,
         array_to_string(list_slice(ws, p, p + least(10, len(ws)) - 1), ' ') AS win
       FROM i, unnest(range(1, greatest(2, len(ws) - 10 + 2))) AS r(p) WHERE len(ws) > 0),
d AS (SELECT row_number() OVER () AS row_, doc_id, {PLAIN_WORDS} AS ws FROM documents),
dw AS (SELECT row_, p, size, array_to_string(list_slice(ws, p, p + size - 1), ' ') AS win
       FROM d, (SELECT DISTINCT size FROM iw) AS sizes, unnest(range(1, len(ws) - size + 2)) AS r(p)
       WHERE len(ws) >= size),
hit AS (SELECT row_, p, dw.size, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.size = iw.size),
covered AS (SELECT row_, count(DISTINCT x) AS n_hit FROM hit, unnest(range(p, p + size)) AS c(x) GROUP BY row_),
items AS (SELECT row_, count(DISTINCT item_id) AS n_items,
            string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY row_)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (row_) LEFT JOIN items USING (row_)"""


@query("op9_decontamination", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans")


SHINGLES = """
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{up}', '{down}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, p, p + 4), ' ') AS s
       FROM w, unnest(range(1, greatest(2, len(ws) - 5 + 2))) AS r(p) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id)""".format(up=UP, down=DOWN)
OP10_SQL = f"""
WITH RECURSIVE {SHINGLES},
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
           FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
          WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents
                UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y)
SELECT documents.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.component_id
FROM documents LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) r USING (doc_id)"""


@query("op10_signature_tree", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents linked by shingles."""
    return sigtree.link(table(spark, sf_dir, "documents"))


OP11_SQL = OP10_SQL.replace("100 * c >= 80", "100 * c >= 85").replace(
    "r.component_id\nFROM", "r.component_id, documents.doc_id = r.component_id AS kept\nFROM")


@query("op11_minhash", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents linked by shingles, found by bands of minima; the first of each is kept."""
    return minhash.link(table(spark, sf_dir, "documents"))


#: crc32 of a decimal number, byte by byte and bit by bit.
CRC_SQL = """xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda crc, b: list_reduce(range(8), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)), xor(crc, b)), 4294967295::BIGINT), 4294967295)"""
OP12_SQL = f"""
WITH c AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
             ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base, {CRC_SQL} % 9 AS h FROM c GROUP BY conv_id),
m AS (SELECT k.conv_id, k.base, k.h, least(k.h, coalesce(b.n, 0)) AS m FROM k LEFT JOIN k b ON b.conv_id = k.base),
t AS (SELECT m.conv_id, pos, role, text FROM m JOIN c ON c.conv_id = m.base AND pos < h
      UNION ALL SELECT m.conv_id, m + pos - h, role, text FROM m JOIN c ON c.conv_id = m.conv_id AND pos >= h),
p AS (SELECT conv_id, 0 AS depth, CAST([] AS VARCHAR[]) AS prefix, 0 AS bytes FROM m
      UNION ALL SELECT conv_id, pos + 1, list(sha256(strlen(role) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY pos), strlen(text) FROM t),
l AS (SELECT conv_id, max(depth) AS n FROM p GROUP BY conv_id),
n AS (SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = l.n), '')) AS ends_sha256
      FROM p JOIN l USING (conv_id) GROUP BY depth, prefix),
f AS (SELECT n.*, q.conv_id AS parent_conv_id, (SELECT count(*) FROM n x WHERE x.depth = n.depth + 1 AND x.prefix[1:x.depth - 1] = n.prefix) AS n_children
      FROM n LEFT JOIN n q ON q.depth = n.depth - 1 AND q.prefix = n.prefix[1:n.depth - 1]),
s AS (SELECT prefix[1:d] AS prefix, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * bytes) AS saved_tokens
      FROM f, unnest(range(depth + 1)) AS r(d) GROUP BY 1)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM f JOIN s USING (prefix)"""


@query("op12_prefix_trie", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of all conversations, rebuilt so that those of one group share their beginnings."""
    turns, convs = trie.in_order(table(spark, sf_dir, "conversations"))
    return trie.nodes(*trie.shared_history(turns, convs))


def planted(docs: DataFrame) -> DataFrame:
    """doc_id, text: in a tenth of the documents, by crc32 of the id, the words repeat from some place on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("([^\\x20\\x09-\\x0D]+)"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).cast("int").alias("g"))
    marked = rows.filter("h % 10 = 0").withColumn("w", words).withColumn("n", F.size("w")).filter("n > 0")
    marked = marked.withColumn("a", F.col("g") % F.col("n"))
    marked = marked.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    again = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get(
        "w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))))
    rest = rows.filter("h IS NULL OR h % 10 <> 0 OR coalesce(regexp_count(text, '[^\\\\x20\\\\x09-\\\\x0D]'), 0) = 0")
    return rest.select("doc_id", "text").unionByName(marked.select("doc_id", F.array_join(again, " ").alias("text")))


@query("op13_word_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in all documents, some of them made periodic first."""
    found = runs.collapse(planted(table(spark, sf_dir, "documents")))
    power = lambda r: 1000 * r["length"] / r["period"]
    more = lambda x, y: x["length"] * y["period"] - y["length"] * x["period"]
    # runs come by start and period, so of equal powers the first stays
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda x, y: F.when(more(x, y) >= 0, x).otherwise(y))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("_best", best)
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.floor(power(F.col("_best"))).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
