"""Prefix trie of conversations by van Emde Boas recursion.

A trie of height 2^k is an upper trie of half the height and, below each of its nodes at the cut, a
lower forest of the other half. Going up, aligned stretches of 1, 2, 4 ... turns get names, each from
the names of its two halves. Going down, every sequence is cut at half depth: its prefix at the cut
gets a name from the forest's and the upper stretch's, and that names the lower forest in which the
rest of the sequence goes on. Upper tries and lower forests of one height are cut at once, in one step for
all of them, until they are one turn high; then every prefix of every sequence has a name, and sequences
with an equal prefix have the same one.

Totals go the other way. A node's own share is its total in a trie one turn high. Where two
heights meet, the total of each node at the cut, whole in its lower forest, is grafted on all nodes above it in
the upper trie, by the path of one of its members. Heights 1, 2, 4 ... are grafted in turn.

A step joins and groups rows by (conversation, stretch) or by name, so neither a long conversation nor a
prefix that many share lies in one task. Names are 128 bits of SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.session import write_and_read

ROOT = bytes(16)
#: Ids that are joined to one piece on the way to a digest.
PIECE = 1 << 14


def name_of(*parts: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def turn_name(role: Column, text: Column) -> Column:
    return name_of(F.octet_length(role).cast("string").cast("binary"), F.lit(b":"), role.cast("binary"), text.cast("binary"))


def in_order(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, name, bytes) of every turn, pos from 0; (conv_id, n) of every conversation.

    Turns stand by turn (null first), ties by role and text, null role and text being empty; rows with
    a null conv_id belong to no conversation. Sorted by ranges, so that a long one takes several tasks.
    """
    rows = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = rows.orderBy("conv_id", "turn", "role", "text").select(
        "conv_id", turn_name(F.col("role"), F.col("text")).alias("name"),
        F.octet_length("text").cast("bigint").alias("bytes"), F.monotonically_increasing_id().alias("_at"))
    placed = write_and_read(placed.withColumn("_part", F.shiftright("_at", 33)), "trie-sorted")
    # of each conversation and range the first place; a conversation has no more ranges than the sort has tasks
    parts = placed.groupBy("conv_id", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    parts = write_and_read(parts, "trie-parts")
    before = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.select("conv_id", "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    turns = placed.join(shift, ["conv_id", "_part"]).select("conv_id", (F.col("_at") + F.col("_shift")).alias("pos"), "name", "bytes")
    return turns, parts.groupBy("conv_id").agg(F.sum("_n").alias("n"))


def shared_history(turns: DataFrame, convs: DataFrame, group: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their group: the first h turns of c - c % group, then
    c's own after its first h, where h = crc32(c) % (most + 1); the same two tables."""
    asked = convs.select(
        "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).alias("h"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("_n"))
    asked = asked.join(bases, "base", "left").withColumn("m", F.least(F.col("h"), F.coalesce("_n", F.lit(0)))).drop("_n")
    asked = write_and_read(asked, "trie-histories")
    own = turns.join(asked.select("conv_id", "h", "m"), "conv_id").filter("pos >= h").select(
        "conv_id", (F.col("m") + F.col("pos") - F.col("h")).alias("pos"), "name", "bytes")
    first = turns.filter(f"pos < {most}").withColumnRenamed("conv_id", "base")
    history = first.join(asked.select("conv_id", "base", "h"), "base").filter("pos < h").select("conv_id", "pos", "name", "bytes")
    lengths = asked.select("conv_id", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))
    return own.unionByName(history), lengths


def paths(turns: DataFrame, convs: DataFrame, height: int) -> DataFrame:
    """(conv_id, depth, node): the name of every prefix, the empty one too, of sequences shorter than 2^height."""
    stretches = [turns.select("conv_id", F.col("pos").alias("b"), "name")]
    for _ in range(1, height):
        whole = stretches[-1].groupBy("conv_id", F.shiftright("b", 1).alias("b")).agg(
            F.min_by("name", "b").alias("_l"), F.max_by("name", "b").alias("_r"), F.count(F.lit(1)).alias("_n"))
        whole = whole.filter("_n = 2").select("conv_id", "b", name_of(F.col("_l"), F.col("_r")).alias("name"))
        stretches.append(write_and_read(whole, "trie-stretches"))
    forests = convs.select("conv_id", F.lit(0).cast("bigint").alias("b"), F.lit(ROOT).alias("node"))
    for above in reversed(stretches):
        upper = above.filter("b % 2 = 0").select("conv_id", "b", "name")
        cut = forests.withColumn("b", 2 * F.col("b")).join(upper, ["conv_id", "b"], "left")
        lower = F.struct((F.col("b") + 1).alias("b"), name_of(F.col("node"), F.col("name")).alias("node"))
        both = F.when(F.col("name").isNull(), F.array(F.struct("b", "node"))).otherwise(F.array(F.struct("b", "node"), lower))
        forests = write_and_read(cut.select("conv_id", F.explode(both).alias("_t")).select("conv_id", "_t.*"), "trie-forests")
    return forests.withColumnRenamed("b", "depth")


def grafted(own: DataFrame, path: DataFrame, height: int, measures: list[str]) -> DataFrame:
    """node and the sums of `measures` over its subtree. own: node, conv_id (a member), depth, measures."""
    sums = lambda rows, *keys: rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    parts = [own.select("node", "depth", *measures)]
    members = own.select("node", "conv_id")
    for k in range(height):
        at_cut = F.shiftright("depth", k) % 2 == 1
        roots = reduce(DataFrame.unionByName, parts).filter((F.col("depth") % (1 << k) == 0) & at_cut)
        below = sums(roots, "node", "depth").join(members, "node").select("conv_id", (F.shiftright("depth", k) - 1).alias("_block"), *measures)
        above = path.withColumn("_block", F.shiftright("depth", k)).filter("_block % 2 = 0")
        met = above.join(below, ["conv_id", "_block"])
        parts.append(write_and_read(sums(met, "node", "depth"), "trie-grafts"))
    return sums(reduce(DataFrame.unionByName, parts), "node")


def id_digests(rows: DataFrame) -> DataFrame:
    """(node, sha): SHA-256 of the decimal conv_ids of each node, ascending, joined by commas. Ids are
    sorted by ranges and joined to pieces there; a node's digest streams over its pieces."""

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, ids = batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()
            edges = [0, *(i for i in range(1, len(ids)) if nodes[i] != nodes[i - 1] or i % PIECE == 0), len(ids)]
            spans = [(a, b) for a, b in zip(edges, edges[1:]) if a < b]
            yield pa.record_batch({
                "node": pa.array([nodes[a] for a, _ in spans], pa.binary()),
                "first": pa.array([ids[a] for a, _ in spans], pa.int64()),
                "ids": pa.array([",".join(map(str, ids[a:b])) for a, b in spans], pa.string())})

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        out: list[tuple[bytes, str]] = []
        for batch in batches:
            for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if node == held:
                    state.update(b",")
                else:
                    if held is not None:
                        out.append((held, state.hexdigest()))
                    held, state = node, hashlib.sha256()
                state.update(ids.encode())
            yield pairs(out)
            out = []
        if held is not None:
            yield pairs([(held, state.hexdigest())])

    def pairs(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
        return pa.record_batch({"node": pa.array([n for n, _ in rows], pa.binary()), "sha": pa.array([s for _, s in rows], pa.string())})

    pieces = rows.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = pieces.mapInArrow(join_ids, "node binary, first bigint, ids string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, sha string")


def nodes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the sequences: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    turns: conv_id bigint, pos, name, bytes; convs: conv_id and n for every sequence, those without turns
    too, which are members of the root alone. No sequences give no rows, not even a root.
    """
    turns, convs = write_and_read(turns.select("conv_id", "pos", "name", "bytes"), "trie-turns"), write_and_read(convs, "trie-convs")
    height = int(convs.agg(F.max("n")).first()[0] or 0).bit_length()
    path = paths(turns, convs, height)
    named = path.groupBy("node", "depth").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    steps = path.withColumnRenamed("depth", "pos").join(turns.select("conv_id", "pos", "bytes"), ["conv_id", "pos"])
    steps = steps.select("conv_id", (F.col("pos") + 1).alias("depth"), F.col("node").alias("parent"), "bytes")
    named = write_and_read(named.join(steps, ["conv_id", "depth"], "left"), "trie-nodes")
    children = named.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    named = write_and_read(named.join(children, "node", "left").fillna(0, ["n_children"]), "trie-children")
    own = named.select("node", "conv_id", "depth", (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
                       ((F.col("n_convs") - 1) * F.coalesce("bytes", F.lit(0))).alias("saved_tokens"))
    totals = grafted(own, path, height, ["n_leaves", "saved_tokens"])
    ends = id_digests(path.join(convs.select("conv_id", F.col("n").alias("depth")), ["conv_id", "depth"]))
    parents = named.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = named.join(totals, "node").join(ends, "node", "left").join(parents, "parent", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
