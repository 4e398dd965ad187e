"""Texts in cells of bounded size, and exact links within them; shared by the operators on near copies.

What is compared exactly stands in cells: hashes of shared shingles are columns, texts are rows of bits, and common
bits of all pairs are counted. A cell gives links that span its components, so a group of copies is
never expanded to pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.words import Block, as_bytes, blocks, whole_windows, windows
from lectern.session import write_and_read

#: Texts, and shingles, that one cell holds on average at most of one side; a longer text stands alone.
CELL, CELL_SHINGLES = 512, 1 << 19
#: Bytes of texts that are cut to shingles at once.
BLOCK = 1 << 20
#: Numbers that ids are hashed to when texts are picked out; all of them are 8 MB.
PICK = 1 << 20


# -- picking texts ----------------------------------------------------------------


def bucket() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(PICK)).cast("int").alias("_pick")


def picked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id may be in ids: those that share its number of PICK, which are few
    more while ids are far fewer than PICK, and all at worst. No text is shuffled; what goes to all
    tasks is at most PICK numbers."""
    few = F.broadcast(ids.select(bucket()).distinct())
    return docs.withColumn("_pick", bucket()).join(few, "_pick", "left_semi").drop("_pick")


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id is not in ids. Only texts whose hash number one of ids shares are shuffled."""
    few = F.broadcast(ids.select(bucket()).distinct())
    marked = docs.withColumn("_pick", bucket())
    near = marked.join(few, "_pick", "left_semi").join(ids, "doc_id", "left_anti")
    return marked.join(few, "_pick", "left_anti").unionByName(near).drop("_pick")


# -- sets ------------------------------------------------------------------------


def shingles(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingles of each text laid end to end, and where each text's begin.
    A-Z is lower-cased; of fewer words the whole sequence is one shingle; without words, none."""
    block = Block(texts)
    words = block.hashes(lower=True)
    keep = np.flatnonzero(whole_windows(block, width))
    keys, doc = windows(words, width)[keep], block.doc[keep]
    short = np.flatnonzero((block.counts > 0) & (block.counts < width))
    if len(short):
        whole = np.concatenate([windows(words[block.first[i] : block.first[i + 1]], int(block.counts[i])) for i in short])
        keys, doc = np.concatenate([keys, whole]), np.concatenate([doc, short])
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])])[: len(keys)]
    return keys[new], np.searchsorted(doc[new], np.arange(len(texts) + 1))


# -- cells -----------------------------------------------------------------------


def whole_cells(key: list[str], least: int, work: Callable) -> Callable:
    """For mapInArrow over rows sorted by `key`: calls work(columns, cell number of each row) on whole cells,
    as many at once as hold `least` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(table: pa.Table, number: np.ndarray) -> pa.RecordBatch:
            return work({k: table.column(k) for k in table.column_names}, number)

        def numbered(table: pa.Table) -> np.ndarray:
            new = np.zeros(table.num_rows, bool)
            for k in key:
                column = table.column(k).to_numpy()
                new[1:] |= column[1:] != column[:-1]
            return np.cumsum(new)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) >= least:
                table = pa.Table.from_batches(held)
                number = numbered(table)
                done = int(np.searchsorted(number, number[-1]))  # the last cell may go on in the next batch
                if done:
                    yield flush(table.slice(0, done), number[:done])
                    held = table.slice(done).to_batches()
        if held:
            table = pa.Table.from_batches(held)
            yield flush(table, numbered(table))

    return run


def spanning(linked: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges of a forest that spans the components of a matrix of links."""
    left, right = [], []
    fresh = np.ones(len(linked), bool)
    for start in range(len(linked)):
        if not fresh[start]:
            continue
        fresh[start], front = False, [start]
        while front:
            reached = np.flatnonzero(linked[front].any(axis=0) & fresh)
            fresh[reached] = False
            left += [start] * len(reached)
            right += reached.tolist()
            front = reached.tolist()
    return left, right


def links_within(keys: np.ndarray, bounds: np.ndarray, percent: int) -> tuple[list[int], list[int]]:
    """Spanning links of some sets, by the bits of the shingles that several of them have."""
    size = np.diff(bounds)
    owner = np.repeat(np.arange(len(size)), size)
    _, column, times = np.unique(keys, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times[column] > 1)
    if not len(shared):
        return [], []
    _, column = np.unique(column[shared], return_inverse=True)
    wide = -(-(int(column.max()) + 1) // 64)
    bits = np.zeros((len(size), wide), np.uint64)
    np.bitwise_or.at(bits, (owner[shared], column >> 6), np.uint64(1) << (column & 63).astype(np.uint64))
    linked = np.zeros((len(size), len(size)), bool)
    for i in range(len(size) - 1):
        near = i + 1 + np.flatnonzero((100 * np.minimum(size[i], size[i + 1 :]) >= percent * np.maximum(size[i], size[i + 1 :])) & (size[i] > 0))
        for part in np.array_split(near, 1 + len(near) * wide // (1 << 20)):
            common = np.bitwise_count(bits[part] & bits[i]).sum(axis=1, dtype=np.int64)
            linked[i, part] = 100 * common >= percent * (size[i] + size[part] - common)
    linked |= linked.T
    return spanning(linked)


def exact_links(cells: DataFrame, docs: DataFrame, key: list[str], width: int, percent: int) -> DataFrame:
    """(a, b): spanning links between the texts of each cell; cells: key and doc_id, both distinct."""
    kind = dict(docs.dtypes)["doc_id"]

    def compare(columns: dict, number: np.ndarray) -> pa.RecordBatch:
        ids, texts = columns["doc_id"].to_numpy(), columns["text"]
        left, right = [], []
        edges = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1], [True]]))
        for a, b in zip(edges[:-1], edges[1:]):
            if b - a > 1:
                data = as_bytes(texts.slice(a, b - a).to_pylist())
                parts = [shingles(data[i:j], width) for i, j in blocks([len(t) for t in data], BLOCK)]
                size = np.concatenate([np.diff(p) for _, p in parts])
                x, y = links_within(np.concatenate([k for k, _ in parts]), np.concatenate([[0], np.cumsum(size)]), percent)
                left += ids[a:b][x].tolist()
                right += ids[a:b][y].tolist()
        return pa.record_batch({"a": pa.array(left, columns["doc_id"].type), "b": pa.array(right, columns["doc_id"].type)})

    texts = picked(docs, cells.select("doc_id").distinct())
    rows = cells.join(texts, "doc_id").repartition(*key).sortWithinPartitions(*key)
    return write_and_read(rows.mapInArrow(whole_cells(key, 1, compare), f"a {kind}, b {kind}"), "cells-links")


def star_cells(pairs: DataFrame) -> DataFrame:
    """lead, part, doc_id: the texts of each lead, and the lead itself, in parts of bounded size. pairs: lead, doc_id, n."""
    parts = pairs.groupBy("lead").agg(cuts_of(F.count(F.lit(1)), F.sum("n")).alias("cuts"))
    dealt = pairs.join(parts, "lead").select("lead", F.pmod(F.xxhash64("doc_id"), F.col("cuts")).cast("int").alias("part"), "doc_id")
    dealt = write_and_read(dealt, "cells-dealt")
    return dealt.unionByName(dealt.select("lead", "part", F.col("lead").alias("doc_id")).distinct())


def best_leads(members: DataFrame) -> DataFrame:
    """doc_id, lead: of the leads that a text meets, the one that it meets most often. members: doc_id, lead."""
    met = members.filter("doc_id <> lead").groupBy("doc_id", "lead").agg(F.count(F.lit(1)).alias("times"))
    return met.groupBy("doc_id").agg(F.max_by("lead", F.struct("times", "lead")).alias("lead"))


def spanning_pairs(a: np.ndarray, b: np.ndarray, number: np.ndarray, ids: np.ndarray, kind: pa.DataType) -> pa.RecordBatch:
    """a, b: of the pairs of rows, each of one cell, some that span the same groups; number: each row's cell."""
    order = np.argsort(number[a], kind="stable")
    a, b = a[order], b[order]
    cuts = np.flatnonzero(np.concatenate([[True], number[a][1:] != number[a][:-1], [True]])) if len(a) else [0]
    left, right = [], []
    for i, j in zip(cuts[:-1], cuts[1:]):
        if j - i == 1:
            left.append(ids[a[i]])
            right.append(ids[b[i]])
            continue
        rows, place = np.unique(np.concatenate([a[i:j], b[i:j]]), return_inverse=True)
        near = np.zeros((len(rows), len(rows)), bool)
        near[place[: j - i], place[j - i :]] = True
        x, y = spanning(near | near.T)
        left += ids[rows[x]].tolist()
        right += ids[rows[y]].tolist()
    return pa.record_batch({"a": pa.array(left, kind), "b": pa.array(right, kind)})


def likely_cells(groups: DataFrame, sizes: DataFrame, roots: DataFrame) -> DataFrame:
    """label, i, j, doc_id: cells of the groups (node, root) that likely links make, so that a text is sent out once
    and not once for each cell it was found in. sizes: doc_id, n; roots: components that are known."""
    members = groups.select(F.col("root").alias("label"), F.col("node").alias("doc_id"))
    members = members.unionByName(members.select("label", F.col("label").alias("doc_id"))).distinct()
    sizes = sizes.groupBy("doc_id").agg(F.sum("n").alias("n"))
    return open_cells(members.join(sizes, "doc_id"), roots, "label").select("label", "i", "j", "doc_id")


def cuts_of(count: Column, total: Column) -> Column:
    return F.greatest(F.ceil(count / CELL), F.ceil(total / CELL_SHINGLES)).cast("int")


def open_cells(members: DataFrame, roots: DataFrame, key: str) -> DataFrame:
    """key, i, j, doc_id, root of the cells of buckets (members: key, doc_id, n) that hold several components.

    Buckets of the very same texts are one. Block i of the texts outside the bucket's largest component meets
    block j of them, and block j (counted on) of the largest component."""
    known = members.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    known = write_and_read(known.select(key, "doc_id", "n", "root"), "cells-known")
    per_root = known.groupBy(key, "root").agg(
        F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"),
        F.sum(F.shiftright(F.xxhash64("doc_id"), 33)).alias("_x"), F.sum(F.shiftright(F.xxhash64("doc_id", F.lit(7)), 33)).alias("_y"))
    main = F.struct("c", "root", "s")
    total = per_root.groupBy(key).agg(
        F.count(F.lit(1)).alias("_roots"), F.sum("c").alias("_c"), F.sum("s").alias("_s"), F.max(main).alias("_main"),
        F.sum("_x").alias("_x"), F.sum("_y").alias("_y")).filter("_roots > 1")
    one = total.groupBy("_c", "_x", "_y").agg(F.min_by(F.struct(key, "_s", "_main"), key).alias("_b")).select("_c", "_b.*")
    few = (F.col("_c") <= CELL) & (F.col("_s") <= CELL_SHINGLES)
    chosen = one.select(
        key, F.col("_main.root").alias("_major"), few.alias("_few"),
        cuts_of(F.col("_c") - F.col("_main.c"), F.col("_s") - F.col("_main.s")).alias("minor"),
        cuts_of(F.col("_main.c"), F.col("_main.s")).alias("major"))
    dealt = known.join(chosen, key)
    upto = lambda n, f: F.transform(F.sequence(F.lit(0), n - 1), f)
    at = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    h, minor, major = F.xxhash64("doc_id"), F.col("minor"), F.col("major")
    i = F.pmod(h, minor)
    outside = F.concat(upto(minor, lambda j: at(F.least(i, j), F.greatest(i, j))), upto(major, lambda j: at(i, minor + j)))
    inside = upto(minor, lambda j: at(j, minor + F.pmod(h, major)))
    every = F.when(F.col("_few"), F.array(at(F.lit(0), F.lit(0)))).when(F.col("root") == F.col("_major"), inside).otherwise(outside)
    placed = dealt.select(key, "doc_id", "root", F.explode(every).alias("_c")).select(key, "_c.i", "_c.j", "doc_id", "root")
    return write_and_read(placed, "cells-placed")
