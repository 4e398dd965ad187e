"""Components of texts linked by similar word shingles, by signature trees; exact for components.

A text is the set of its distinct 5-word shingles. Two texts link when 100 x common >= percent x
union. In any order of the shingles that all texts share, linked texts have a shingle in common
among the first n - ceil(percent n / 100) + 1 of each, and k more in common among the first k more; so texts meet in
cells, one for each such shingle that several texts have, and a text that shares too few of its first ones
with any others meets none. Frequent shingles come last in that order.

In a cell texts stand in a signature tree: a leaf is a text's bitmap of hashed shingles and its
size, a node holds its children's bitmaps OR-combined, their range of sizes and components, and the most bits
that a text lost by collision. Two nodes are compared by the largest overlap that any pair below can have;
pairs that cannot reach the threshold, or lie in one component, are dropped with everything below them. The
trees of many cells are walked together, level by level. Texts that the pairs left join to a group meet in one
task and are compared by the sets themselves.

Only components are produced, not all links: pairs already in one component are not looked for. Links are
looked for in two turns. First each text meets the first text of one of its shingles, that which
it shares most of them with; they are compared exactly, without a tree, which settles groups of copies in linear
time. Then all pairs of a cell that lie in two components go through its tree, whatever its size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.cells import BLOCK, best_leads, exact_links, likely_cells, open_cells, picked, spanning_pairs, star_cells, whole_cells, without
from lectern.llm.words import Block, as_bytes, blocks, mix, whole_windows, windows
from lectern.session import cut_lineage, write_and_read

WIDTH = 5
PERCENT = 80
#: Frequent shingles that are ordered last, at most; any list gives right links.
FREQUENT = 1 << 16
#: A shingle is counted where so many texts of one block of texts have it.
OFTEN = 6
#: One shingle in so many stands in a text's prefix beyond the least that linked texts must share one of.
MORE = 10
#: Rows of cells whose trees are built at once, on the whole; bytes of bitmaps that are compared at once.
ROWS, STEP_BYTES = 1 << 12, 8 << 20
LEAST_BITS, MOST_BITS = 64, 1 << 16


# -- sets ------------------------------------------------------------------------


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingles of each text, A-Z lower-cased; of fewer words, the whole
    sequence is one shingle; without words, none."""
    block = Block(texts)
    words = block.hashes(lower=True)
    keys = windows(words, width)
    good = whole_windows(block, width)
    out = []
    for first, n in zip(block.first[:-1], block.counts):
        if n >= width:
            out.append(np.unique(keys[first : first + n - width + 1]))
        elif n:
            out.append(windows(words[first : first + n], n))
        else:
            out.append(np.zeros(0, np.uint64))
    assert good.sum() == sum(max(0, n - width + 1) for n in block.counts)
    return out


def linked(common: int, n: int, m: int, percent: int) -> bool:
    return 100 * common >= percent * (n + m - common)


def in_blocks(pdf: pd.DataFrame, width: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    texts = as_bytes(pdf["text"])
    ids = pdf["doc_id"].to_numpy()
    for a, b in blocks([len(t) for t in texts], BLOCK):
        yield ids[a:b], shingle_sets(texts[a:b], width)


def survey(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n, two halves of the set's digest; frequent shingles of a block on one of its rows. Only
    texts go to Python: beside a null, pandas would hold ids as doubles."""

    @F.pandas_udf("n bigint, d1 bigint, d2 bigint, often array<bigint>, times array<bigint>")
    def run(column: pd.Series) -> pd.DataFrame:
        texts, parts = as_bytes(column), []
        for a, b in blocks([len(t) for t in texts]):
            sets = shingle_sets(texts[a:b], width)
            marks = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            halves = np.frombuffer(b"".join(marks), "<i8").reshape(-1, 2)
            every, count = np.unique(np.concatenate(sets), return_counts=True)
            most = np.flatnonzero(count >= OFTEN)
            most = most[np.argsort(-count[most])[: FREQUENT // 16]]
            rows = pd.DataFrame({"n": [len(s) for s in sets], "d1": halves[:, 0], "d2": halves[:, 1]})
            rows["often"] = [every[most].view(np.int64) if i == 0 else [] for i in range(len(rows))]
            rows["times"] = [count[most] if i == 0 else [] for i in range(len(rows))]
            parts.append(rows)
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({k: [] for k in ("n", "d1", "d2", "often", "times")})

    return docs.select("doc_id", run("text").alias("_s")).select("doc_id", "_s.*")


def prefixes(docs: DataFrame, frequent: np.ndarray, width: int, percent: int) -> DataFrame:
    """token, doc_id, often: the shingles by which a text can meet another. frequent: most frequent first."""
    held = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        order = np.argsort(held.value)
        known, rank = held.value[order], len(order) - order  # the most frequent has the highest rank
        for pdf in batches:
            for ids, sets in in_blocks(pdf, width):
                tokens, owners, often = [], [], []
                for i, s in zip(ids, sets):
                    if not len(s):
                        continue
                    keep = len(s) - -(-percent * len(s) // 100) + 1 + len(s) // MORE
                    at = np.minimum(np.searchsorted(known, s), max(0, len(known) - 1))
                    hot = known[at] == s if len(known) else np.zeros(len(s), bool)
                    if hot.any():
                        s = np.concatenate([s[~hot], s[hot][np.argsort(rank[at[hot]], kind="stable")]])
                    tokens.append(s[:keep])
                    owners.append(np.full(min(keep, len(s)), i))
                    often.append(np.arange(len(tokens[-1])) >= len(s) - hot.sum())
                if tokens:
                    yield pd.DataFrame({"token": np.concatenate(tokens).view(np.int64), "doc_id": np.concatenate(owners), "often": np.concatenate(often)})

    return docs.mapInPandas(run, f"token bigint, doc_id {dict(docs.dtypes)['doc_id']}, often boolean")


# -- components --------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """node, root (smallest node reachable) for every node of the links (a, b): each turn hangs the
    larger neighbours of a node under its smallest one, then does so for the smaller. Sums of
    neighbours are joined back, so no node's neighbours are gathered."""
    edges = cut_lineage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u")
        small = small.select("u", F.col("m").alias("v")).union(small.filter("v <> m").select("v", "m")).distinct()
        edges = cut_lineage(small)
        told = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if tuple(told) == state:
            break
        state = tuple(told)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


# -- the trees ---------------------------------------------------------------------


def width_of(n: int) -> int:
    """Bits of a set of n: a power of two, at least one for each element."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (max(1, n) - 1).bit_length()))


def bitmap(s: np.ndarray) -> bytes:
    bits = np.zeros(width_of(len(s)), np.uint8)
    bits[(mix(s) & np.uint64(len(bits) - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def folded(maps: list[bytes], least: int) -> np.ndarray:
    """Bitmaps as rows of 64-bit words, folded (halves OR-combined) to `least` bytes."""
    return np.stack([np.bitwise_or.reduce(np.frombuffer(m, np.uint64).reshape(-1, least // 8), axis=0) for m in maps])


class Forest:
    """Signature trees of some cells, built and walked together: levels of nodes, two children a node.

    Rows stand by tree; a leaf is a text's bitmap, size and component, a node its children's bitmaps OR-combined,
    their range of sizes, the most bits lost by collision, and the range of components.
    """

    def __init__(self, tree: np.ndarray, sizes: np.ndarray, maps: np.ndarray, roots: np.ndarray):
        lost = sizes - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        self.levels, self.first = [(maps, sizes, sizes, lost, roots, roots)], []
        self.trees = int(tree[-1]) + 1 if len(tree) else 0
        self.looked = 0  # pairs of nodes that were compared
        while (tree[1:] == tree[:-1]).any():
            place = np.arange(len(tree))
            new = np.concatenate([[True], tree[1:] != tree[:-1]])
            at = np.flatnonzero((place - np.maximum.accumulate(np.where(new, place, 0))) % 2 == 0)
            folds = (np.bitwise_or, np.minimum, np.maximum, np.maximum, np.minimum, np.maximum)
            self.levels.append(tuple(f.reduceat(x, at, axis=0) for f, x in zip(folds, self.levels[-1])))
            self.first.append(np.append(at, len(tree)))
            tree = tree[at]

    def possible(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Whether any text below nodes a can link with any of another component below nodes b."""
        maps, low, high, lost, least, most_ = self.levels[level]
        fit = ((least[a] != most_[a]) | (least[b] != most_[b]) | (least[a] != least[b])) & (
            (100 * high[a] >= percent * low[b]) & (100 * high[b] >= percent * low[a]))
        at = np.flatnonzero(fit)
        step = max(64, STEP_BYTES // (8 * maps.shape[1]))
        for k in range(0, len(at), step):
            i = at[k : k + step]
            x, y = a[i], b[i]
            most = np.bitwise_count(maps[x] & maps[y]).sum(axis=1, dtype=np.int64) + np.minimum(lost[x], lost[y])
            if level == 0:  # every bit that the other lacks is a shingle that the other lacks
                lack = [np.bitwise_count(maps[p] & ~maps[q]).sum(axis=1, dtype=np.int64) for p, q in ((x, y), (y, x))]
                most = np.minimum(most, np.minimum(high[x] - lack[0], high[y] - lack[1]))
            most = np.minimum(most, np.minimum(high[x], high[y]))
            fit[i] = (100 + percent) * most >= percent * (low[x] + low[y])  # common >= percent (n + m) / (100 + percent)
        self.looked += len(at)
        return fit

    def pairs(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows of one tree, each once, that the dual traversal from the roots leaves."""
        a = b = np.arange(self.trees)
        for level in range(len(self.levels) - 1, -1, -1):
            keep = self.possible(level, a, b, percent)
            a, b = a[keep], b[keep]
            if level:
                first = self.first[level - 1]
                two_a, two_b = first[a + 1] - first[a] == 2, first[b + 1] - first[b] == 2
                every = [(a, b, 0, 0), (a[two_a], b[two_a], 1, 0), (a[two_b], b[two_b], 0, 1), (a[two_a & two_b], b[two_a & two_b], 1, 1)]
                x = np.concatenate([first[p] + i for p, _, i, _ in every])
                y = np.concatenate([first[q] + j for _, q, _, j in every])
                a, b = x[x <= y], y[x <= y]
        return a, b


def tree_pairs(number: np.ndarray, sizes: np.ndarray, maps: list[bytes], roots: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Pairs of rows of one cell that can link and lie in two components, and how many pairs of nodes were compared.
    number: each row's cell, in order. The rows of one width make a forest; those of two widths whose sizes can link
    make another, folded to the narrower, so that a short text in a cell does not blur the long ones."""
    wide = np.array([len(m) for m in maps])
    cell = np.cumsum(np.concatenate([[False], number[1:] != number[:-1]]))
    _, code = np.unique(roots, return_inverse=True)
    # texts of one component side by side, then by size and bitmap, so that nodes are alike
    _, both, times = np.unique(cell * (len(code) + 1) + code, return_inverse=True, return_counts=True)
    group = np.where(times[both] > 1, code, -1)
    left, right, looked = [], [], 0
    widths = np.unique(wide)
    for u, w in ((u, w) for i, u in enumerate(widths) for w in widths[i:]):
        mine = wide == u
        if u != w:
            near = mine & (100 * sizes >= percent * sizes[wide == w].min())
            far = (wide == w) & (100 * sizes[mine].max() >= percent * sizes)
            mine = (near | far) & np.isin(cell, np.intersect1d(cell[near], cell[far]))
        mine = np.array(sorted(np.flatnonzero(mine), key=lambda i: (cell[i], group[i], sizes[i], maps[i])), np.int64)
        if not len(mine):
            continue
        _, tree = np.unique(cell[mine], return_inverse=True)
        forest = Forest(tree, sizes[mine], folded([maps[i] for i in mine], int(u)), code[mine])
        a, b = (mine[x] for x in forest.pairs(percent))
        across = (wide[a] != wide[b]) | (u == w)
        left.append(a[across])
        right.append(b[across])
        looked += forest.looked
    return np.concatenate(left), np.concatenate(right), looked


CELL_KEY = ["token", "i", "j"]


def likely(cells: DataFrame, percent: int) -> DataFrame:
    """(a, b): of each cell pairs that its tree leaves, which span the groups that all those make. A task takes whole
    cells, many at once."""

    def compare(columns: dict, number: np.ndarray) -> pa.RecordBatch:
        ids, n, roots = (columns[k].to_numpy() for k in ("doc_id", "n", "root"))
        a, b, _ = tree_pairs(number, n, columns["bits"].to_pylist(), roots, percent)
        return spanning_pairs(a, b, number, ids, columns["doc_id"].type)

    rows = cells.repartition(*CELL_KEY).sortWithinPartitions(*CELL_KEY)
    kind = dict(cells.dtypes)["doc_id"]
    return write_and_read(rows.mapInArrow(whole_cells(CELL_KEY, ROWS, compare), f"a {kind}, b {kind}"), "likely")


def sharing(members: DataFrame, percent: int) -> DataFrame:
    """Members (token, doc_id, n) of shingles that several texts have, of texts with enough of them to link:
    two linked texts share 1 + m // MORE of their prefixes, m being the smaller size."""
    several = members.groupBy("token").agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1").select("token")
    members = write_and_read(members.join(several, "token"), "members")
    least = 1 + F.floor(F.ceil(percent * F.col("n") / 100) / MORE)
    enough = members.groupBy("doc_id", "n").agg(F.count(F.lit(1)).alias("_times")).filter(F.col("_times") >= least)
    return members.join(enough.select("doc_id", "n"), ["doc_id", "n"]).select("token", "doc_id", "n")


def bitmaps(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for ids, sets in in_blocks(pdf, width):
                yield pd.DataFrame({"doc_id": ids, "n": [len(s) for s in sets], "bits": [bitmap(s) for s in sets]})

    return docs.mapInPandas(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n bigint, bits binary")


# -- the join ----------------------------------------------------------------------


def link(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row.

    A null or empty text has no shingle and is linked with nothing; a null doc_id cannot be named, so
    its component_id is null and it links nothing. Rows with equal doc_id are one document of several
    texts: what links with one links with all. Equal texts are one set from the start. Any number of
    copies, texts of any length. No rows give no rows; only doc_id and text are read.
    """
    spark, docs = docs.sparkSession, docs.select("doc_id", "text")
    named = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    rows = write_and_read(survey(docs, width), "sets")
    counted = rows.select(F.explode(F.arrays_zip("often", "times")).alias("x")).groupBy("x.often").agg(F.sum("x.times").alias("times"))
    top = [r[0] for r in counted.orderBy(F.desc("times"), "often").limit(FREQUENT).select("often").collect()]
    sets = rows.filter((F.col("n") > 0) & F.col("doc_id").isNotNull()).select("doc_id", "n", "d1", "d2")
    firsts = sets.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("first"))
    copies = write_and_read(sets.join(firsts, ["d1", "d2", "n"]).select("doc_id", "n", "first").distinct(), "set-firsts")

    met = prefixes(named, np.array(top, np.int64).view(np.uint64), width, percent)
    met = met.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("token", F.when(F.col("often"), F.xxhash64("doc_id")))))
    met = write_and_read(met.filter("often OR _n > 1").select("token", "doc_id"), "shared-shingles")
    members = met.join(copies, "doc_id").select("token", F.col("first").alias("doc_id"), "n").distinct()
    for _ in range(2):  # what is dropped leaves others with too few
        members = sharing(members, percent)

    # first turn: each text with the first text of one of its shingles
    members = write_and_read(members, "members")
    leads = members.groupBy("token").agg(F.min(F.struct("doc_id", "n")).alias("lead"), F.count(F.lit(1)).alias("times"))
    fits = (100 * F.col("n") >= percent * F.col("lead.n")) & (100 * F.col("lead.n") >= percent * F.col("n"))
    met = members.join(leads.filter("times > 1"), "token").filter(fits).select("doc_id", "lead.doc_id", "n").toDF("doc_id", "lead", "n")
    met = write_and_read(met, "met-leads")
    sizes = met.groupBy("doc_id").agg(F.max("n").alias("n"))
    stars = write_and_read(best_leads(met).join(sizes, "doc_id"), "stars")
    links = exact_links(star_cells(stars), named, ["lead", "part"], width, percent)
    # second turn: all pairs of a shingle's texts in two components, by the trees
    roots = write_and_read(components(links), "roots")
    dealt = open_cells(members, roots, "token")
    marks = bitmaps(picked(named, dealt.select("doc_id").distinct()), width)
    groups = components(likely(dealt.join(marks, "doc_id"), percent))
    links = links.unionByName(exact_links(likely_cells(groups, copies, roots), named, ["label", "i", "j"], width, percent))
    same = copies.filter("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    roots = write_and_read(components(links.union(same)), "roots").withColumnRenamed("node", "doc_id")
    return rows.select("doc_id", "n").join(roots, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, with all their columns, without those that link to a smaller doc_id. Rows
    that share a doc_id are one document and stay or go together; rows with a null doc_id stay."""
    found = link(docs, width, percent)
    return without(docs, write_and_read(found.filter("component_id <> doc_id").select("doc_id").distinct(), "near-copies"))
