"""Near copies by MinHash: minima of many universal hashes, bands, signatures, exact sets, star contraction.

A text is the set of its distinct 5-word shingles. 128 functions h(x) = (a x + b mod 2^64) >> 32 with a odd
give 128 minima; two texts agree in each with the probability of their Jaccard similarity J. Four minima
are a band, and texts with an equal band share a bucket: a pair of J = 0.85 shares none of 32 with probability
6e-11. One byte of each minimum is the signature; a pair is compared by its full sets if signatures agree
in at least 80 of 128 places, which a pair of J = 0.85 misses with probability below 1e-10.

Equal sets are one text from the start. Then, in two turns:

* every text meets the smallest text of one of its buckets, the one it shares most buckets with;
* in buckets that still hold several components, all pairs from different components are compared by
  signature. A large bucket is cut into blocks; its largest component is set against the other texts
  only, not against itself. Texts that likely links join meet in one task and are compared exactly.

Links are contracted by alternating large-star and small-star.
"""

from __future__ import annotations

from math import sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.cells import BLOCK, best_leads, exact_links, likely_cells, open_cells, shingles, spanning_pairs, star_cells, whole_cells, without
from lectern.llm.words import as_bytes, blocks, mix, stream
from lectern.session import write_and_read

WIDTH, PERCENT = 5, 85
BANDS, ROWS = 32, 4
#: Rows of cells whose signatures are compared at once.
STEP = 1 << 12


# -- sets and signatures -----------------------------------------------------------


def minima(keys: np.ndarray, bounds: np.ndarray, count: int) -> np.ndarray:
    """Minimum of each universal hash over each set that is not empty: one row per set."""
    filled = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(filled), count), np.uint64)
    for k, (a, b) in enumerate(zip(stream(count, 31), stream(count, 37))):
        out[:, k] = np.minimum.reduceat((keys * a + b) >> np.uint64(32), filled)
    return out


def features(text: Column, width: int, bands: int, rows: int) -> Column:
    """struct(n, d1, d2, sig, bands): size, digest, signature and band names of a text's set; null without words."""

    @F.pandas_udf("n bigint, d1 bigint, d2 bigint, sig binary, bands array<bigint>")
    def compute(texts: pd.Series) -> pd.DataFrame:
        data, parts = as_bytes(texts), []
        for i, j in blocks([len(t) for t in data], BLOCK):
            keys, bounds = shingles(data[i:j], width)
            n = np.diff(bounds)
            digests, sig, names = np.zeros((2, len(n)), np.int64), [None] * len(n), [None] * len(n)
            if len(keys):
                filled = np.flatnonzero(n)
                for k, factor in enumerate(stream(2, 5)):
                    digests[k, filled] = mix(np.add.reduceat(mix(keys * factor), bounds[filled])).view(np.int64)
                low = minima(keys, bounds, bands * rows)
                grouped = mix(low + stream(bands * rows, 41)).reshape(len(low), bands, rows).sum(axis=2)
                bucket = mix(grouped + stream(bands, 43)).view(np.int64)
                for at, bytes_, row in zip(filled, (low & np.uint64(255)).astype(np.uint8), bucket):
                    sig[at], names[at] = bytes_.tobytes(), row
            out = pd.DataFrame({"n": n, "d1": digests[0], "d2": digests[1], "sig": sig, "bands": names})
            parts.append(out)
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({k: [] for k in ("n", "d1", "d2", "sig", "bands")})

    return compute(text)


def least_agreement(places: int, percent: int) -> int:
    """Seven standard deviations below what a pair at the threshold agrees in."""
    share = percent / 100
    return max(0, int(places * share - 7 * sqrt(places * share * (1 - share))))


# -- signatures in cells -------------------------------------------------------------


def likely(cells: DataFrame, key: list[str], least: int, percent: int, kind: str) -> DataFrame:
    """(a, b): of each cell pairs that may link and lie in two components, by size and signature; they span the groups
    that all such pairs make."""

    def compare(columns: dict, number: np.ndarray) -> pa.RecordBatch:
        ids, n, roots = (columns[k].to_numpy() for k in ("doc_id", "n", "root"))
        sig = np.frombuffer(b"".join(columns["sig"].to_pylist()), np.uint8).reshape(len(ids), -1)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in range(1, int(np.bincount(number).max())):
            a = np.flatnonzero((number[k:] == number[:-k]) & (roots[k:] != roots[:-k])
                               & (100 * np.minimum(n[k:], n[:-k]) >= percent * np.maximum(n[k:], n[:-k])))
            for part in np.array_split(a, 1 + len(a) // STEP):
                left.append(part[(sig[part] == sig[part + k]).sum(axis=1) >= least])
                right.append(left[-1] + k)
        return spanning_pairs(np.concatenate(left), np.concatenate(right), number, ids, columns["doc_id"].type)

    rows = cells.repartition(*key).sortWithinPartitions(*key)
    return write_and_read(rows.mapInArrow(whole_cells(key, STEP, compare), f"a {kind}, b {kind}"), "minhash-likely")


# -- components --------------------------------------------------------------------


def contracted(links: DataFrame) -> DataFrame:
    """node, root (the smallest node it reaches) of all nodes of the links (a, b).

    Large-star hangs every larger neighbour of a node under the smallest of its neighbourhood, small-star
    the smaller ones; they alternate until nothing changes. Minima are joined to the edges again, so no
    node's neighbours are gathered.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges, told = write_and_read(edges, "minhash-edges"), None
    while True:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = around.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = write_and_read(large, "minhash-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("u", "v", "m")
        small = small.select("u", F.col("m").alias("v")).unionByName(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = write_and_read(small.distinct(), "minhash-edges")
        now = tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u, 3))")).first())
        if now == told:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        told = now


# -- the operator ------------------------------------------------------------------


def likely_stars(members: DataFrame, marks: DataFrame, percent: int, least: int) -> DataFrame:
    """lead, doc_id, n: every text with its best lead, if sizes and signatures allow."""
    mine = marks.join(best_leads(members), "doc_id").join(
        marks.select(F.col("doc_id").alias("lead"), F.col("n").alias("_n"), F.col("sig").alias("_sig")), "lead")

    @F.pandas_udf("boolean")
    def agree(one: pd.Series, two: pd.Series) -> pd.Series:
        x, y = (np.frombuffer(b"".join(s), np.uint8).reshape(len(s), -1) for s in (one, two))
        return pd.Series((x == y).sum(axis=1) >= least)

    fits = (100 * F.least("n", "_n") >= percent * F.greatest("n", "_n")) & agree("sig", "_sig")
    return write_and_read(mine.filter(fits).select("lead", "doc_id", "n").distinct(), "minhash-stars")


def link(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (doc_id is its component's smallest) for every row.

    Two texts link when 100 x common >= percent x union of their shingles, compared as 64-bit hashes. A
    link is found unless bands or signatures fail it, which at the threshold has probability
    (1 - J^rows)^bands, here 6e-11, and below 1e-10; a chain of other links may still join the two.
    A null or empty text has no shingle and links with nothing; a null doc_id cannot be named: its component_id
    is null and it is kept. Rows with equal doc_id are one document of several texts. Any number of
    copies, texts of any length. No rows give no rows; only doc_id and text are read.
    """
    docs = docs.select("doc_id", "text")
    kind = dict(docs.dtypes)["doc_id"]
    named = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    sets = write_and_read(docs.select("doc_id", features(F.col("text"), width, bands, rows).alias("f")).select("doc_id", "f.*"), "minhash-sets")
    full = sets.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    firsts = full.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("first"))
    copies = write_and_read(full.select("doc_id", "d1", "d2", "n").join(firsts, ["d1", "d2", "n"]), "minhash-firsts")
    firsts = write_and_read(firsts, "minhash-leads").withColumnRenamed("first", "doc_id")
    marks = write_and_read(full.select("doc_id", "d1", "d2", "n", "sig", "bands").join(firsts, ["doc_id", "d1", "d2", "n"]).dropDuplicates(
        ["doc_id", "d1", "d2", "n"]), "minhash-marks")
    named_bands = marks.select("doc_id", "n", F.explode("bands").alias("band"))
    leads = named_bands.groupBy("band").agg(F.min("doc_id").alias("lead"), F.max("doc_id").alias("_last")).filter("lead <> _last")
    members = write_and_read(named_bands.join(leads.select("band", "lead"), "band"), "minhash-members")
    marks, least = marks.select("doc_id", "n", "sig"), least_agreement(bands * rows, percent)

    stars = likely_stars(members, marks, percent, least)
    links = exact_links(star_cells(stars), named, ["lead", "part"], width, percent)
    roots = contracted(links)
    dealt = open_cells(members.select("band", "doc_id", "n"), roots, "band").join(marks, "doc_id")
    groups = contracted(likely(dealt, ["band", "i", "j"], least, percent, kind))
    links = links.unionByName(exact_links(likely_cells(groups, marks, roots), named, ["label", "i", "j"], width, percent))
    same = copies.filter("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    roots = contracted(links.unionByName(same)).withColumnRenamed("node", "doc_id")
    found = sets.select("doc_id", F.col("n").alias("n_shingles")).join(roots, "doc_id", "left")
    found = found.select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, with all their columns, of the documents that link keeps."""
    return without(docs, write_and_read(link(docs, width, percent).filter("NOT kept").select("doc_id").distinct(), "minhash-copies"))
