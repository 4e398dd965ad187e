"""Benchmark passages in documents: one Aho-Corasick automaton, one scan of each text.

Items and texts are normalised alike: A-Z to lower case, words joined by one space. A window
of `width` words of an item, a space at either end, is a pattern of the automaton, so every
match is at word bounds. Words keep their place in the original text, and a match gives back
the original characters from its first word to its last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.words import LEADS, as_bytes
from lectern.session import write_and_read

WIDTH = 10
#: Windows that one automaton holds at most; more are scanned in several passes over the texts.
PATTERNS = 200_000

_byte = np.arange(256)
_lower = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte)
_wordy = ((_lower >= 48) & (_lower <= 57)) | ((_lower >= 97) & (_lower <= 122)) | (_lower >= 128)
FOLD = bytes(np.where(_wordy, _lower, 32).astype(np.uint8))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def patterns_of(text: bytes, width: int) -> list[str]:
    """Each window of an item once; an item of fewer words, but not none, is one window."""
    words = [w.decode("utf-8", "surrogatepass") for w in words_of(text)]
    if not words:
        return []
    last = max(1, len(words) - width + 1)
    return list(dict.fromkeys(f" {' '.join(words[i : i + width])} " for i in range(last)))


def windows_of(items: DataFrame, width: int) -> DataFrame:
    """pattern, item: the ids (as strings) of the items that have each window. Null ids and texts have none."""

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([patterns_of(t, width) for t in as_bytes(texts)])

    named = items.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    cut_up = named.select(F.col("item_id").cast("string").alias("item"), F.explode(cut("text")).alias("pattern"))
    return cut_up.groupBy("pattern").agg(F.collect_set("item").alias("items"))


class Scanner:
    """One automaton over some windows."""

    def __init__(self, windows: list[tuple[str, list[str]]]):
        self.found = ahocorasick.Automaton()
        for pattern, items in windows:
            self.found.add_word(pattern, (len(pattern), pattern.count(" ") - 1, items))
        if windows:
            self.found.make_automaton()
        self.empty = not windows

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, merged ranges of word numbers that are hit, items found."""
        words = words_of(text)
        if self.empty or not words:
            return len(words), [], set()
        flat = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
        ranges, items = [], set()
        seen_to, seen_words = 0, 0  # words are counted on from the last match only
        for end, (length, count, names) in self.found.iter(flat):
            seen_words += flat.count(" ", seen_to, end)
            seen_to = end
            items.update(names)
            if ranges and seen_words - count <= ranges[-1][1]:
                while ranges and seen_words - count <= ranges[-1][0]:
                    ranges.pop()
                if ranges and seen_words - count <= ranges[-1][1]:
                    ranges[-1] = (ranges[-1][0], seen_words)
                    continue
            ranges.append((seen_words - count, seen_words))
        return len(words), ranges, items


def original(text: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code point spans of the original text under ranges of its words."""
    if not ranges:
        return []
    data = np.frombuffer(text, np.uint8)
    inside = np.concatenate([[False], _wordy[data], [False]])
    edges = np.flatnonzero(np.diff(inside.view(np.int8)))
    points = np.concatenate([[0], np.cumsum(LEADS[data])])
    return [(int(points[edges[2 * a]]), int(points[edges[2 * b - 1]])) for a, b in ranges]


def scan(docs: DataFrame, windows: list[tuple[str, list[str]]]) -> DataFrame:
    """Columns of docs but text, n_words, ranges (of word numbers), spans (code points), items. Only
    texts go to Python: beside a null, pandas would hold ids as doubles."""
    held = docs.sparkSession.sparkContext.broadcast(windows)
    span = "array<struct<begin: bigint, end: bigint>>"

    @F.pandas_udf(f"n_words bigint, ranges {span}, spans {span}, items array<string>")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(held.value)
        as_struct = lambda xs: [{"begin": a, "end": b} for a, b in xs]
        for column in series:
            rows = []
            for text in as_bytes(column):
                n, ranges, items = scanner.scan(text)
                rows.append((n, as_struct(ranges), as_struct(original(text, ranges)), sorted(items)))
            yield pd.DataFrame(rows, columns=["n_words", "ranges", "spans", "items"])

    rest = [k for k in docs.columns if k != "text"]
    return docs.select(*rest, run("text").alias("_s")).select(*rest, "_s.*")


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, most: int = PATTERNS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans for every row of docs.

    Null and empty texts have no words and no hit; repeated items count once; rows with equal
    doc_id get a row each. Documents stay in their partitions. Windows go to all tasks while
    they number `most` at the most; beyond that they are cut into parts by a hash, the
    texts are scanned once per part, and what the parts find is put together per row.
    """
    windows = write_and_read(windows_of(items, width), "bench-windows")
    parts = max(1, -(-windows.count() // most))
    if parts == 1:
        found = scan(docs.select("doc_id", "text"), [tuple(r) for r in windows.collect()])
        return report(found)
    rows = write_and_read(docs.select(F.col("doc_id"), "text", F.expr("uuid()").alias("_row")), "bench-rows")
    found = None
    for part in range(2 * parts):  # half full on average, so that none overflows by chance
        mine = windows.filter(F.pmod(F.xxhash64("pattern"), F.lit(2 * parts)) == part).collect()
        one = write_and_read(scan(rows, [tuple(r) for r in mine]), "bench-part")
        found = one if found is None else found.unionByName(one)
    return report(found.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("ranges")).alias("ranges"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))


def free_of(windows: list[tuple[str, list[str]]], docs: DataFrame):
    """A function of a text: whether none of the windows occurs in it. Texts stay in the JVM."""
    held = docs.sparkSession.sparkContext.broadcast(windows)

    @F.pandas_udf("boolean")
    def clean(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(held.value)
        for column in series:
            yield pd.Series([not scanner.scan(t)[1] for t in as_bytes(column)], dtype=bool)

    return clean


def keep_clean(docs: DataFrame, items: DataFrame, width: int = WIDTH, most: int = PATTERNS) -> DataFrame:
    """The rows of docs, with all their columns, in which no window occurs; one scan of the texts for
    each `most` windows."""
    windows = write_and_read(windows_of(items, width), "bench-windows")
    n = windows.count()
    parts = 1 if n <= most else 2 * -(-n // most)
    for part in range(parts):
        mine = windows.filter(F.pmod(F.xxhash64("pattern"), F.lit(parts)) == part).collect()
        docs = docs.filter(free_of([tuple(r) for r in mine], docs)("text"))
        if part + 1 < parts:
            docs = write_and_read(docs, "bench-clean")
    return docs


def covered(ranges: Column) -> Column:
    """Words under ranges that may overlap."""
    return F.aggregate(
        F.array_sort(ranges),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("upto")),
        lambda a, r: F.struct(
            (a["n"] + F.greatest(F.lit(0), r["end"] - F.greatest(a["upto"], r["begin"]))).alias("n"),
            F.greatest(a["upto"], r["end"]).alias("upto")),
        lambda a: a["n"])


def report(found: DataFrame) -> DataFrame:
    hit = found.withColumn("n_hit", covered(F.col("ranges")))
    return hit.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "spans")
