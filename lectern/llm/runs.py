"""Periodic runs of words, found on a Re-Pair grammar of the word ids.

Re-Pair goes in rounds: all texts of a block count their pairs of neighbouring symbols at once, and a
pair that occurs twice or more becomes a new symbol wherever it is more frequent than the pairs that
overlap it there; so the most frequent pair of every text is replaced in each round. What no rule
joins any more is the text's last sequence.

A run lies within the shortest symbol that holds it and crosses the place where the two halves of
that symbol meet; so the runs across that place are computed once for each nonterminal, at its first
occurrence, and within its expansion. They are carried to every place where the derivation has the
symbol, next to the runs across the joints of the last sequence, and of intervals of one period only
those that no other holds are maximal and stay.

Runs of period q across a place p: of the 3 q words at least half lie on one side, so that a stretch of
max(12 - q, q / 2) words beside p occurs again q words away. Periods fall in classes from 2^j to
2^(j+1) - 1; equal stretches of a class's length are looked up in sorted order, within that distance,
and each is extended both ways by prefix hashes. Intervals are compared word by word in the end; if
a hash misled, that text is searched period by period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.words import Block, as_bytes, blocks, mix

#: A run has so many words and so many periods at least.
LEAST_WORDS, LEAST_PERIODS = 24, 3
BLOCK = 1 << 20
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_BASE = 0x9E3779B97F4A7C55


def long_enough(length: np.ndarray, period: np.ndarray) -> np.ndarray:
    return length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)


# -- the grammar -------------------------------------------------------------------


class Grammar:
    """Re-Pair of a sequence of ids; texts in it share no id.

    starts: where the symbols of the last sequence begin. Per occurrence of a nonterminal in the
    derivation: symbol and begin. Per nonterminal, at its first occurrence: begin, middle, end.
    """

    def __init__(self, ids: np.ndarray):
        symbols, starts, size = ids.astype(np.int64), np.arange(len(ids)), len(ids)
        fresh = int(ids.max()) + 1 if size else 0
        first, occurrences, self.rounds = [], [], 0
        while len(symbols) > 1:
            chosen, names = self.choose(symbols)
            if not len(chosen):
                break
            self.rounds += 1
            ends = np.append(starts[1:], size)
            _, at, names = np.unique(names, return_index=True, return_inverse=True)
            where = chosen[at]
            first.append(np.stack([starts[where], starts[where + 1], ends[where + 1]]))
            occurrences.append(np.stack([names + sum(f.shape[1] for f in first[:-1]), starts[chosen]]))
            symbols[chosen] = fresh + names
            fresh += len(at)
            stay = np.ones(len(symbols), bool)
            stay[chosen + 1] = False
            symbols, starts = symbols[stay], starts[stay]
        self.starts = starts
        self.begin, self.middle, self.end = np.concatenate(first, axis=1) if first else np.zeros((3, 0), np.int64)
        self.symbol, self.at = np.concatenate(occurrences, axis=1) if occurrences else np.zeros((2, 0), np.int64)

    @staticmethod
    def choose(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places whose pair is replaced in this round, and the pair's number."""
        pair = symbols[:-1] * (int(symbols.max()) + 1) + symbols[1:]
        at = np.arange(len(pair))
        new = np.concatenate([[True], pair[1:] != pair[:-1]])
        even = (at - np.maximum.accumulate(np.where(new, at, 0))) % 2 == 0  # x x x holds one pair x x, not two
        _, name, times = np.unique(pair[even], return_inverse=True, return_counts=True)
        rank = np.zeros(len(pair) + 2, np.int64)
        rank[1:-1][even] = np.where(times > 1, times * (len(times) + 1) + np.arange(len(times), 0, -1), 0)[name]
        mine = rank[1:-1]
        best = (mine > 0) & (mine > rank[:-2]) & (mine > rank[2:])
        number = np.zeros(len(pair), np.int64)
        number[even] = name
        often = np.bincount(number[best], minlength=len(times)) > 1
        chosen = np.flatnonzero(best & often[number])
        return chosen, number[chosen]


# -- equal stretches ---------------------------------------------------------------


class Prefixes:
    """Hashes of all stretches of a sequence of 64-bit words."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        powers = np.full(n + 1, _BASE, np.uint64)
        powers[0] = 1
        self.powers = np.cumprod(powers)
        back = np.full(n + 1, pow(_BASE, -1, 1 << 64), np.uint64)
        back[0] = 1
        self.back = np.cumprod(back)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self.powers[:n])])

    def stretches(self, width: int) -> np.ndarray:
        """Hash of the stretch of `width` words from each place on."""
        return (self.sums[width:] - self.sums[:-width]) * self.back[: len(self.sums) - width]

    def equal(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (self.sums[i + n] - self.sums[i]) * self.powers[j - i] == self.sums[j + n] - self.sums[j]

    def common(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, forward: bool) -> np.ndarray:
        """Words that agree from i and j on (before i and j), `most` at most; i < j. Never fewer than do."""
        low, high = np.zeros(len(i), np.int64), np.maximum(most, 0)
        while (low < high).any():
            n = (low + high + 1) // 2
            same = self.equal(i, j, n) if forward else self.equal(i - n, j - n, n)
            low, high = np.where(same, n, low), np.where(same, high, n - 1)
        return low


def spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from low to high - 1 of each row, and the row of each."""
    count = np.maximum(high - low, 0)
    row = np.repeat(np.arange(len(low)), count)
    return np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(len(row)), row


def crossing(hashes: Prefixes, size: int, place: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start, end, period) of the long enough intervals within begin..end that reach across place."""
    found, j = [], 0
    longest = int((end - begin).max()) if len(place) else 0
    while LEAST_PERIODS << j <= longest:
        low_q, high_q = 1 << j, (2 << j) - 1
        j += 1
        qs = np.arange(low_q, min(high_q, LEAST_WORDS) + 1)
        width = int(np.maximum(LEAST_WORDS // 2 - qs, -(-qs // 2)).min()) if len(qs) else low_q // 2
        if width > size:
            continue
        grams = hashes.stretches(width)
        order = np.argsort(grams, kind="stable")
        group = np.empty(len(grams), np.int64)
        group[order] = np.cumsum(np.concatenate([[False], grams[order][1:] != grams[order][:-1]]))
        keys, wide = group[order] * (size + 1) + order, size + 1
        # to the right: the words from place on occur again; to the left: those before it occurred
        ahead = np.flatnonzero(place + low_q + width <= end)
        p, e = place[ahead], end[ahead]
        base = group[p] * wide
        at, row = spread(np.searchsorted(keys, base + p + low_q), np.searchsorted(keys, base + np.minimum(p + high_q, e - width), "right"))
        left, row_ahead, period = p[row], ahead[row], order[at] - p[row]
        behind = np.flatnonzero(place - width - low_q >= begin)
        s, b = place[behind] - width, begin[behind]
        base = group[s] * wide
        at, row = spread(np.searchsorted(keys, base + np.maximum(s - high_q, b)), np.searchsorted(keys, base + s - low_q, "right"))
        left = np.concatenate([left, order[at]])
        rows = np.concatenate([row_ahead, behind[row]])
        period = np.concatenate([period, s[row] - order[at]])
        fore = hashes.common(left, left + period, end[rows] - left - period, True)
        back = hashes.common(left, left + period, left - begin[rows], False)
        start, stop = left - back, left + period + fore
        good = long_enough(stop - start, period)
        found.append(np.stack([x[good] for x in (rows, start, stop, period)]))
    return tuple(np.concatenate(found, axis=1)) if found else tuple(np.zeros((4, 0), np.int64))


# -- runs --------------------------------------------------------------------------


def maximal(text: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Intervals of one text and period that no other holds; of equal ones that of the smallest period."""
    order = np.lexsort((-end, start, period, text))
    t, s, e, q = (x[order] for x in (text, start, end, period))
    group = np.cumsum(np.concatenate([[False], (t[1:] != t[:-1]) | (q[1:] != q[:-1])])) if len(t) else t
    reach = np.maximum.accumulate(group * (int(e.max(initial=0)) + 1) + e)
    new = np.concatenate([[True], reach[1:] > reach[:-1]])[: len(t)]
    t, s, e, q = (x[new] for x in (t, s, e, q))
    order = np.lexsort((q, e, s))
    t, s, e, q = (x[order] for x in (t, s, e, q))
    first = np.concatenate([[True], (s[1:] != s[:-1]) | (e[1:] != e[:-1])])[: len(t)]
    t, s, e, q = (x[first] for x in (t, s, e, q))
    order = np.lexsort((q, s))
    return tuple(x[order] for x in (t, s, e, q))


def truthful(words: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether words a period apart are equal all through each interval."""
    out = np.ones(len(start), bool)
    for i, (s, e, q) in enumerate(zip(start, end, period)):
        out[i] = np.array_equal(words[s : e - q], words[s + q : e])
    return out


def by_period(words: np.ndarray, offset: int) -> np.ndarray:
    """start, end, period of the runs of one text, each period in turn."""
    found = []
    for q in range(1, len(words) // LEAST_PERIODS + 1):
        same = np.concatenate([[False], words[q:] == words[:-q], [False]])
        edges = np.flatnonzero(np.diff(same.view(np.int8)))
        start, end = edges[::2], edges[1::2] + q
        good = long_enough(end - start, np.int64(q))
        found.append(np.stack([start[good] + offset, end[good] + offset, np.full(good.sum(), q)]))
    return np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)


def runs_of(keys: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, end, period) of all runs, by start and period. keys: 64 bits for each word, of which
    different texts share none; text t has the words bounds[t] to bounds[t + 1] - 1.

    A run holds two equal stretches of 16 words, so texts without such a pair are left out first.
    """
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    none = tuple(np.zeros((4, 0), np.int64))
    twice = LEAST_WORDS - LEAST_WORDS // LEAST_PERIODS
    if len(keys) <= twice:
        return none
    grams = Prefixes(keys).stretches(twice)
    order = np.argsort(grams, kind="stable")
    again = order[1:][grams[order][1:] == grams[order][:-1]]
    wanted = np.zeros(len(bounds) - 1, bool)
    wanted[text[again]] = True
    place = np.flatnonzero(wanted[text])  # where the words that stay stood
    if not len(place):
        return none
    words, owner = keys[place], text[place]
    begin = np.searchsorted(owner, np.arange(len(bounds)))
    _, ids = np.unique(words, return_inverse=True)
    grammar, hashes = Grammar(ids), Prefixes(words)

    joints = grammar.starts[1:][owner[grammar.starts[1:]] == owner[grammar.starts[1:] - 1]]
    rule, s, e, q = crossing(hashes, len(words), np.concatenate([grammar.middle, joints]),
                             np.concatenate([grammar.begin, begin[owner[joints]]]),
                             np.concatenate([grammar.end, begin[owner[joints] + 1]]))
    inner = rule < len(grammar.begin)
    # to all places of the derivation that have the symbol
    order = np.argsort(grammar.symbol, kind="stable")
    symbols, places = grammar.symbol[order], grammar.at[order]
    mine = rule[inner]
    at, row = spread(np.searchsorted(symbols, mine), np.searchsorted(symbols, mine, "right"))
    shift = places[at] - grammar.begin[mine[row]]
    start = np.concatenate([s[~inner], s[inner][row] + shift])
    end = np.concatenate([e[~inner], e[inner][row] + shift])
    period = np.concatenate([q[~inner], q[inner][row]])
    t, start, end, period = maximal(owner[start], start, end, period)

    bad = np.unique(t[~truthful(words, start, end, period)])
    if len(bad):
        stay = ~np.isin(t, bad)
        again = np.concatenate([by_period(words[begin[b] : begin[b + 1]], begin[b]) for b in bad], axis=1)
        start, end, period = (np.concatenate([x[stay], y]) for x, y in zip((start, end, period), again))
        t, start, end, period = maximal(owner[start], start, end, period)
    return t, place[start], place[end - 1] + 1, period


def kept(n: int, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Of n words those that no run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    return np.cumsum(change[:n]) == 0


def in_texts(texts: list[bytes]) -> Iterator[tuple[list[tuple[int, int, int]], str]]:
    """Runs (start, length, period) of each text, and its words without the repeats, one space between."""
    for a, b in blocks([len(t) for t in texts], BLOCK):
        block = Block(texts[a:b])
        keys = mix(block.hashes() ^ mix(block.doc.astype(np.uint64) + np.uint64(1)))
        text, start, end, period = runs_of(keys, block.first)
        upto = np.searchsorted(text, np.arange(b - a + 1))
        for i in range(b - a):
            words, mine = texts[a + i].split(), slice(upto[i], upto[i + 1])
            s, e, q = start[mine] - block.first[i], end[mine] - block.first[i], period[mine]
            if len(s):
                words = [words[k] for k in np.flatnonzero(kept(len(words), s, e, q))]
            yield list(zip(s.tolist(), (e - s).tolist(), q.tolist())), b" ".join(words).decode("utf-8", "surrogatepass")


def found(text: Column) -> Column:
    """struct(runs, collapsed) of a text: its runs in words by start and period, and the text without
    the words that a run holds after its first period, words joined by one space."""

    @F.pandas_udf(f"runs {RUNS}, collapsed string")
    def search(texts: pd.Series) -> pd.DataFrame:
        rows = list(in_texts(as_bytes(texts)))
        return pd.DataFrame({"runs": [[{"start": s, "length": n, "period": q} for s, n, q in r] for r, _ in rows],
                             "collapsed": [c for _, c in rows]})

    return search(text)


def collapse(docs: DataFrame) -> DataFrame:
    """The rows of docs with `runs` and `collapsed` in place of columns of those names.

    Words are told apart by 64-bit hashes. A null or empty text, and one without words, has no runs and
    an empty collapsed text. Texts of any length are searched whole; rows stay where they are, and only
    texts pass through Python, so ids and other columns keep their values. No rows give no rows.
    """
    return docs.withColumn("_found", found(F.col("text"))).withColumns(
        {"runs": F.col("_found.runs"), "collapsed": F.col("_found.collapsed")}).drop("_found")
