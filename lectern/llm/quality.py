"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule says good (1), bad (0) or nothing (-1) about a text. With the votes independent given
the quality, EM estimates each rule's accuracy on either class and the share of good texts
from the counts of vote patterns alone; there are at most 3^rules patterns, counted over all
rows. A prior belief about the rules counts as much as a fixed part of the rows, at any size, so
that one frequent kind of bad text does not make the rules for rarer kinds look wrong. A text is kept when the posterior probability of good reaches the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.words import IN_WORD, LEADS, Block, as_bytes, blocks, mix, stream, whole_windows, windows
from lectern.session import write_and_read

WIDTH = 5
#: Bytes of texts that are measured at once.
BYTES = 1 << 20
MIN_WORDS = 10
REPEAT_PERCENT = 20
THRESHOLD = 0.5
ROUNDS = 100
BELIEF = 0.5
SPACE = "\x20\t\n\x0b\x0c\r"

_byte = np.arange(256)
SYMBOLS = np.isin(_byte, list(b"#*$%&|<>"))
UPPER = (_byte >= 65) & (_byte <= 90)
LETTERS = UPPER | ((_byte >= 97) & (_byte <= 122)) | (_byte >= 0xC0)
BARS = np.isin(_byte, list(b"|<>"))
MARKS = np.isin(_byte, list(b"!?"))
STOPS = np.isin(_byte, list(b".!?"))

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Votes bad beyond so many per cent of the base, else not at all: a text free of one fault may have another.
FAULTS = (
    ("symbols", "n_symbols", "n_words", 10),
    ("bars", "n_bars", "n_words", 15),
    ("repeats", "n_repeat_words", "n_words", 20),
    ("lines", "n_dup_lines", "n_lines", 20),
    ("capitals", "n_upper", "n_letters", 40),
    ("marks", "n_marks", "n_words", 15),
    ("other", "n_other", "word_chars", 20),
)
#: Votes good within the inner range, bad outside the outer one, as a ratio to the base or a count.
RANGES = (
    ("sentences", "n_stops", "n_words", (0.03, 0.4), (0.004, 1.0)),
    ("word_size", "word_chars", "n_words", (3, 10), (2, 15)),
    ("length", "n_words", None, (40, np.inf), (12, np.inf)),
)
RULES = (*FAULTS, *RANGES)
#: Prior chances of (no vote, bad, good) that a fault and a range rule give to bad and to good texts.
PRIOR = {"fault": ((0.75, 0.25, 0.0), (0.997, 0.003, 0.0)), "range": ((0.3, 0.2, 0.5), (0.19, 0.01, 0.8))}
GOOD_SHARE = 0.8


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Counts for each text of a block."""
    block = Block(texts)
    data = block.data
    out = {
        "n_words": block.counts,
        "word_chars": block.per_text((IN_WORD & LEADS)[data]),
        "n_symbols": block.per_text(SYMBOLS[data]),
        "n_bars": block.per_text(BARS[data]),
        "n_upper": block.per_text(UPPER[data]),
        "n_letters": block.per_text(LETTERS[data]),
        "n_marks": block.per_text(MARKS[data]),
        "n_stops": block.per_text(STOPS[data]),
    }
    keys = windows(block.hashes(), WIDTH)
    keys = keys + mix(block.doc[: len(keys)].astype(np.uint64) + stream(1, 5))  # windows of one text only meet
    at = np.flatnonzero(whole_windows(block, WIDTH))
    order = at[np.argsort(keys[at])]
    same = keys[order][1:] == keys[order][:-1]
    twice = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])] if len(order) else order
    cover = np.zeros(len(block.doc) + WIDTH + 1, np.int64)
    cover[twice] += 1  # each index once
    cover[twice + WIDTH] -= 1
    covered = np.cumsum(cover)[: len(block.doc)] > 0
    out["n_repeat_words"] = np.diff(np.concatenate([[0], np.cumsum(covered)])[block.first])
    return out


def lines_of(text: str) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return len(lines), len(lines) - len(set(lines))


def votes(f: dict[str, np.ndarray]) -> list[np.ndarray]:
    """Of each rule: 1 good, 0 bad, -1 nothing. A text without words gets no vote."""
    f = f | {"n_other": f["word_chars"] - f["n_letters"]}
    out = [np.where(100 * f[key] > most * np.maximum(1, f[base]), 0, -1) for _, key, base, most in FAULTS]
    for _, key, base, (low, high), (least, most) in RANGES:
        x = f[key] / np.maximum(1, f[base]) if base else f[key]
        out.append(np.where((x >= low) & (x <= high), 1, np.where((x < least) | (x > most), 0, -1)))
    return [np.where(f["n_words"] > 0, vote, -1) for vote in out]


def score_texts(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Counts and vote pattern of each text."""
    for column in series:
        texts = as_bytes(column)
        lines = np.array([lines_of(t) if isinstance(t, str) else (0, 0) for t in column], np.int64).reshape(-1, 2)
        parts = []
        for begin, end in blocks([len(t) for t in texts], BYTES):
            f = measure(texts[begin:end])
            f["n_lines"], f["n_dup_lines"] = lines[begin:end].T
            pattern = np.zeros(end - begin, np.int64)
            for vote in votes(f):
                pattern = pattern * 3 + vote + 1
            parts.append(pd.DataFrame({**{k: f[k].astype(np.int64) for k in FEATURES}, "pattern": pattern.astype(np.int32)}))
        yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({k: [] for k in (*FEATURES, "pattern")})


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS):
    """Posterior of good for each vote pattern, the rules' chances, the share of good texts."""
    n_rules = len(RULES)
    digits = np.stack([patterns // 3**k % 3 for k in range(n_rules - 1, -1, -1)], axis=1)
    seen = np.eye(3)[digits]  # pattern, rule, vote (none, bad, good)
    prior = np.array([PRIOR["fault"]] * len(FAULTS) + [PRIOR["range"]] * len(RANGES)).transpose(1, 0, 2)
    given, share, belief = prior, GOOD_SHARE, BELIEF * counts.sum()
    for _ in range(rounds):
        logs = np.einsum("prv,crv->pc", seen, np.log(np.maximum(given, 1e-12))) + np.log([1 - share, share])
        post = np.exp(logs - logs.max(axis=1, keepdims=True))
        post /= post.sum(axis=1, keepdims=True)
        weight = post * counts[:, None]
        given = np.einsum("pc,prv->crv", weight, seen) + belief * prior
        given /= given.sum(axis=2, keepdims=True)
        share = (weight[:, 1].sum() + belief * GOOD_SHARE) / (counts.sum() + belief)
    return post[:, 1], given, share


def votes_of(docs: DataFrame) -> DataFrame:
    """Rows of docs with _q: counts and vote pattern. Texts stay in the JVM."""
    kind = ", ".join([*(f"{k} bigint" for k in FEATURES), "pattern int"])
    # not deterministic as far as the optimizer knows, which would else count again in each filter on _q
    return docs.withColumn("_q", F.pandas_udf(score_texts, f"struct<{kind}>").asNondeterministic()("text"))


def posteriors(patterns: DataFrame) -> DataFrame:
    """_q_pattern, _q_posterior of the patterns in column _q_pattern: 3^rules at most are collected and sent out."""
    counted = patterns.groupBy("_q_pattern").count().collect()
    seen = np.array([r[0] for r in counted], np.int64)
    post = fit(seen, np.array([r[1] for r in counted], float))[0] if counted else []
    return patterns.sparkSession.createDataFrame([(int(p), float(x)) for p, x in zip(seen, post)], "_q_pattern int, _q_posterior double")


def failing(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > REPEAT_PERCENT * n_words)


def assess(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Columns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, posterior, kept for every row.

    A null or empty text has no words: no rule votes and the base test fails. Rows with equal
    texts get equal verdicts; no rows give no rows; no columns but doc_id and text are read.
    """
    told = votes_of(docs.select("doc_id", "text"))
    rows = write_and_read(told.select("doc_id", *(F.col(f"_q.{k}") for k in FEATURES), F.col("_q.pattern").alias("_q_pattern")), "quality-votes")
    rows = rows.join(F.broadcast(posteriors(rows)), "_q_pattern")
    failed = failing(F.col("n_words"), F.col("n_repeat_words"))
    return rows.select("doc_id", *FEATURES, failed.alias("base_failed"), F.col("_q_posterior").alias("posterior"),
                       (~failed & (F.col("_q_posterior") >= threshold)).alias("kept"))


def keep_good(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, that are kept. Texts are read twice, once for the patterns
    that the posterior needs and once for the rows, rather than written between."""
    told = votes_of(docs)
    good = posteriors(told.select(F.col("_q.pattern").alias("_q_pattern"))).filter(F.col("_q_posterior") >= threshold)
    told = told.filter(~failing(F.col("_q.n_words"), F.col("_q.n_repeat_words"))).withColumn("_q_pattern", F.col("_q.pattern"))
    return told.join(F.broadcast(good), "_q_pattern", "left_semi").select(*docs.columns)
