"""Greedy folds over array columns.

A greedy break depends on the previous break, so it is a true fold. The state
stays small: running length plus the list of break positions; pieces are cut
out with slice() afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lectern.functions import text as tx


def let(value: Column, body) -> Column:
    """Bind ``value`` once: inside a lambda it would be re-evaluated per use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _cut(items: Column, starts: Column, joiner: str) -> Column:
    """Join the runs of ``items`` that begin at the 1-based ``starts``."""
    ends = F.concat(
        F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))),
        F.array(F.size(items) + 1),
    )
    joined = F.zip_with(
        starts, ends, lambda s, e: F.array_join(F.slice(items, s, e - s), joiner)
    )
    # Without any start there is still one end: its null is not a piece.
    return F.filter(joined, lambda piece: piece.isNotNull())


def wrap_paragraph(paragraph: Column, max_chars: int) -> Column:
    """Word-greedy pieces of one over-long paragraph.

    A word longer than the budget is cut into fixed slices that never join
    their neighbours.
    """
    zero = F.struct(
        F.lit(0).alias("pos"),
        F.lit(0).alias("held"),
        F.array().cast("array<int>").alias("starts"),
    )

    def step(acc: Column, word: Column) -> Column:
        size = F.length(word)
        pos = acc.pos + 1
        joins = (acc.held > 0) & (acc.held + 1 + size <= max_chars)
        return F.struct(
            pos.alias("pos"),
            F.when(size > max_chars, F.lit(0))
            .when(joins, acc.held + 1 + size)
            .otherwise(size)
            .alias("held"),
            F.when(joins, acc.starts)
            .otherwise(F.array_append(acc.starts, pos))
            .alias("starts"),
        )

    def cut(ws: Column) -> Column:
        return let(
            F.aggregate(ws, zero, step, lambda acc: acc.starts),
            lambda starts: _cut(ws, starts, " "),
        )

    pieces = let(tx.words(paragraph), cut)
    return F.flatten(
        F.transform(
            pieces,
            lambda p: F.when(
                F.length(p) > max_chars,
                F.transform(
                    F.sequence(F.lit(1), F.length(p), F.lit(max_chars)),
                    lambda at: F.substring(p, at, F.lit(max_chars)),
                ),
            ).otherwise(F.array(p)),
        )
    )


def pack(pieces: Column, max_chars: int, joiner: str = "\n\n") -> Column:
    """Greedy packing of pieces under a character budget, joiner counted."""
    gap = len(joiner)
    zero = F.struct(
        F.lit(0).alias("pos"),
        F.lit(0).alias("held"),
        F.array().cast("array<int>").alias("starts"),
    )

    def step(acc: Column, piece: Column) -> Column:
        size = F.length(piece)
        pos = acc.pos + 1
        joins = (acc.pos > 0) & (acc.held + gap + size <= max_chars)
        return F.struct(
            pos.alias("pos"),
            F.when(joins, acc.held + gap + size).otherwise(size).alias("held"),
            F.when(joins, acc.starts)
            .otherwise(F.array_append(acc.starts, pos))
            .alias("starts"),
        )

    return let(
        F.aggregate(pieces, zero, step, lambda acc: acc.starts),
        lambda starts: _cut(pieces, starts, joiner),
    )


def chunk_text(text: Column, max_chars: int, sep: str = "\n\n", joiner: str = "\n\n") -> Column:
    """Text -> array of chunks, each within ``max_chars`` characters."""
    if max_chars <= 0:
        raise ValueError("max_chars must be > 0")
    paras = tx.paragraphs(text, sep)
    pieces = F.flatten(
        F.transform(
            paras,
            lambda p: F.when(F.length(p) <= max_chars, F.array(p)).otherwise(
                wrap_paragraph(p, max_chars)
            ),
        )
    )
    return let(pieces, lambda bound: pack(bound, max_chars, joiner))
