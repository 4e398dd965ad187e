"""Mix sources to target sizes by Pareto order sampling (Rosen, 1997).

A source's target over its size gives each of its documents whole copies for certain; what
remains is a sample without replacement. A document's inclusion probability falls with its length,
so that one long text does not fill a share: it is c / (1 + size / mean size), at most 1, with one
constant c per source, so that the probabilities times sizes add up to the words asked for. Every
document draws u by a hash of its id and is ranked by odds(u) / odds of inclusion; the sample is the
front of that order, of a size fixed in words. Documents with probability 1 come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.words import WORD
from lectern.session import write_and_read

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BINS = 4096


def draw(key: Column) -> Column:
    """A number between 0 and 1, both excluded, from 52 bits of the key's MD5."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def fall() -> Column:
    """How inclusion falls with length, before scaling: mean / (mean + size)."""
    return F.col("source_size") / (F.col("source_size") + F.col("size") * F.col("_docs"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Target of each source: its weight's part of share x all, at most `most` x its size.

    Sources in code point order, null last, take the weights in turn. What stops at its bound
    frees words for the others by weight, until none is above; the sources that stop are those
    with the least size per weight, so one sorted pass finds them. One row per source goes
    through one task.
    """
    every = Window.partitionBy(F.lit(0))
    placed = sizes.withColumn(
        "_w", F.element_at(F.array(*map(F.lit, weights)),
                           ((F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1)
                            % len(weights) + 1).cast("int")).cast("double"))
    placed = placed.withColumns({
        "_cap": F.col("source_size") * most,
        "_all": F.sum("source_size").over(every) * F.lit(share),
    })
    order = every.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = ((F.col("_all") - F.coalesce(F.sum("_cap").over(earlier), F.lit(0))) / F.sum("_w").over(later))
    # the first source in this order that its level does not fill sets the level of the rest
    placed = placed.withColumn("_level", level).withColumn(
        "_open", F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level")))
    fixed = F.first("_open", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return placed.withColumn("target", F.coalesce(fixed * F.col("_w"), F.col("_cap").cast("double"))).drop(
        "_w", "_cap", "_all", "_level", "_open")


def scales(by_size: DataFrame, sources: DataFrame) -> DataFrame:
    """_source, _none, _scale: the constant c of each source.

    by_size: _source, _none, size, n. The shortest documents reach probability 1 first, so one pass
    over a source's sizes in order finds where the others begin. A source's different sizes (no more
    than words in its longest text) go through one task.
    """
    keys = Window.partitionBy("_source", "_none")
    rows = by_size.filter("size > 0").join(sources, ["_source", "_none"]).withColumn("_fall", fall())
    rows = rows.withColumns({
        "_sure": F.coalesce(F.sum(F.col("n") * F.col("size")).over(keys.orderBy("size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_open": F.sum(F.col("n") * F.col("size") * F.col("_fall")).over(
            keys.orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, 0))})
    rows = rows.withColumn("_scale", (F.col("_rest") - F.col("_sure")) / F.col("_open"))
    return rows.filter(F.col("_scale") * F.col("_fall") <= 1).groupBy("_source", "_none").agg(F.min_by("_scale", "size").alias("_scale"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, bins: int = BINS,
                whole_rows: bool = False) -> DataFrame:
    """Per row of `docs`: doc_id, source, size, source_size, target, probability (of the sampled copy),
    copies, taken.

    With whole_rows the mix itself: the rows of `docs` with all their columns, each as often
    as it is taken. Texts are then scanned again, but not shuffled, except those of rows equal in
    doc_id and size among which a sample ends.

    size counts words (null text: 0). A null source is a source of its own, last in order. A
    source without words has target 0. Rows with equal doc_id draw alike and are ranked by
    size. A sample ends at the document whose inclusion brings its words nearest to what is
    asked, so it misses by half that document at most. A document without words is in no sample. No rows give no rows; columns other than
    doc_id, source and text are not read.

    Ranks fall in `bins` equal parts of odds/(1 + odds); sums of words per source and bin tell
    which bin a sample ends in, and only that bin of a source is sorted. Nothing else needs the
    documents of a source together.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size")
    keys = ["_source", "_none"]

    def keyed(rows: DataFrame) -> DataFrame:
        return rows.withColumns({"_source": F.coalesce("source", F.lit("")), "_none": F.col("source").isNull()})

    rows = write_and_read(docs.select("doc_id", "source", size), "mix-sizes")
    by_size = write_and_read(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-lengths")
    sources = by_size.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("_docs"))
    sources = keyed(targets(sources, weights, share, most)).withColumn(
        "_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    ).withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size")).drop("source")
    sources = write_and_read(sources, "mix-sources")
    sources = write_and_read(sources.join(scales(keyed(by_size).drop("source"), sources), keys, "left"), "mix-scales")

    u = draw(F.col("doc_id"))

    def ranked(rows: DataFrame) -> DataFrame:
        """With probability, odds and bin; the last two are null in a source that is not sampled."""
        p = F.col("probability")
        return (
            keyed(rows).join(sources, keys)
            .withColumn("probability", F.when(F.col("size") > 0, F.least(F.lit(1.0), F.coalesce("_scale", F.lit(0.0)) * fall())).otherwise(0.0))
            .withColumn("_odds", F.when(p > 0, (u / (1 - u)) * ((1 - p) / p)))
            .withColumn("_bin", F.floor(F.col("_odds") / (1 + F.col("_odds")) * bins).cast("int"))
        )

    filled = ranked(rows).filter("_bin IS NOT NULL").groupBy(*keys, "_bin").agg(F.sum("size").alias("_words"), F.first("_rest").alias("_rest"))
    upto = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    # written, so that its size is known before rows are joined to it
    ends = write_and_read(
        filled.withColumn("_end", F.sum("_words").over(upto))
        .filter((F.col("_end") - F.col("_words") <= F.col("_rest")) & (F.col("_end") > F.col("_rest")))
        .select(*keys, F.col("_bin").alias("_last"), (F.col("_end") - F.col("_words")).alias("_before")), "mix-ends")
    placed = ranked(rows).join(ends, keys, "left")
    in_last = F.col("_bin") == F.col("_last")
    order = Window.partitionBy(*keys).orderBy("_odds", F.col("doc_id").asc_nulls_last(), "size")
    cut = placed.filter(in_last).withColumn(
        "_upto", F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    cut = cut.withColumn("_in", F.col("_before") + F.col("_upto") + F.col("size") / 2 <= F.col("_rest")).drop("_upto")
    if whole_rows:
        return _taken(ranked(docs.select("doc_id", "source", size, F.struct("*").alias("_row"))), ends, cut, keys)
    whole = placed.filter(~F.coalesce(in_last, F.lit(False))).withColumn("_in", F.coalesce(F.col("_bin") < F.col("_last"), F.lit(False)))
    copies = (F.col("_whole") + F.col("_in").cast("int")).cast("int")
    return whole.unionByName(cut).select(
        "doc_id", "source", "size", "source_size", "target", "probability", copies.alias("copies"),
        (F.col("size") * copies).cast("bigint").alias("taken"))


def _taken(rows: DataFrame, ends: DataFrame, cut: DataFrame, keys: list[str]) -> DataFrame:
    """The column _row of ranked rows as often as each is taken. A sample's last place, found on rows
    without texts, is one row per source; among rows equal to it, any as many as belong to it are taken."""
    place = F.struct("_odds", F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id"), F.lit(0)).alias("id"), "size")
    placed = cut.withColumn("_place", place)
    edge = placed.filter("_in").groupBy(*keys).agg(F.max("_place").alias("_edge"))
    ties = placed.join(edge, keys).filter(F.col("_place") == F.col("_edge")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_equal"), F.count_if("_in").alias("_left"))
    edges = write_and_read(ends.select(*keys, "_last").join(edge, keys, "left").join(ties, keys, "left"), "mix-edges")
    found = rows.join(edges, keys, "left").withColumn("_place", place)
    at_edge = F.coalesce(F.col("_place") == F.col("_edge"), F.lit(False))
    split = F.col("_equal") > F.col("_left")
    inside = F.coalesce(F.col("_bin") < F.col("_last"), F.lit(False)) | F.coalesce(
        (F.col("_bin") == F.col("_last")) & (F.col("_place") <= F.col("_edge")), F.lit(False))
    take = found.filter(~(at_edge & F.coalesce(split, F.lit(False)))).withColumn("_in", inside)
    if not edges.filter(split).isEmpty():  # the sample of some source ends among equal rows
        some = Window.partitionBy(*keys).orderBy(F.xxhash64("_row.text"))
        take = take.unionByName(found.filter(at_edge & split).withColumn("_in", F.row_number().over(some) <= F.col("_left")))
    copies = (F.col("_whole") + F.col("_in").cast("int")).cast("int")
    times = F.explode(F.array_repeat(F.lit(0), copies)).alias("_time")
    return take.filter(copies > 0).select("_row", times).select("_row.*")
