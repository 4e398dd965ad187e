"""What needs work: signatures, unchanged stages, source choice, stable ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.functions import text as tx
from lectern.operators import ordered
from lectern.session import cut_lineage

MISSING = "<missing>"
# Skipped and dry runs leave the last real outcome in force.
OUTCOMES = ("success", "failed")


class MappingError(ValueError):
    """The stored path -> run id mapping breaks its rules."""


def artifacts(files: DataFrame, content: str = "content") -> DataFrame:
    """A2: (path, sha256, bytes) of binary or text content."""
    raw = F.col(content)
    return files.select(
        "path", F.sha2(raw, 256).alias("sha256"), F.octet_length(raw).cast("bigint").alias("bytes")
    )


def input_signatures(expected: DataFrame, found: DataFrame, keys=("run_id", "stage")) -> DataFrame:
    """'path:sha256' lines in path order, at any number of files; an absent file is '<missing>'.

    Lines are gathered in pieces by many tasks and the pieces are joined; the signature itself is one value.
    """
    keys = list(keys)
    line = F.concat_ws(":", F.col("path"), F.coalesce(F.col("sha256"), F.lit(MISSING)))
    lines = expected.select(*keys, "path").distinct().join(found.select("path", "sha256"), "path", "left")
    pieces = line_pieces(lines.select(*keys, "path", line.alias("line")), keys)
    return pieces.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_piece", "_text"))).alias("_p")).select(
        *keys, F.array_join(F.col("_p._text"), "\n").alias("inputs_signature")
    )


def line_pieces(lines: DataFrame, keys: list[str]) -> DataFrame:
    """keys, _piece, _text: lines in order of path, at most ordered.GATHER_ROWS in a piece."""
    placed = ordered.number_all(lines, [*keys, "path", "line"], "_place").withColumn("_piece", F.floor(F.col("_place") / ordered.GATHER_ROWS))
    return placed.groupBy(*keys, "_piece").agg(F.array_sort(F.collect_list(F.struct("_place", "line"))).alias("_l")).select(
        *keys, "_piece", F.array_join(F.col("_l.line"), "\n").alias("_text")
    )


def params_signature(params: Column) -> Column:
    """Order-free signature of a parameter map."""
    return F.sha2(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(params)))), 256)


def latest_outcome(manifests: DataFrame, keys=("run_id", "stage")) -> DataFrame:
    """Latest success/failed manifest per stage of a run."""
    rest = [c for c in manifests.columns if c not in keys]
    # Maps cannot be compared but may be carried by max_by.
    return manifests.filter(F.col("status").isin(*OUTCOMES)).groupBy(*keys).agg(
        F.max_by(F.struct(*rest), "finished_at").alias("m")
    ).select(*keys, "m.*")


def select_work(
    candidates: DataFrame, manifests: DataFrame, keys=("run_id", "stage"), force: bool = False
) -> DataFrame:
    """F8: candidates without an unchanged success. Inputs: params, inputs_signature."""
    if force:
        return candidates
    done = latest_outcome(manifests, keys).filter(F.col("status") == "success").select(
        *keys, params_signature(F.col("params")).alias("_p"), F.col("inputs_signature").alias("_i")
    )
    same = [candidates[k] == done[k] for k in keys]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    cond = cond & (params_signature(candidates["params"]) == done["_p"]) & (
        candidates["inputs_signature"] == done["_i"]
    )
    return candidates.join(done, cond, "left_anti")


def fresh_source(edited: DataFrame, condensed: DataFrame, manifests: DataFrame, run: str = "run_id") -> DataFrame:
    """condensed text when it was made from the current edited text.

    ``edited(run, text, signature)``; ``condensed(run, text)``.
    """
    last = latest_outcome(manifests.filter(F.col("stage") == "s08"), (run,)).filter(
        F.col("status") == "success"
    ).select(run, F.col("inputs_signature").alias("_made_from"))
    current = condensed.select(run, F.col("text").alias("_condensed")).join(last, run)
    joined = edited.join(current, run, "left")
    use = F.coalesce(
        (F.col("_made_from") == F.col("signature")) & F.col("_condensed").isNotNull(), F.lit(False)
    )
    return joined.select(
        run, F.when(use, F.col("_condensed")).otherwise(F.col("text")).alias("text"),
        F.when(use, "s08").otherwise("s07").alias("input_source_stage"),
    )


def best_output(texts: DataFrame, run: str = "run_id", preference=("s10", "s09", "s08", "s07")) -> DataFrame:
    """the most advanced text of each run, all its rows; only names are shuffled to choose it."""
    rank = F.array_position(F.array(*[F.lit(s) for s in preference]), F.col("stage"))
    chosen = texts.select(run, "stage", rank.alias("_rank")).filter("_rank > 0").groupBy(run).agg(
        F.min_by("stage", "_rank").alias("stage")
    )
    return texts.join(chosen, [run, "stage"], "left_semi")


def mapping_problems(mapping: DataFrame) -> DataFrame:
    """unusable or repeated run ids."""
    name = F.col("run_id")
    bad = F.when(
        name.isNull() | name.isin("", ".", "..") | name.contains("/") | name.contains("\\"), "invalid name"
    )
    invalid = mapping.withColumn("problem", bad).filter("problem IS NOT NULL").groupBy("run_id", "problem").agg(
        F.count(F.lit(1)).alias("paths")
    )
    repeated = mapping.groupBy("run_id").agg(F.count(F.lit(1)).alias("paths")).filter("paths > 1").select(
        "run_id", F.lit("duplicate assignment").alias("problem"), "paths"
    )
    return invalid.unionByName(repeated)


def check_mapping(mapping: DataFrame) -> None:
    first = mapping_problems(mapping).orderBy("problem", "run_id").head()
    if first is not None:
        raise MappingError(f"{first['problem']}: '{first['run_id']}'")


# ---------------------------------------------------------------------------
# stable ids
# ---------------------------------------------------------------------------


def file_stem(path: Column) -> Column:
    name = F.regexp_extract(path, r"([^/\\]*)[/\\]*\z", 1)
    return F.regexp_replace(name, r"(?s)\A(.+)\.[^.]*\z", "$1")


def _suffix(name: Column) -> tuple[Column, Column]:
    """'x-7' -> (x, 7); null where the name has no numeric suffix >= 2."""
    canonical = r"(?s)\A(.+)-([1-9]\d*)\z"
    k = F.regexp_extract(name, canonical, 2).try_cast("bigint")
    return F.when(k >= 2, F.regexp_extract(name, canonical, 1)), F.when(k >= 2, k)


def assign_run_ids(
    paths: DataFrame, mapping: DataFrame, taken: DataFrame | None = None, *,
    slice_rows: int = ordered.SLICE_ROWS,
) -> DataFrame:
    """(path, run_id, is_new) for every path; known paths keep their id.

    Same names as giving each new path, in path order, the first free one of
    base, base-2, base-3, ... The n-th new path of a base takes its n-th free
    suffix, found by ranks instead of one-by-one probing. A base that itself
    looks like another base's suffixed name ('a-2' next to 'a') is settled
    first by comparing path order.
    """
    known = paths.select("path").distinct().join(mapping.select("path", "run_id"), "path", "left")
    old = known.filter(F.col("run_id").isNotNull()).withColumn("is_new", F.lit(False))
    new = known.filter(F.col("run_id").isNull()).select(
        "path", tx.run_name(file_stem(F.col("path"))).alias("base")
    )
    ranked = ordered.number_all(new, ["base", "path"], "_g")
    bases = cut_lineage(ranked.groupBy("base").agg(
        F.min("_g").alias("_from"), F.count(F.lit(1)).alias("_rows"), F.min("path").alias("_first")
    ))
    placed = ordered.attach(
        ranked, bases.select("base", "_from"), ["base"], "_g", slice_rows=slice_rows
    ).select("path", "base", (F.col("_g") - F.col("_from") + 1).alias("n"))

    names = mapping.select(F.col("run_id").alias("name"))
    if taken is not None:
        names = names.unionByName(taken.select("name"))
    stem, k = _suffix(F.col("name"))
    slots = names.distinct().select(F.explode(F.array(
        F.struct(F.col("name").alias("base"), F.lit(1).alias("k")),
        F.struct(stem.alias("base"), k.alias("k")),
    )).alias("s")).select("s.base", "s.k").filter("base IS NOT NULL").join(
        bases.select("base"), "base", "left_semi"
    )
    contested = _contested(bases, names)
    if contested is not None:
        slots = slots.unionByName(_settle(contested, ranked, slots, bases, slice_rows)).distinct()

    # A slot u with j slots up to it leaves u - j free suffixes below it.
    skips = ordered.number_rows(slots, ["base"], ["k"], "j", slice_rows=slice_rows).groupBy(
        "base", (F.col("k") - F.col("j")).alias("at")
    ).agg(F.count(F.lit(1)).alias("skip"))
    line = placed.select("base", F.col("n").alias("at"), F.lit(0).alias("kind"), "path", F.lit(0).cast("bigint").alias("skip"))
    line = line.unionByName(skips.select("base", "at", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("path"), "skip"))
    counted = ordered.running(
        line, ["base"], ["at", "kind"], [ordered.Running("_skipped", "sum", F.col("skip"))],
        slice_rows=slice_rows,
    ).filter("kind = 0")
    k = F.col("at") + F.col("_skipped")
    named = counted.select(
        "path",
        F.when(k == 1, F.col("base")).otherwise(F.concat("base", F.lit("-"), k.cast("string"))).alias("run_id"),
        F.lit(True).alias("is_new"),
    )
    return old.unionByName(named)


def _contested(bases: DataFrame, names: DataFrame) -> DataFrame | None:
    """Names wanted both bare by one base and suffixed by another."""
    parent, k = _suffix(F.col("base"))
    wanted = bases.select(
        F.col("base").alias("holder"), F.col("_first").alias("path"), parent.alias("base"), k.alias("k")
    ).filter("base IS NOT NULL").join(
        bases.select("base", "_rows"), "base"
    ).join(names.select(F.col("name").alias("holder")), "holder", "left_anti")
    wanted = cut_lineage(wanted)
    return None if wanted.isEmpty() else wanted


def _settle(contested, ranked, slots, bases, slice_rows):
    """Slots lost to another base, decided from the shortest names down."""
    # How many rows of the base come before the holder's first path.
    marks = ordered.number_all(
        ranked.select("base", "path", F.lit(None).cast("string").alias("holder"), F.lit(1).alias("own"))
        .unionByName(contested.select("base", "path", "holder", F.lit(0).alias("own"))),
        ["base", "path", "own"], "_m",
    )
    before = ordered.running(
        marks, ["base"], ["_m"], [ordered.Running("ahead", "sum", F.col("own"))], slice_rows=slice_rows
    ).filter("own = 0").select("holder", "ahead")
    # How many slots of the base were taken below the contested suffix.
    levels = slots.select("base", "k", F.lit(None).cast("string").alias("holder"), F.lit(1).alias("own"))
    levels = levels.unionByName(contested.select("base", "k", "holder", F.lit(0).alias("own")))
    below = ordered.running(
        levels, ["base"], ["k", "own"], [ordered.Running("below", "sum", F.col("own"))], slice_rows=slice_rows
    ).filter("own = 0").select("holder", "below")
    open_ = cut_lineage(contested.join(before, "holder").join(below, "holder"))
    lost = None
    while not open_.isEmpty():
        # A base can settle its suffixes once its own bare name is settled.
        ready = open_.join(open_.select(F.col("holder").alias("base")), "base", "left_anti")
        shift = F.lit(0)
        if lost is not None:
            own = lost.filter("k = 1").select("base", F.lit(1).alias("_own"))
            ready = ready.join(own, "base", "left")
            shift = F.coalesce("_own", F.lit(0))
        # Beyond the suffixes that the base's rows can reach, even if every contested
        # name below is free, the holder keeps its name: nothing to walk there.
        before = F.row_number().over(Window.partitionBy("base").orderBy("k")) - 1
        ready = ready.withColumn("_shift", shift).withColumn("_before", before)
        ready = cut_lineage(ready.withColumn("_far", F.col("k") - F.col("below") - F.col("_shift") - F.col("_before") > F.col("_rows")))
        far = ready.filter("_far").select("base", F.struct("k", "holder", F.lit(True).alias("wins")).alias("d"))
        step = ready.filter("NOT _far").groupBy("base", "_rows", "_shift").agg(
            F.array_sort(F.collect_list(F.struct("k", "ahead", "below", "holder"))).alias("c")
        )
        zero = F.struct(F.lit(0).cast("bigint").alias("gone"), F.array().cast("array<struct<k:bigint,holder:string,wins:boolean>>").alias("out"))

        def fold(acc: Column, c: Column) -> Column:
            n = c.k - c.below - F.col("_shift") - acc.gone
            wins = ~((n <= F.col("_rows")) & (c.ahead >= n))
            return F.struct(
                F.when(wins, acc.gone + 1).otherwise(acc.gone).alias("gone"),
                F.array_append(acc.out, F.struct(c.k.alias("k"), c.holder.alias("holder"), wins.alias("wins"))).alias("out"),
            )

        ruled = step.select("base", F.explode(F.aggregate("c", zero, fold, lambda a: a.out)).alias("d"))
        ruled = ruled.unionByName(far)
        now = ruled.select(
            F.when(F.col("d.wins"), F.col("base")).otherwise(F.col("d.holder")).alias("base"),
            F.when(F.col("d.wins"), F.col("d.k")).otherwise(F.lit(1)).alias("k"),
            F.col("d.holder").alias("holder"),
        )
        now = cut_lineage(now)
        open_ = cut_lineage(open_.join(now.select("holder"), "holder", "left_anti"))
        lost = now if lost is None else lost.unionByName(now)
    return lost.select("base", "k")
