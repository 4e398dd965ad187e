"""Prompt templates: resolution, audit and rendering."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from lectern import schemas as S

# Fixed value: a hole is a name between double braces.
HOLE = r"\{\{([a-zA-Z_][a-zA-Z0-9_]*)\}\}"

# Templates are configuration. Beyond these bounds they are joined, not broadcast.
MAX_BROADCAST_TEMPLATES = 1_000
MAX_BROADCAST_BYTES = 8 << 20


class TemplateError(ValueError):
    """A template uses a hole for which no value is given."""


def holes(body: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(body, F.lit(HOLE), F.lit(1))))


def hole_names(body: str) -> set[str]:
    """Holes of a template text known when the plan is built."""
    return set(re.findall(HOLE, body))


def fill(body: Column, values: dict[str, Column]) -> Column:
    """Substitute holes in the order the values are given."""
    out = body
    for name, value in values.items():
        out = F.replace(out, F.lit("{{" + name + "}}"), value)
    return out


def check_templates(templates: DataFrame, names: list[str]) -> None:
    """Raise when a template needs a value that is not provided."""
    bad = templates.select(
        "name", F.array_except(holes(F.col("body")), F.array(*[F.lit(n) for n in names])).alias("missing")
    ).filter(F.size("missing") > 0)
    worst = bad.orderBy("name").head()
    if worst is not None:
        raise TemplateError(f"Missing prompt template values for {worst['name']}: {', '.join(worst['missing'])}")


def small_enough(templates: DataFrame) -> bool:
    row = templates.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("body")), F.lit(0)).alias("b")
    ).head()
    return row["n"] <= MAX_BROADCAST_TEMPLATES and row["b"] <= MAX_BROADCAST_BYTES


def render(
    rows: DataFrame,
    templates: DataFrame,
    values: dict[str, Column],
    *,
    on: str = "name",
    check: bool = True,
) -> DataFrame:
    """Rows joined to their template, holes filled -> column ``prompt``."""
    if check:
        check_templates(templates, list(values))
    bodies = templates.select(F.col("name").alias(on), F.col("body").alias("_body"))
    if small_enough(templates):
        bodies = F.broadcast(bodies)
    return rows.join(bodies, on).withColumn("prompt", fill(F.col("_body"), values)).drop("_body")


def resolve_templates(
    templates: DataFrame,
    keys: DataFrame | None = None,
    *,
    legacy: dict[str, tuple[str, ...]] = S.LEGACY_TEMPLATE_NAMES,
) -> DataFrame:
    """The body in force per template key.

    ``templates(root, root_priority, name, body)``: the lowest root priority
    wins; inside a root the current name comes before an older one. An
    environment root without built-in fallback is simply the only root given.
    """
    found = F.array(F.struct(F.col("name").alias("key"), F.lit(0).alias("age")))
    for key, names in legacy.items():
        for age, name in enumerate(names, start=1):
            found = F.when(
                F.col("name") == name, F.array(F.struct(F.lit(key).alias("key"), F.lit(age).alias("age")))
            ).otherwise(found)
    placed = templates.withColumn("_f", F.explode(found))
    best = placed.groupBy(F.col("_f.key").alias("template_key")).agg(
        F.min_by(F.struct("root", "name", "body"), F.struct("root_priority", "_f.age")).alias("b")
    ).select("template_key", "b.root", "b.name", "b.body")
    if keys is not None:
        best = keys.select("template_key").join(best, "template_key", "left")
    return best


def catalog(spark) -> DataFrame:
    rows = [(k, stage, list(names)) for k, (stage, names) in S.TEMPLATE_CATALOG.items()]
    return spark.createDataFrame(rows, "template_key STRING, stage STRING, names ARRAY<STRING>")


def audit_templates(resolved: DataFrame, known: DataFrame) -> DataFrame:
    """B11 audit: holes nobody fills (reject) and recommended ones left out (warn)."""
    return resolved.join(known, "template_key").select(
        "template_key",
        F.array_except(holes(F.col("body")), "names").alias("unknown"),
        F.array_sort(F.array_except("names", holes(F.col("body")))).alias("missing"),
    ).withColumn(
        "verdict",
        F.when(F.size("unknown") > 0, "reject").when(F.size("missing") > 0, "warn").otherwise("ok"),
    )
