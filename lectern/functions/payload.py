"""Reading JSON out of free-form model replies, as VARIANT columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lectern.functions import text as tx
from lectern.functions.folds import let

# What replies look like.
FENCE = r"(?is)```(?:json)?\s*(.*?)```"
LIST_KEYS = ("decisions", "items", "results", "data")
SPAN_ID_KEYS = ("span_id", "id", "span", "spanId", "spanID")
ACTION_KEYS = ("action", "decision", "classification", "verdict")
ACTIONS = ("KEEP", "REMOVE")


def try_json(text: Column) -> Column:
    """Whole text as VARIANT, null unless it is exactly one JSON value.

    The parser ignores trailing text, so the value is read as the first of
    two array elements, the second being a marker.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit("," + '"end-of-value"' + "]")))
    return let(
        F.try_variant_get(wrapped, "$", "array<variant>"),
        lambda a: F.when(
            (F.size(a) == 2)
            & (F.try_variant_get(F.get(a, F.lit(1)), "$", "string") == "end-of-value"),
            F.get(a, F.lit(0)),
        ),
    )


def as_list(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def as_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


def as_text(value: Column) -> Column:
    """The string itself; null for any other JSON type."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def as_whole_number(value: Column) -> Column:
    """Integers, whole floats, booleans and numeric strings; fractions are not."""
    def read(v: Column) -> Column:
        raw = F.trim(F.try_variant_get(v, "$", "string"))
        # 1, "1", 1.0 and "1.0" all start with the digits and a zero fraction.
        digits = F.regexp_extract(raw, r"\A([+-]?\d+)(\.0+)?\z", 1).try_cast("bigint")
        return F.when(F.schema_of_variant(v) == "BOOLEAN", F.try_variant_get(v, "$", "bigint")).otherwise(digits)

    return let(value, read)


def fenced(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(FENCE), F.lit(1))


def balanced(text: Column, opening: str, closing: str) -> Column:
    """First substring from ``opening`` to its matching ``closing``.

    Brackets inside JSON strings do not count. The text is split at brackets,
    quotes and backslashes, so plain stretches cost one step each; later
    openings are tried only when earlier ones never close.
    """
    special = rf'[\{opening}\{closing}"\\]'
    tokens = F.split(text, rf"(?<={special})|(?={special})")

    def scan(rest: Column) -> Column:
        zero = F.struct(
            F.lit(0).alias("n"), F.lit(0).alias("depth"), F.lit(False).alias("quoted"),
            F.lit(False).alias("escaped"), F.lit(None).cast("int").alias("stop"),
        )

        def step(acc: Column, tok: Column) -> Column:
            n = acc["n"] + 1
            quoted, escaped = acc["quoted"], acc["escaped"]
            depth = F.when(quoted, acc["depth"]).when(tok == opening, acc["depth"] + 1).when(
                tok == closing, acc["depth"] - 1
            ).otherwise(acc["depth"])
            moved = F.struct(
                n.alias("n"), depth.alias("depth"),
                F.when(tok == '"', ~quoted | escaped).otherwise(quoted).alias("quoted"),
                (quoted & ~escaped & (tok == "\\")).alias("escaped"),
                F.when(~quoted & (tok == closing) & (depth == 0), n).alias("stop"),
            )
            return F.when(acc["stop"].isNotNull(), acc).otherwise(moved)

        return F.aggregate(rest, zero, step, lambda acc: acc["stop"])

    def search(toks: Column) -> Column:
        size = F.size(toks)
        openings = F.filter(F.sequence(F.lit(1), size), lambda i: F.get(toks, i - 1) == opening)

        def attempt(found: Column, i: Column) -> Column:
            rest = F.slice(toks, i, size - i + 1)
            return F.coalesce(
                found,
                let(scan(rest), lambda stop: F.when(
                    stop.isNotNull(), F.array_join(F.slice(toks, i, stop), ""))),
            )

        return F.aggregate(openings, F.lit(None).cast("string"), attempt)

    return F.when(text.contains(opening), let(tokens, search))


def best_json(text: Column) -> Column:
    """First candidate that parses: whole text, fences, [...], {...}."""
    def search(body: Column) -> Column:
        from_fences = F.aggregate(
            fenced(body), F.lit(None).cast("variant"), lambda acc, f: F.coalesce(acc, try_json(tx.strip(f)))
        )
        return F.coalesce(
            try_json(body), from_fences,
            try_json(balanced(body, "[", "]")), try_json(balanced(body, "{", "}")),
        )

    return let(tx.strip(text), search)


def whole_or_first_fence(text: Column) -> Column:
    return let(
        tx.strip(text),
        lambda body: F.coalesce(try_json(body), try_json(tx.strip(F.get(fenced(body), F.lit(0))))),
    )


def unwrap_list(value: Column) -> Column:
    return F.coalesce(
        as_list(value), *[F.try_variant_get(value, f"$.{k}", "array<variant>") for k in LIST_KEYS]
    )


def _first_present(obj: Column, names: tuple[str, ...]) -> Column:
    picked = F.lit(None).cast("variant")
    for name in reversed(names):
        picked = F.when(F.map_contains_key(obj, name), F.try_element_at(obj, F.lit(name))).otherwise(picked)
    return picked


def _optional_text_ok(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value) | (F.schema_of_variant(value) == "STRING")


def decision(row: Column) -> Column:
    """One reply element -> validated decision struct, null when invalid."""
    def pick(obj: Column) -> Column:
        return F.struct(
            as_whole_number(_first_present(obj, SPAN_ID_KEYS)).alias("span_id"),
            F.upper(tx.strip(let(_first_present(obj, ACTION_KEYS), as_text))).alias("action"),
            F.try_element_at(obj, F.lit("label")).alias("label"),
            F.try_element_at(obj, F.lit("reason")).alias("reason"),
        )

    def build(d: Column) -> Column:
        valid = (
            d.span_id.isNotNull() & d.action.isin(*ACTIONS)
            & _optional_text_ok(d.label) & _optional_text_ok(d.reason)
        )
        return F.when(valid, F.struct(
            d.span_id.alias("span_id"), d.action.alias("action"),
            as_text(d.label).alias("label"), as_text(d.reason).alias("reason"),
        ))

    return let(let(as_object(row), pick), build)


def block(row: Column) -> Column:
    """One reply element -> validated block struct, null when invalid."""
    names = ("from_paragraph", "to_paragraph", "title", "body")

    def pick(obj: Column) -> Column:
        def text_of(name: str) -> Column:
            return tx.strip(let(F.try_element_at(obj, F.lit(name)), as_text))

        return F.struct(
            as_whole_number(F.try_element_at(obj, F.lit("from_paragraph"))).alias("from_p"),
            as_whole_number(F.try_element_at(obj, F.lit("to_paragraph"))).alias("to_p"),
            text_of("title").alias("title"), text_of("body").alias("body"),
            F.size(F.array_except(F.map_keys(obj), F.array(*[F.lit(n) for n in names]))).alias("extra"),
        )

    def build(b: Column) -> Column:
        valid = (b.extra == 0) & (b.from_p > 0) & (b.from_p <= b.to_p) & (b.title != "") & (b.body != "")
        return F.when(valid, F.struct(
            b.from_p.alias("from_p"), b.to_p.alias("to_p"), b.title.alias("title"), b.body.alias("body")
        ))

    return let(let(as_object(row), pick), build)
