"""Text column functions with Unicode-wide whitespace rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every character that counts as whitespace when stripping.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regular expression: \s in Unicode mode plus four controls.
SPACE = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def lstrip(text: Column) -> Column:
    return F.ltrim(text, F.lit(WHITESPACE))


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    return strip(text) == ""


def words(text: Column) -> Column:
    return F.filter(F.split(text, rf"(?U){SPACE}+"), lambda w: w != "")


def literal_split(text: Column, sep: str) -> Column:
    escaped = "".join("\\" + c if c in r"\.[]{}()*+-?^$|" else c for c in sep)
    return F.split(text, escaped)


def paragraphs(text: Column, sep: str = "\n\n") -> Column:
    """Stripped, non-blank pieces in order."""
    pieces = F.transform(literal_split(text, sep), strip)
    return F.filter(pieces, lambda p: p != "")


def sentences(text: Column) -> Column:
    """Split after . ! or ? followed by whitespace; blank text has none."""
    parts = F.split(strip(text), rf"(?U)(?<=[.!?]){SPACE}+")
    return F.filter(F.transform(parts, strip), lambda p: p != "")


def newline_terminated(text: Column) -> Column:
    return F.when(text != "", F.concat(text, F.lit("\n"))).otherwise(text)


def drop_block_headings(text: Column) -> Column:
    """Remove '## Block n: ...' lines, then strip."""
    heading = rf"(?U)^{SPACE}*##{SPACE}*Block{SPACE}+\d+{SPACE}*:"
    kept = F.filter(F.split(strip(text), "\r\n|\n|\r"), lambda line: ~line.rlike(heading))
    return strip(F.array_join(kept, "\n"))


def html_escape(text: Column) -> Column:
    out = text
    # The five HTML entities, ampersand first.
    for raw, entity in (
        ("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"),
    ):
        out = F.replace(out, F.lit(raw), F.lit(entity))
    return out


def run_name(stem: Column) -> Column:
    """File stem -> safe lower-case run name; nothing left means 'audio'."""
    dashed = F.regexp_replace(stem, "[^A-Za-z0-9._-]+", "-")
    trimmed = F.lower(F.regexp_replace(dashed, r"\A[._-]+|[._-]+\z", ""))
    return F.coalesce(F.nullif(trimmed, F.lit("")), F.lit("audio"))
