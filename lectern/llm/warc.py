"""WARC archives through Spark's text writer and reader, verified by their boundary chain.

A record begins with the version line. Reading splits archives at that line wherever it stands,
also inside a payload; every piece gives a candidate: where it begins and, by its Content-Length,
where the next record begins. Pointer jumping from the file's start keeps the candidates that the
chain reaches. Inside a block (what one task reads of a file) the pointers are doubled in numpy;
between blocks they are doubled as a join, log2(blocks of a file) times. Files are reached by
Spark alone, so any file system that Spark knows will do. An uncompressed archive is read by many
tasks, a compressed one by one task, which is why the writer limits records per file.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.session import cut_lineage, write_and_read

VERSION = "WARC/1.1"
END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "1970-01-01T00:00:00Z"


def base32_sha1(data: Column) -> Column:
    """SHA-1 in upper-case base 32: five hexadecimal digits make four characters."""
    hexed = F.sha1(data)
    chars = []
    for i in range(8):
        bits = F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(bits, shift).bitwiseAND(31) + 1
            chars.append(F.substring(F.lit(BASE32), at, F.lit(1)))
    return F.concat(*chars)


def plan_revisits(pages: DataFrame, least: int) -> DataFrame:
    """page_id, payload_digest, first: pages whose payload an earlier page_id has as well."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    marks = pages.select("page_id", F.octet_length(payload).alias("n"), base32_sha1(payload).alias("payload_digest"))
    marks = marks.filter((F.col("n") >= least) & F.col("page_id").isNotNull()).drop("n").distinct()
    firsts = marks.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("times"))
    return marks.join(firsts.filter("times > 1").drop("times"), "payload_digest").filter("page_id <> first")


def write(pages: DataFrame, path: str, least: int = 0, records_per_file: int = 20_000, compression: str = "gzip") -> None:
    """One record per row of pages (page_id, url, html): a response, or a revisit without payload.

    Of equal payloads of at least `least` bytes the smallest page_id is the response. A null
    html is an empty payload; rows with a null page_id are responses; equal rows get the same
    record each. Only numbers are shuffled to find repeats; pages are shuffled to learn the
    outcome unless the repeats are few enough for Spark to send them to all tasks.
    """
    again = write_and_read(plan_revisits(pages, least), "warc-revisits")
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("html"), base32_sha1(payload.cast("binary")).alias("payload_digest"))
    rows = rows.join(again, ["page_id", "payload_digest"], "left")
    fresh = F.col("first").isNull()
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    uri = F.regexp_replace(F.coalesce("url", F.lit("about:blank")), r"[\x00-\x20\x7F]", "%20")
    block = F.when(fresh, F.col("html")).otherwise(F.lit(""))
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.when(fresh, F.lit("response")).otherwise(F.lit("revisit"))),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), page, F.lit(">")),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("WARC-Payload-Length: "), F.octet_length("html").cast("string")),
        F.when(~fresh, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">"))),
        F.when(~fresh, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    record = F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)
    writer = rows.select(record.alias("value")).write.option("lineSep", END).option("compression", compression)
    writer.option("maxRecordsPerFile", records_per_file).text(path)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, block, row (their order within a block), value: the bytes after each version line."""
    cut = spark.read.option("lineSep", f"{VERSION}\r\n").text(path)
    return cut.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), "value")


def located(parts: DataFrame) -> DataFrame:
    """Adds place, where a piece begins in its file, given its size n: sizes before it are summed
    within its block, then the few blocks of a file."""
    cut = len(VERSION) + 2
    inner = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("upto", F.sum(F.col("n") + cut).over(inner))
    blocks = parts.groupBy("file", "block").agg(F.max("upto").alias("length"))
    outer = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("length").over(outer), F.lit(0)).alias("base"))
    return parts.join(blocks, ["file", "block"]).withColumn(
        "place", F.col("base") + F.col("upto") - F.col("n") - cut).drop("base", "upto")


def field(name: str) -> Column:
    return F.nullif(F.regexp_extract("head", rf"(?im)^{name}:[ \t]*(.*?)[ \t]*\r?$", 1), F.lit(""))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """A row per version line in the archives, whatever it stands in: file, block, begin (its
    offset), next (the record after it; null without a valid length) and the header's fields.
    whole: no other version line stands in its payload, whose digest then is `own_digest`."""
    head = F.substring_index("value", END, 1)
    data = F.col("value").cast("binary")
    read = pieces(spark, path).withColumns({"n": F.octet_length("value"), "head": head}).withColumns({
        "skip": F.octet_length("head") + 4, "length": field("Content-Length").try_cast("bigint")})
    whole = F.col("n") == F.col("skip") + F.col("length") + 4
    body = F.when(whole, F.expr("substring(CAST(value AS BINARY), skip + 1, CAST(length AS INT))"))
    narrow = read.select(
        "file", "block", "row", "n", "length",
        F.when(F.col("skip") <= F.octet_length(data), F.col("skip") + F.col("length") + 4).alias("reach"),
        F.coalesce(whole, F.lit(False)).alias("whole"), base32_sha1(body).alias("own_digest"),
        field("WARC-Type").alias("record_type"), field("WARC-Record-ID").alias("record_id"),
        field("WARC-Target-URI").alias("url"), field("WARC-Refers-To").alias("refers_to_id"),
        field("WARC-Payload-Digest").alias("told_digest"), field("WARC-Payload-Length").try_cast("bigint").alias("told_length"))
    cut = len(VERSION) + 2
    placed = located(narrow).filter(F.col("place") >= cut)  # what stands before the first version line is no record
    return placed.withColumns({"begin": F.col("place") - cut, "next": F.col("place") + F.col("reach")}).drop(
        "row", "reach", "place", "n")


def follow(begin: np.ndarray, nxt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pointers of sorted candidates within a block: index of the next (own index at an end), and
    the offset beyond the block where a chain leaves it, or -1."""
    to = np.searchsorted(begin, nxt)
    inside = (to < len(begin)) & (begin[np.minimum(to, len(begin) - 1)] == nxt)
    pointer = np.where(inside, to, np.arange(len(begin)))
    return pointer, np.where(~inside & (nxt > begin[-1]), nxt, -1)


def _exits(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("begin", ignore_index=True)
    pointer, out = follow(pdf["begin"].to_numpy(), pdf["next"].fillna(-1).to_numpy(np.int64))
    for _ in range(max(1, math.ceil(math.log2(len(pdf) + 1)))):
        pointer = pointer[pointer]
    return pd.DataFrame({"file": pdf["file"], "begin": pdf["begin"], "exit": out[pointer]})


def _reached(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("begin", ignore_index=True)
    pointer, _ = follow(pdf["begin"].to_numpy(), pdf["next"].fillna(-1).to_numpy(np.int64))
    reached = pdf["entry"].to_numpy(bool).copy()
    for _ in range(max(1, math.ceil(math.log2(len(pdf) + 1)))):
        reached[pointer[reached]] = True
        pointer = pointer[pointer]
    return pdf.loc[reached, ["file", "begin"]]


def verified(found: DataFrame) -> DataFrame:
    """file, begin of the candidates that the chain from their file's start reaches."""
    narrow = found.select("file", "block", "begin", "next")
    most = narrow.groupBy("file").agg(F.countDistinct("block").alias("n")).agg(F.max("n")).first()[0] or 0
    entries = narrow.filter("begin = 0").select("file", "begin")
    if most > 1:
        jumps = write_and_read(narrow.groupBy("file", "block").applyInPandas(
            _exits, "file string, begin bigint, exit bigint").filter("exit >= 0"), "warc-exits")
        for _ in range(math.ceil(math.log2(most))):
            step = jumps.select("file", F.col("begin").alias("exit"), F.col("exit").alias("_then"))
            entries = cut_lineage(entries.union(entries.join(jumps, ["file", "begin"]).select("file", "exit")).distinct())
            jumps = cut_lineage(jumps.join(step, ["file", "exit"]).select("file", "begin", F.col("_then").alias("exit")))
    marked = narrow.join(entries.withColumn("entry", F.lit(True)), ["file", "begin"], "left").fillna(False, ["entry"])
    return marked.groupBy("file", "block").applyInPandas(_reached, "file string, begin bigint")


def payloads(spark: SparkSession, path: str, records: DataFrame) -> DataFrame:
    """file, begin, payload of given records (file, begin, next, length), put together from all
    pieces that they span. Shuffles the texts of the files concerned."""
    wanted = records.select("file", "begin", "next", "length")
    texts = pieces(spark, path).join(wanted.select("file").distinct(), "file", "left_semi")
    cut = len(VERSION) + 2
    placed = located(texts.withColumn("n", F.octet_length("value")))
    inside = (F.col("place") >= F.col("begin") + cut) & (F.col("place") < F.col("next"))
    spans = placed.join(wanted, "file").filter(inside)
    joined = spans.groupBy("file", "begin", "length").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]),
                     f"{VERSION}\r\n").alias("value"))
    skip = F.octet_length(F.substring_index("value", END, 1)) + 4
    return joined.withColumn("skip", skip).select(
        "file", "begin", F.expr("substring(CAST(value AS BINARY), skip + 1, CAST(length AS INT))").alias("payload"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """Verified records: file, begin, record_type, record_id, url, refers_to_id, payload_bytes,
    payload_digest. Digests of responses are computed from what was read; a revisit has those
    that its header tells. An empty folder gives no rows."""
    found = write_and_read(candidates(spark, path), "warc-candidates")
    kept = write_and_read(found.join(verified(found), ["file", "begin"]), "warc-records")
    split = kept.filter(~F.col("whole"))
    if split.isEmpty():
        kept = kept.withColumn("digest", F.col("own_digest"))
    else:
        mended = payloads(spark, path, split).select("file", "begin", base32_sha1(F.col("payload")).alias("mended"))
        kept = kept.join(mended, ["file", "begin"], "left").withColumn("digest", F.coalesce("own_digest", "mended"))
    again = F.col("record_type") == "revisit"
    return kept.select(
        "file", "begin", "record_type", "record_id", "url", "refers_to_id",
        F.when(again, F.col("told_length")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(again, F.regexp_replace("told_digest", "^sha1:", "")).otherwise(F.col("digest")).alias("payload_digest"))


def page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, "<urn:page:(-?[0-9]+)>", 1).try_cast("bigint")
