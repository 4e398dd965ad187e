"""Subtitle time codes and RIFF header fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lectern.functions.folds import let


def parse_ms(value: Column) -> Column:
    """'HH:MM:SS,mmm' or '.mmm' -> milliseconds; null when malformed.

    A comma wins over a point; the fraction is padded or cut to three digits.
    """
    code = (
        r"(?s)\A\s*([+-]?\d+)\s*:\s*([+-]?\d+)\s*:\s*([+-]?\d+)\s*"
        r"(?:,([^,]*)|\.([^.,]*))\z"
    )

    def part(i: int) -> Column:
        return F.regexp_extract(value, code, i).try_cast("bigint")

    # Only one of the two fraction groups matches, the other is empty.
    fraction = F.concat(F.regexp_extract(value, code, 4), F.regexp_extract(value, code, 5))
    millis = F.trim(F.rpad(fraction, 3, "0")).try_cast("bigint")
    return (part(1) * 3600 + part(2) * 60 + part(3)) * 1000 + millis


def format_ms(ms: Column) -> Column:
    """Milliseconds -> 'HH:MM:SS,mmm'; negatives show as zero."""
    at = F.greatest(ms.cast("bigint"), F.lit(0))
    s = F.floor(at / 1000)
    return F.format_string(
        "%02d:%02d:%02d,%03d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60, at % 1000
    )


def _little_endian(content: Column, at: Column, width: int) -> Column:
    digits = F.hex(F.substring(content, at + 1, F.lit(width)))
    pairs = [F.substring(digits, 2 * i - 1, 2) for i in range(width, 0, -1)]
    return F.conv(F.concat(*pairs), 16, 10).cast("bigint")


def wav_seconds(content: Column, nominal: Column, usual_chunks: int = 64) -> Column:
    """Frames / frame rate read from a RIFF header, else the nominal length.

    Walks the chunk list to 'fmt ' and 'data'. A file whose samples do not begin
    within ``usual_chunks`` chunks is walked to its end (a chunk has 8 bytes at least).
    """
    def tag(at: Column, width: int = 4) -> Column:
        return F.hex(F.substring(content, at + 1, F.lit(width)))

    riff, wave, fmt, data = "52494646", "57415645", "666D7420", "64617461"
    total = F.length(content)
    zero = F.struct(
        F.lit(12).cast("bigint").alias("at"), F.lit(None).cast("bigint").alias("rate"),
        F.lit(None).cast("bigint").alias("frame"), F.lit(None).cast("bigint").alias("bytes"),
    )

    def step(acc: Column, _: Column) -> Column:
        live = acc["bytes"].isNull() & (acc["at"] + 8 <= total)
        name = tag(acc["at"])
        size = _little_endian(content, acc["at"] + 4, 4)
        is_fmt = live & (name == fmt) & (size >= 16)
        body = acc["at"] + 8
        known = _little_endian(content, body, 2).isin(1, 0xFFFE)
        width = F.floor((_little_endian(content, body + 14, 2) + 7) / 8)
        frame = _little_endian(content, body + 2, 2) * width
        return F.struct(
            F.when(live, body + size + size % 2).otherwise(acc["at"]).alias("at"),
            F.when(is_fmt & known, _little_endian(content, body + 4, 4)).otherwise(acc["rate"]).alias("rate"),
            F.when(is_fmt & known, frame).otherwise(acc["frame"]).alias("frame"),
            F.when(live & (name == data), size).otherwise(acc["bytes"]).alias("bytes"),
        )

    def walk(acc: Column) -> Column:
        rest = F.aggregate(F.sequence(F.lit(0), F.floor((total - acc["at"]) / 8).cast("int")), acc, step)
        return F.when(acc["bytes"].isNull() & (acc["at"] + 8 <= total), rest).otherwise(acc)

    walked = let(F.aggregate(F.sequence(F.lit(1), F.lit(usual_chunks)), zero, step), walk)
    seconds = let(
        walked,
        lambda w: F.when(
            (w["rate"] > 0) & (w["frame"] > 0) & w["bytes"].isNotNull(),
            F.floor(w["bytes"] / w["frame"]).cast("double") / w["rate"].cast("double"),
        ),
    )
    is_wav = (tag(F.lit(0)) == riff) & (tag(F.lit(8)) == wave)
    return F.coalesce(F.when(is_wav, seconds), nominal.cast("double"))
