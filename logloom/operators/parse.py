"""Log lines to typed events and rejects: one projection, no Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.text import escape_nul, is_plain, mask_message, split_blanks, strip, template_id

NORMAL_LABEL = "-"
#: Header fields, severities and the accepted span of epochs (2000 to 2050).
HEADER_FIELDS = 9
SEVERITIES = ("INFO", "WARNING", "ERROR", "SEVERE", "FATAL", "FAILURE")
ERROR_SEVERITIES = ("ERROR", "SEVERE", "FATAL", "FAILURE")
EPOCHS = (946_684_800, 2_524_608_000)
DATE = r"(?U)^\d{4}\.\d{2}\.\d{2}$"
DATETIME = r"(?U)^\d{4}-\d{2}-\d{2}-\d{2}\.\d{2}\.\d{2}\.\d{6}$"


def _reason(line: Column, plain: Column, stripped: Column, parts: Column, epoch: Column) -> Column:
    """The first check that fails names the reason; null for a good line."""
    part = lambda i: F.get(parts, F.lit(i))
    return (
        F.when(~plain & (~F.is_valid_utf8(line) | F.contains(line, F.lit("\ufffd"))), "undecodable_bytes")
        .when(~plain & F.contains(line, F.lit("\x00")), "nul_byte")
        .when(stripped == "", "empty_line")
        .when(F.size(parts) < HEADER_FIELDS, "too_few_fields")
        .when(~part(1).rlike(r"^\d+$") | epoch.isNull() | ~epoch.between(*EPOCHS), "bad_epoch")
        .when(~part(2).rlike(DATE), "bad_date")
        .when(~part(4).rlike(DATETIME), "bad_datetime")
        .when(~F.upper(part(8)).isin(*SEVERITIES), "unknown_severity")
    )


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row, however often it is used.

    A generator is not merged with the projections around it, as a plain
    projection would be.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def parse(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Each line (source_file, line_no, value) with reason and the parsed fields.

    keep: further columns to carry along. Null lines are empty ones.
    """
    value = F.coalesce(F.col("value"), F.lit(""))
    ended = F.endswith("_raw", F.lit("\n")) | F.endswith("_raw", F.lit("\r"))
    line = F.when(ended, F.rtrim(F.rtrim("_raw", F.lit("\n")), F.lit("\r"))).otherwise(F.col("_raw"))
    cut = lines.select("source_file", "line_no", *keep, value.alias("_raw"))
    cut = _once(cut, "_line", F.struct(line.alias("line"), is_plain(line).alias("plain")))
    plain = F.col("_line.plain")
    cut = _once(cut, "_stripped", strip(F.col("_line.line"), plain))
    cut = _once(cut, "_parts", split_blanks(F.col("_stripped"), HEADER_FIELDS + 1, plain))
    part = lambda i: F.get("_parts", F.lit(i))
    epoch = part(1).try_cast("bigint")
    out = _once(cut, "_facts", F.struct(_reason(F.col("_line.line"), plain, F.col("_stripped"), F.col("_parts"), epoch).alias("reason"), epoch.alias("epoch")))
    message = F.coalesce(part(HEADER_FIELDS), F.lit(""))
    # Plain columns, so that masks and digests are left out where nobody reads them.
    template = mask_message(message, plain)
    return out.select(
        "source_file",
        "line_no",
        *keep,
        "_facts.reason",
        F.col("_raw").alias("value"),
        F.timestamp_seconds("_facts.epoch").alias("event_time"),
        "_facts.epoch",
        part(3).alias("node"),
        part(6).alias("event_type"),
        part(7).alias("component"),
        F.upper(part(8)).alias("severity"),
        part(0).alias("label"),
        (part(0) != NORMAL_LABEL).alias("is_alert"),
        template_id(template).alias("template_id"),
        F.sha2(message, 256).alias("line_sha256"),
        message.alias("message"),
        template.alias("template"),
    )


def good(parsed: DataFrame) -> DataFrame:
    """The events of parsed lines."""
    return parsed.filter(F.col("reason").isNull()).drop("reason", "value")


def rejects(parsed: DataFrame) -> DataFrame:
    """The quarantined lines: source_file, line_no, reason, raw_line."""
    raw = escape_nul(F.rtrim("value", F.lit("\n")))
    return parsed.filter(F.col("reason").isNotNull()).select("source_file", "line_no", "reason", raw.alias("raw_line"))
