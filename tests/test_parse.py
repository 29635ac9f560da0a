"""Parsing, masking and rejects of single lines."""

import hashlib
import random

import pytest

from logloom.functions import text
from logloom.functions.text import mask_message, page_offset, template_id
from logloom.operators.parse import good, parse, rejects
from logloom.sources.log_text import read_lines
from pyspark.sql import functions as F

FIELDS = {
    "label": "-",
    "epoch": "1262304061",
    "date": "2010.01.01",
    "node": "rack7/blade3",
    "stamp": "2010-01-01-00.01.01.000042",
    "again": "rack7/blade3",
    "type": "RAS",
    "component": "APP",
    "severity": "ERROR",
}


def line(message="", **changed):
    return " ".join((FIELDS | changed).values()) + message


def parsed(spark, *values):
    return parse(spark.createDataFrame([("f", i, v) for i, v in enumerate(values, 1)], "source_file string, line_no bigint, value string"))


def reasons(spark, values):
    return [r["reason"] for r in rejects(parsed(spark, *values)).orderBy("line_no").collect()]


def test_every_field_of_a_good_line(spark):
    row = good(parsed(spark, line("  fan \t speed low\r", label="FANS"))).first()
    for name, field in (("label", "label"), ("node", "node"), ("event_type", "type"), ("component", "component"), ("severity", "severity")):
        assert row[name] == (FIELDS | {"label": "FANS"})[field]
    assert row["epoch"] == int(FIELDS["epoch"]) and row["is_alert"]
    assert (row["message"], row["template"]) == ("fan \t speed low", "fan speed low")
    assert row["line_sha256"] == hashlib.sha256(row["message"].encode()).hexdigest()
    assert row["template_id"] == hashlib.sha1(row["template"].encode()).hexdigest()[:16]


@pytest.mark.parametrize("end", ["", " ", "\t\t", "\r"])
def test_message_may_be_empty_and_severity_of_any_case(spark, end):
    row = good(parsed(spark, line(end, severity="Warning"))).first()
    assert (row["severity"], row["message"], row["is_alert"]) == ("WARNING", "", False)


def test_a_line_cut_short_anywhere_has_too_few_fields(spark):
    parts = line().split(" ")
    assert reasons(spark, [" ".join(parts[:n]) for n in range(1, len(parts))]) == ["too_few_fields"] * (len(parts) - 1)


@pytest.mark.parametrize(
    ("field", "reason", "values"),
    [
        # One second before and after the span, signs, fractions, other digits, overflow.
        ("epoch", "bad_epoch", ["946684799", "2524608001", "-1262304061", "1262304061.5", "١٢٦", "9" * 30]),
        ("date", "bad_date", ["2010-01-01", "10.01.01", "today"]),
        ("stamp", "bad_datetime", ["2010-01-01T00:01:01", "2010-01-01-00.01", "noon"]),
        ("severity", "unknown_severity", ["DEBUG", "ERR", "errors"]),
    ],
)
def test_a_damaged_field_is_named(spark, field, reason, values):
    assert reasons(spark, [line(" m", **{field: v}) for v in values]) == [reason] * len(values)


def test_the_span_of_epochs_is_closed(spark):
    assert good(parsed(spark, line(epoch="946684800"), line(epoch="2524608000"))).count() == 2


def test_the_first_failing_check_gives_the_reason(spark):
    """Damage is added from the last check to the first; each addition takes over."""
    added = [("severity", "?", "unknown_severity"), ("stamp", "?", "bad_datetime"), ("date", "?", "bad_date"), ("epoch", "?", "bad_epoch")]
    changed, lines, want = {}, [], []
    for field, value, reason in added:
        changed[field] = value
        lines.append(line(" m", **changed))
        want.append(reason)
    lines += [" ".join(lines[-1].split(" ")[:3]), " \t\v ", None, "\x00", "\x00 �"]
    want += ["too_few_fields", "empty_line", "empty_line", "nul_byte", "undecodable_bytes"]
    assert reasons(spark, lines) == want


def test_reject_keeps_the_raw_line_with_nul_escaped(spark):
    assert rejects(parsed(spark, "half\x00line\r\n")).first()["raw_line"] == "half\\x00line\r"


@pytest.mark.parametrize(
    ("message", "template"),
    [
        ("lane 3 of 12 at 98.6 degrees", "lane <NUM> of <NUM> at <NUM> degrees"),
        ("v2 and 2v stay", "v2 and 2v stay"),
        ("offset 0xBEEF, mask 0x0", "offset <HEX>, mask <HEX>"),
        ("id cafe0123 and cafe012", "id <HEX> and cafe012"),
        ("peer 10.20.30.40:443 lost", "peer <IP>:<NUM> lost"),
        ("R31-M0-N9 and R31-M0-N9-I:J05-U01 swapped", "<NODE> and <NODE> swapped"),
        ("opened /var/log/x-1.txt then /tmp", "opened <PATH> then /tmp"),
        (" one\n\n two\v", "one two"),
    ],
)
def test_masks(spark, message, template):
    row = spark.createDataFrame([(message,)], "m string").select(mask_message(F.col("m")).alias("t"), template_id(mask_message(F.col("m"))).alias("i")).first()
    assert row["t"] == template
    assert row["i"] == hashlib.sha1(template.encode()).hexdigest()[:16]


def test_masks_leave_a_template_as_it_is(spark):
    once = mask_message(F.col("m"))
    df = spark.createDataFrame([("at 0x1 /a/b/c 7.5 R00-M0-N0 1.2.3.4",), ("",), ("plain",)], "m string").select(once.alias("m"))
    assert df.filter(F.col("m") != once).count() == 0


def test_line_numbers_over_many_blocks(spark, tmp_path):
    lines = [f"line {i}\rinside" if i % 7 == 0 else f"line {i}" for i in range(5000)]
    (tmp_path / "a.log").write_text("\n".join(lines) + "\n", newline="")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        out = read_lines(spark, str(tmp_path / "a.log"))
        assert spark.read.option("lineSep", "\n").text(str(tmp_path / "a.log")).rdd.getNumPartitions() > 1
        assert [r["value"] for r in out.orderBy("line_no").collect()] == lines
        assert [r[0] for r in read_lines(spark, str(tmp_path / "a.log"), 3).select("line_no").orderBy("line_no").collect()] == [1, 2, 3]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_page_offset(spark):
    df = spark.createDataFrame([(1117,), (-1,), (None,), (8245,)], "i bigint")
    assert [r[0] for r in df.select(page_offset(F.col("i"), 300, 8245)).collect()] == [900, 0, 0, 0]


def test_blanks_of_any_line_split_as_the_one_pattern_does(spark):
    from logloom.functions.text import BLANK_CHARS, BLANKS, mask_message, split_blanks

    odd = ["", "a", "a b c d", "a  b", "a b  c d e", " a b ", "é b c", "a\u00a0é b", "ſ\u2003b c", "a\x85b", "a\ufffdb c", "12 é  0x1f\u3000b", "x  10.0.0.1 \t y"]
    odd += [f"a{c}b {c}{c} c d" for c in BLANK_CHARS] + [f"7{c}b c\x00d {c}" for c in BLANK_CHARS]
    rows = spark.createDataFrame([(x,) for x in odd], "v string").union(spark.sql("SELECT cast(unhex(h) AS string) FROM VALUES ('6120806220C2'), ('61208520E22062'), ('61C28562') AS t(h)"))
    v = F.col("v")
    for limit in (2, 3, 10):
        assert rows.filter(~split_blanks(v, limit).eqNullSafe(F.split(v, BLANKS, limit))).count() == 0
    assert rows.filter(~mask_message(v).eqNullSafe(F.trim(F.regexp_replace(mask_message(v), BLANKS, " ")))).count() == 0
    assert rows.filter(mask_message(v).rlike(f"[{BLANK_CHARS[:-1].replace(' ', '')}]")).count() == 0


def test_short_masks_equal_all_masks(spark):
    """Random messages against the masks one after the other; those without rare parts take the short way in the plan."""
    rng = random.Random(8)
    parts = ["0x", "0x1F", "10.0.0.1", ".", "-M", "R02-M1-N0-C:J12-U11", "deadbeef", "DEADBEEF01", "/", "/a/b", "12", "3.5", "word", "k=", "_", " ", "  ", "\t", "\x1c", "\x0b", "é", "٣", "\u2003", "-", "12345678"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 7)))) for i in range(3_000)] + [(-1, None)]
    df = spark.createDataFrame(rows, "i int, m string")
    one = F.col("m")
    for pattern, mask in text.MASKS:
        one = F.regexp_replace(one, pattern, mask)
    want = F.trim(F.regexp_replace(one, text.BLANKS, " "))
    assert df.filter(~text.mask_message(F.col("m")).eqNullSafe(want)).count() == 0
    shown = df.select(text.mask_message(F.col("m")))._jdf.queryExecution().optimizedPlan().toString()
    assert "\\b\\d+" in shown.replace("(?U)\\b\\d+", "")


def test_plain_lines_are_stripped_and_split_without_patterns_and_as_others_are(spark, monkeypatch):
    from logloom.operators import parse as module

    good_line = "- 1117838570 2005.06.03 n1 2005-06-03-15.42.50.675872 n1 RAS KERNEL INFO core 17 at R02-M1-N0 0xff"
    ends = ("", " ", "\t", "\r", "\n", "\r\n", "\n\r\n", "\x0b", "\x1c", "\x1f", "\xa0", "　", "\x00", "�", "é")
    lines = [a + good_line + b for a in ends for b in ends]
    lines += [good_line.replace(" ", c, 1) for c in ends] + [good_line.replace("core", f"co{c}re") for c in ends] + ["", "   ", " \t", good_line[:40], good_line.replace(" ", "  ")]
    df = spark.createDataFrame([("f", i, v) for i, v in enumerate([*lines, None])], "source_file string, line_no bigint, value string")
    broken = df.filter("line_no < 8").withColumns({"line_no": F.col("line_no") + 10_000, "value": F.concat("value", F.unhex(F.lit("FF")).cast("string"))})
    df = df.unionByName(broken).persist()
    shown = module.good(module.parse(df))
    assert shown._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 3  # epoch, date, datetime
    fast = sorted(map(str, module.parse(df).collect()))
    monkeypatch.setattr(module, "is_plain", lambda text: F.lit(False))
    assert fast == sorted(map(str, module.parse(df).collect())) and len(fast) == df.count()
