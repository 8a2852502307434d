import random
import struct
from datetime import datetime, timedelta, timezone

import numpy as np
from pyspark.sql import functions as F

from basketry.functions.keys import float_text, time_text
from basketry.functions.money import round_half_even
from basketry.functions.text import WHITESPACE, euros, missing_as_null, percent, shorten, strip, thousands
from basketry.functions.times import as_utc, from_micros, weekday_name
from basketry.schemas import NA_TOKENS


def test_float_text_is_what_python_prints(spark):
    values = [0.0, -0.0, 0.1, 1e7, 1.5e7, 123456789.125, 1e15, 9999999999999998.0, 1e16, 1.5e16, 1e22, 1e100,
              0.001, 0.0001, 0.00012345, 1e-5, 1.5e-5, 2.5e-300, -12345678.9, -0.0005,
              float("inf"), float("-inf"), float("nan")]
    chance = random.Random(7)
    values += [round(chance.uniform(0, 10 ** chance.randint(0, 9)), 2) for _ in range(3000)]
    values += [round(chance.uniform(1e-4, 1e-2), 6) for _ in range(500)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    wrong = [(r["v"], r["t"]) for r in frame.select("v", float_text(F.col("v")).alias("t")).collect()
             if r["t"] != str(r["v"])]
    assert wrong == []


def test_time_text_is_what_python_prints(spark):
    start = datetime(2011, 1, 1, tzinfo=timezone.utc)
    times = [start, start + timedelta(seconds=59), start + timedelta(microseconds=1200), start.replace(year=1999)]
    frame = spark.createDataFrame([(t,) for t in times], "t timestamp")
    shown = [r[0] for r in frame.select(time_text(F.col("t"))).collect()]
    assert shown == [str(t) for t in times]


def test_rounding_is_numpys(spark):
    chance = random.Random(3)
    values = [chance.randint(1, 10**9) / 10**5 for _ in range(20000)] + [0.00005, 0.00015, 2.5, -1.00005]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    rounded = [r[0] for r in frame.select(round_half_even(F.col("v"), 4)).collect()]
    assert [struct.pack("d", x) for x in rounded] == [struct.pack("d", x) for x in np.round(values, 4)]


def test_missing_tokens(spark):
    frame = spark.createDataFrame([(t,) for t in NA_TOKENS] + [("  ",), ("n.a.",), (None,)], "t string")
    kept = [r[0] for r in frame.select(missing_as_null(F.col("t"), NA_TOKENS)).collect()]
    assert [v for v in kept if v is not None] == ["  ", "n.a."]


def test_report_texts(spark):
    frame = spark.createDataFrame([("x" * 51, 1234567.5, 12.25), ("x" * 50, 2.5, 82.0)], "s string, v double, p double")
    shown = frame.select(shorten(F.col("s")), euros(F.col("v")), thousands(F.col("v")), percent(F.col("p"))).collect()
    for row, (s, v, p) in zip(shown, [("x" * 50 + "…", 1234567.5, 12.25), ("x" * 50, 2.5, 82.0)]):
        assert tuple(row) == (s, f"€{v:,.0f}", f"{v:,.0f}", f"{p:.1f}%")


def test_naive_times_are_utc():
    naive = datetime(2011, 12, 9, 12, 50)
    assert as_utc(naive) == naive.replace(tzinfo=timezone.utc)
    aware = datetime(2011, 12, 9, 12, 50, tzinfo=timezone(timedelta(hours=2)))
    assert as_utc(aware) is aware
    assert from_micros(1323435000000001) == datetime(2011, 12, 9, 12, 50, 0, 1, tzinfo=timezone.utc)
    assert from_micros(None) is None


def test_weekday_names(spark):
    days = spark.createDataFrame([(datetime(2011, 1, d, tzinfo=timezone.utc),) for d in (2, 3)], "t timestamp")
    assert [r[0] for r in days.select(weekday_name(F.col("t"))).collect()] == ["Sunday", "Monday"]


def test_strip_is_pythons(spark):
    ends = ["", " ", "  ", *WHITESPACE, " \t", "\u00a0 ", "\x00", "é", "!", "~", "\x7f"]
    values = [a + core + b for core in ("", "x", "a b", "ß\u3000ü") for a in ends for b in ends]
    frame = spark.createDataFrame([(v,) for v in [*values, None]], "v string")
    found = frame.select("v", strip(F.col("v")).alias("t")).collect()
    assert [r for r in found if r["t"] != (None if r["v"] is None else r["v"].strip(WHITESPACE))] == []
