import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from samples import RATES, rates, utc

from basketry.operators.asof import asof_join
from basketry.operators.fx import fx_asof

LEFT, RIGHT = "n long, k string, t timestamp, extra string", "k string, t timestamp, v double, extra string"
START = utc("2011-01-01")


def moment(minutes):
    return None if minutes is None else START + timedelta(minutes=minutes)


def plain(left, right):
    """The definition, row by row."""
    out = []
    for n, k, t, _ in left:
        fits = [r for r in right if r[0] == k and r[1] is not None and t is not None and r[1] <= t]
        last = max((r[1] for r in fits), default=None)
        found = [r[2] for r in fits if r[1] == last]
        out.append((n, max((v for v in found if v is not None), default=None)))
    return sorted(out, key=str)


def joined(spark, left, right, ranges):
    both = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "t", "t", ["k"], ["v"], ranges)
    assert both.columns == ["n", "k", "t", "extra", "v"]
    return sorted(((r["n"], r["v"]) for r in both.collect()), key=str)


@pytest.mark.parametrize("ranges", [1, 3, 13])
def test_equals_the_definition(spark, ranges):
    some = random.Random(ranges)
    # One key holds most rows, so it runs over many ranges; few moments make ties.
    key = lambda: some.choice(["hot"] * 8 + ["a", "b", None, ""])
    time = lambda: moment(some.choice([None, *range(60)]))
    left = [(n, key(), time(), "x") for n in range(400)]
    right = [(key(), time(), some.choice([None, float(some.randrange(9))]), "y") for _ in range(120)]
    left += left[:20]
    assert joined(spark, left, right, ranges) == plain(left, right)


def test_values_are_carried_over_ranges_without_any(spark):
    left = [(n, "hot", moment(n), "x") for n in range(1, 300)] + [(1000, "later", moment(0), "x")]
    right = [("hot", moment(0), 7.0, "y")]
    assert joined(spark, left, right, 9) == plain(left, right)
    # The latest row counts, though its value is null.
    right.append(("hot", moment(150), None, "y"))
    assert joined(spark, left, right, 9) == plain(left, right)


def test_many_rows_at_one_moment_are_spread(spark):
    left = [(n, "hot", moment(5), str(n)) for n in range(300)]
    right = [("hot", moment(5), float(v), "y") for v in range(50)]
    assert joined(spark, left, right, 8) == [(n, 49.0) for n in sorted(range(300), key=lambda n: str((n, 49.0)))]


def test_empty_sides(spark):
    assert joined(spark, [], [("a", moment(1), 1.0, "y")], 4) == []
    assert joined(spark, [(1, "a", moment(1), "x")], [], 4) == [(1, None)]


def test_a_value_with_a_name_of_the_left_is_refused(spark):
    left = spark.createDataFrame([(1, "a", moment(1), "x")], LEFT)
    with pytest.raises(ValueError, match="already has"):
        asof_join(left, left, "t", "t", ["k"], ["N"])


def test_equals_the_join_by_days(spark):
    days = spark.sql("select explode(sequence(date'2010-12-30', date'2011-01-14')) as invoice_day")
    by_days = fx_asof(days, rates(spark)).filter("not is_fallback").select("invoice_day", "fx_rate_gbp_eur")
    by_rows = asof_join(days, rates(spark), "invoice_day", "date", [], ["fx_rate_gbp_eur"], 4)
    assert sorted(by_rows.dropna().collect()) == sorted(by_days.collect()) and by_rows.count() == 16
    assert by_days.count() == 14 and len(RATES) == 5


def test_rates_of_a_time_of_day(spark):
    lines = spark.createDataFrame([(i, moment(m)) for i, m in enumerate((-1, 0, 30, 59, 60, 1500))], "n long, t timestamp")
    quotes = spark.createDataFrame([(moment(0), 1.1), (moment(60), 1.2)], "at timestamp, rate double")
    found = asof_join(lines, quotes, "t", "at", [], ["rate"], 3)
    assert [r["rate"] for r in found.orderBy("n").collect()] == [None, 1.1, 1.1, 1.1, 1.2, 1.2]


def test_a_hot_key_is_cut_into_ranges(spark, monkeypatch):
    import basketry.operators.asof as asof

    kept = []
    monkeypatch.setattr(asof, "stage", lambda df, name: kept.append(df.cache()) or kept[0])
    left = spark.range(20_000).select(
        F.col("id").alias("n"), F.lit("hot").alias("k"), F.timestamp_seconds("id").alias("t"), F.lit("x").alias("extra")
    )
    right = left.filter("n % 10 = 0").select("k", "t", F.col("n").cast("double").alias("v"))
    found = asof_join(left, right, "t", "t", ["k"], ["v"], 8)
    assert found.filter("v != n - n % 10 or v is null").isEmpty()
    assert max(r["count"] for r in kept[0].groupBy("range").count().collect()) < 22_000 / 4
    kept[0].unpersist()
