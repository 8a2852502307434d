import random
from collections import Counter, defaultdict
from datetime import date, timedelta
from decimal import Decimal
from statistics import median

import pytest
from samples import countries, line, rates, sales, utc

from basketry.operators.topk import kth_largest
from basketry.plans import insights
from basketry.plans.transform import to_fact


def lines(spark, *rows):
    """(invoice, customer, country, day, stock, description, revenue) -> lines."""
    names = "invoice_no string, customer_id string, country string, invoice_date timestamp, stock_code string"
    data = [(i, c, n, utc(d), s, t, float(v)) for i, c, n, d, s, t, v in rows]
    return spark.createDataFrame(data, f"{names}, description string, revenue_eur double")


UK, FR = "united kingdom", "france"
SMALL = [
    ("i1", "c1", UK, "2011-01-03", "s1", "one", 10),
    ("i1", "c1", UK, "2011-01-03", "s2", "two", 20),
    ("i2", "c1", UK, "2011-02-07", "s1", "one", 30),
    ("i3", "c2", FR, "2011-03-06T23:59:59", "s3", None, 25),
    ("i4", "c3", None, "2011-03-05", "s1", "uno", 15),
    ("i4", "c3", "spain", "2011-03-05", None, "x", 5),
]


@pytest.fixture(scope="module", params=["lines", "rollup"])
def small(spark, request):
    plain = lines(spark, *SMALL)
    return plain if request.param == "lines" else insights.invoice_rollup(plain)


def test_headline(small):
    row = insights.headline_metrics(small).first().asDict()
    assert row == {
        "total_revenue": 105.0, "customers": 3, "invoices": 4, "transactions": 6,
        "first_day": date(2011, 1, 3), "last_day": date(2011, 3, 6), "average_order_value": 26.25,
    }
    text = insights.headline_text(small).first().asDict()
    assert text["total_revenue"] == "€105" and text["average_order_value"] == "€26"
    assert text["period"] == "2011-01-03 → 2011-03-06" and text["transactions"] == "6"


def test_countries(small):
    assert [tuple(r) for r in insights.revenue_by_country(small).collect()] == [(UK, 60.0), (FR, 25.0), ("spain", 5.0)]


def test_home_market(small):
    row = insights.home_market_share(small).first()
    assert row["home_share_pct"] == 100 * 60 / 105
    assert (row["next5_markets"], row["next5_revenue"]) == ("france, spain", 30.0)
    assert row["next5_share_pct"] == 100 * 30 / 105
    assert insights.home_market_share(small, "narnia").first()["home_revenue"] is None


def test_months(small):
    assert [tuple(r) for r in insights.revenue_by_month(small).collect()] == [
        ("2011-01", 30.0), ("2011-02", 30.0), ("2011-03", 45.0)
    ]
    assert [r["month"] for r in insights.top_months(small, 2).collect()] == ["2011-03", "2011-01"]
    assert tuple(insights.peak_month(small).first()) == ("2011-03", 45.0, 30.0, 1.5)


def test_first_of_equal_months_is_the_peak(spark):
    equal = [("i", "c", UK, d, "s", "t", 7) for d in ("2011-05-01", "2011-02-01", "2012-01-01")]
    assert insights.peak_month(lines(spark, *equal)).first()["peak_month"] == "2011-02"


def test_concentration(small):
    row = insights.customer_concentration(small).first()
    assert (row["customers"], row["top1pct_customers"], row["top10_share_pct"]) == (3, 1, 100.0)
    assert row["top1pct_share_pct"] == 100 * 60 / 105


def test_repeat_customers(small):
    row = insights.repeat_customers(small).first()
    assert row["customers"] == 3 and row["one_off_pct"] == pytest.approx(200 / 3)
    assert row["one_off_pct"] + row["repeat_pct"] == 100


def test_products_without_code_or_description_are_left_out(spark):
    found = insights.top_products(lines(spark, *SMALL)).collect()
    assert [(r["stock_code"], r["description"], r["revenue"], r["revenue_text"]) for r in found] == [
        ("s1", "one", 40.0, "€40"), ("s2", "two", 20.0, "€20"), ("s1", "uno", 15.0, "€15")
    ]


def test_weekdays(small):
    week = {r["weekday"]: r["revenue"] for r in insights.weekday_revenue(small).collect()}
    assert list(week) == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    assert {k: v for k, v in week.items() if v} == {"Monday": 60.0, "Saturday": 20.0, "Sunday": 25.0}
    present = insights.weekday_revenue(small, keep_absent=False)
    assert [r["weekday"] for r in present.collect()] == ["Monday", "Saturday", "Sunday"]


def test_trend_and_customers(small):
    assert insights.revenue_trend(small).first()["day"] == date(2011, 1, 3)
    assert [tuple(r) for r in insights.high_value_customers(small, 2).collect()] == [("c1", 60.0, 2), ("c2", 25.0, 1)]


def test_no_lines(spark):
    none = lines(spark)
    assert insights.headline_metrics(none).first()["total_revenue"] is None
    assert insights.customer_concentration(none).first()["customers"] == 0
    assert insights.top_products(none).count() == 0


def test_constant_rate_keeps_the_feeds_text(spark):
    rows = insights.constant_rate_lines(sales(spark)).orderBy("invoice_no").collect()
    assert [(r["customer_id"], r["revenue_eur"]) for r in rows] == [("c1", Decimal("8.775")), (" N5\t", Decimal("9.36"))]


def test_regions(spark):
    fact = to_fact(sales(spark, [line("A"), line("A"), line("B", Country="Atlantis")]), countries(spark), rates(spark))
    assert [tuple(r) for r in insights.revenue_by_region(fact).collect()] == [("Europe", 24.0, 1), ("unknown", 12.0, 1)]


def test_all_insights_agree_with_brute_force_on_skewed_lines(spark):
    """A third of all lines belong to one customer, another third are copies of one line."""
    chance = random.Random(23)
    start = utc("2011-01-01")
    rows = []
    for i in range(1500):
        kind = i % 3
        customer = "hot" if kind == 0 else "copy" if kind == 1 else f"c{chance.randint(0, 400)}"
        invoice = "i-copy" if kind == 1 else f"i{chance.randint(0, 300)}"
        day = start if kind == 1 else start + timedelta(days=chance.randint(0, 300))
        value = 3.5 if kind == 1 else chance.randint(1, 10**6) / 10**4
        rows.append((invoice, customer, chance.choice([UK, FR, None]), day.isoformat()[:10],
                     f"s{chance.randint(0, 30)}", "t", value))
    tables = insights.all_insights(lines(spark, *rows).repartition(5))

    total = sum(Decimal(str(r[6])) for r in rows)
    spent, invoices, months, products = Counter(), defaultdict(set), Counter(), Counter()
    for invoice, customer, _, day, stock, _, value in rows:
        spent[customer] += Decimal(str(value))
        invoices[customer].add(invoice)
        months[day[:7]] += Decimal(str(value))
        products[stock] += Decimal(str(value))
    ranked = sorted(spent.values(), reverse=True)
    few = max(1, int(len(ranked) * 0.01))

    headline = tables["headline_metrics"].first()
    assert (headline["total_revenue"], headline["transactions"]) == (float(total), 1500)
    assert headline["invoices"] == len({r[0] for r in rows})
    shares = tables["customer_concentration"].first()
    assert shares["top1pct_customers"] == few > 1
    assert shares["top10_share_pct"] == pytest.approx(float(100 * sum(ranked[:10]) / total), rel=1e-14)
    assert shares["top1pct_share_pct"] == pytest.approx(float(100 * sum(ranked[:few]) / total), rel=1e-14)
    one_off = sum(len(v) == 1 for v in invoices.values())
    assert tables["repeat_customers"].first()["one_off_pct"] == 100 * one_off / len(invoices)
    peak = tables["peak_month"].first()
    assert peak["peak_revenue"] == float(max(months.values()))
    assert peak["median_month_revenue"] == median(map(float, months.values()))
    best = [(r["stock_code"], r["revenue"]) for r in tables["top_products"].collect()]
    assert best == [(k, float(v)) for k, v in products.most_common(10)]


@pytest.mark.parametrize("buckets", [2, 7, 1024])
def test_kth_largest_agrees_with_sorting(spark, buckets):
    chance = random.Random(41)
    spread = [Decimal(chance.randint(0, 10 ** chance.randint(1, 12))) / 10**4 for _ in range(60)]
    values = spread + [Decimal("7.0001")] * 40 + [Decimal("-3")] * 5
    frame = spark.createDataFrame([(v,) for v in values], "v decimal(28,4)").repartition(4)
    ranked = sorted(values, reverse=True)
    for k in (1, 2, 50, 70, 99, 105):
        assert kth_largest(frame, "v", k, buckets=buckets) == ranked[k - 1]


def test_kth_largest_of_equal_values(spark):
    frame = spark.createDataFrame([(Decimal("1.5"),)] * 9, "v decimal(28,4)")
    assert kth_largest(frame, "v", 5) == Decimal("1.5")
