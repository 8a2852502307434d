"""Business insights over sales lines.

Every insight takes ``lines``: the fact, or ``constant_rate_lines`` for figures straight from the
feed. Revenue is summed as a decimal, so totals do not depend on row order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.money import as_exact, exact_sum, share_pct
from basketry.functions.text import euros, percent, shorten, thousands, times
from basketry.functions.times import WEEKDAYS, iso_day, month, utc_day, weekday_name
from basketry.operators.clean import clean_sales
from basketry.functions.aggregates import one_row
from basketry.operators.topk import kth_largest, sum_down_to
from basketry.schemas import CONSTANT_FX_RATE
from basketry.session import stage

HOME_MARKET = "united kingdom"


def constant_rate_lines(sales: DataFrame, rate: float = CONSTANT_FX_RATE) -> DataFrame:
    """Cleaned lines at one fixed rate, text as it stands in the feed.

    Revenue is a decimal and not rounded: quantity times price (4 places) times rate (2 places).
    """
    eur = F.col("Quantity").cast("decimal(12,0)") * as_exact(F.col("UnitPrice")) * F.lit(rate).cast("decimal(4,2)")
    return clean_sales(sales).select(
        F.col("InvoiceNo").alias("invoice_no"),
        F.col("StockCode").alias("stock_code"),
        F.col("Description").alias("description"),
        F.col("InvoiceDate").alias("invoice_date"),
        F.col("CustomerID").alias("customer_id"),
        F.col("Country").alias("country"),
        eur.cast("decimal(34,6)").alias("revenue_eur"),
    )


def _revenue(lines: DataFrame) -> Column:
    """Exact revenue; a roll-up holds it as a decimal already."""
    if isinstance(lines.schema["revenue_eur"].dataType, T.DecimalType):
        return F.sum("revenue_eur")
    return exact_sum(F.col("revenue_eur"))


def invoice_rollup(lines: DataFrame) -> DataFrame:
    """Lines -> one row per invoice, customer, country and day; same columns where they remain.

    All insights but the products give the same answer on the roll-up, which is as much smaller as
    an invoice has lines.
    """
    day = utc_day("invoice_date").cast("timestamp").alias("invoice_date")
    return lines.groupBy("invoice_no", "customer_id", "country", day).agg(
        _revenue(lines).alias("revenue_eur"), F.count(F.lit(1)).alias("lines")
    )


def day_rollup(lines: DataFrame) -> DataFrame:
    """Lines or their invoice roll-up -> revenue per day and country, for insights that count neither invoices nor customers."""
    day = utc_day("invoice_date").cast("timestamp").alias("invoice_date")
    return lines.groupBy(day, "country").agg(_revenue(lines).alias("revenue_eur"))


def product_rollup(lines: DataFrame, *keys: str) -> DataFrame:
    """Revenue per product, within ``keys`` if there are any; lines without a code or a description are left out."""
    named = lines.filter(F.col("stock_code").isNotNull() & F.col("description").isNotNull())
    return named.groupBy(*keys, "stock_code", "description").agg(_revenue(named).alias("revenue_eur"))


def _by(lines: DataFrame, key: str) -> DataFrame:
    """Revenue per key, exact; missing keys are left out."""
    return lines.filter(F.col(key).isNotNull()).groupBy(key).agg(_revenue(lines).alias("exact_revenue"))


def _as_double(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("exact_revenue", "revenue").withColumn("revenue", F.col("revenue").cast("double"))


def headline_metrics(lines: DataFrame) -> DataFrame:
    """Revenue, customers, invoices, average order value, lines, first and last day.

    The two exact distinct counts run on lines already combined per invoice and customer.
    """
    pairs = lines.groupBy("invoice_no", "customer_id").agg(
        _revenue(lines).alias("revenue"),
        (F.sum("lines") if "lines" in lines.columns else F.count(F.lit(1))).alias("lines"),
        F.min("invoice_date").alias("first"),
        F.max("invoice_date").alias("last"),
    )
    return one_row(
        pairs,
        total_revenue=F.sum("revenue").cast("double"),
        customers=F.count_distinct("customer_id"),
        invoices=F.count_distinct("invoice_no"),
        transactions=F.sum("lines"),
        first_day=utc_day(F.min("first")),
        last_day=utc_day(F.max("last")),
    ).withColumn("average_order_value", F.col("total_revenue") / F.nullif("invoices", F.lit(0)))


def headline_text(lines: DataFrame) -> DataFrame:
    """The headline figures as a report prints them."""
    return headline_metrics(lines).select(
        F.concat_ws(" → ", iso_day("first_day"), iso_day("last_day")).alias("period"),
        euros(F.col("total_revenue")).alias("total_revenue"),
        thousands(F.col("customers")).alias("customers"),
        thousands(F.col("invoices")).alias("invoices"),
        euros(F.col("average_order_value")).alias("average_order_value"),
        thousands(F.col("transactions")).alias("transactions"),
    )


def revenue_by_country(lines: DataFrame) -> DataFrame:
    return _as_double(_by(lines, "country")).orderBy(F.desc("revenue"), "country")


def home_market_share(lines: DataFrame, home: str = HOME_MARKET) -> DataFrame:
    """Home market against the five next markets, as shares of all revenue.

    Shares are of all lines, those without a country included.
    """
    countries = lines.groupBy("country").agg(_revenue(lines).alias("revenue"))
    is_home = F.col("country") == home
    totals = one_row(
        countries,
        home_revenue=F.sum(F.when(is_home, F.col("revenue"))),
        total=F.sum("revenue"),
    )
    # Seven hold the next five whatever comes of home and of lines without a country. Leaving these two
    # out only afterwards keeps both uses of `countries` the same plan, so it is computed once.
    first7 = countries.orderBy(F.desc("revenue"), "country").limit(7)
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("revenue")).alias("order"), "country")))
    next5 = F.slice(F.filter("ranked", lambda m: m["country"].isNotNull() & (m["country"] != home)), 1, 5)
    wide = "decimal(38,6)"
    next5_revenue = F.aggregate(
        next5, F.lit(0).cast(wide), lambda total, m: (total - m["order"]).cast(wide)
    )
    return totals.withColumn("ranked", first7.agg(ranked).scalar()).select(
        F.lit(home).alias("home_market"),
        F.col("home_revenue").cast("double").alias("home_revenue"),
        share_pct(F.col("home_revenue"), F.col("total")).alias("home_share_pct"),
        F.array_join(F.transform(next5, lambda m: m["country"]), ", ").alias("next5_markets"),
        next5_revenue.cast("double").alias("next5_revenue"),
        share_pct(next5_revenue, F.col("total")).alias("next5_share_pct"),
    )


def _months(lines: DataFrame) -> DataFrame:
    return _as_double(_by(lines.select(month("invoice_date").alias("month"), "revenue_eur"), "month"))


def revenue_by_month(lines: DataFrame) -> DataFrame:
    return _months(lines).orderBy("month")


def top_months(lines: DataFrame, k: int = 5) -> DataFrame:
    return _months(lines).orderBy(F.desc("revenue"), "month").limit(k)


def peak_month(lines: DataFrame) -> DataFrame:
    """The first month with the highest revenue, against the median month."""
    # (revenue, -month number): the maximum is the highest revenue, of equals the earliest month.
    order = F.struct("revenue", -F.replace("month", F.lit("-"), F.lit("")).cast("int"))
    return one_row(
        _months(lines),
        peak_month=F.max_by("month", order),
        peak_revenue=F.max("revenue"),
        median_month_revenue=F.median("revenue"),
    ).withColumn("peak_vs_median", F.col("peak_revenue") / F.col("median_month_revenue"))


def customer_revenue(lines: DataFrame) -> DataFrame:
    return _by(lines, "customer_id")


def customer_concentration(lines: DataFrame) -> DataFrame:
    """Share of revenue from the 10 largest customers and from the largest 1 % of them (at least 1).

    The cut of the 1 % is found without sorting the customers into one task.
    """
    customers = stage(customer_revenue(lines), "customer-revenue")
    n = customers.count()
    k = max(1, int(n * 0.01))
    kth = F.lit(kth_largest(customers, "exact_revenue", k) if n else None).cast("decimal(38,6)")
    top10 = customers.orderBy(F.desc("exact_revenue")).limit(10).agg(F.sum("exact_revenue")).scalar()
    total = F.sum("exact_revenue")
    return one_row(
        customers,
        customers=F.count(F.lit(1)),
        top10_share_pct=share_pct(top10, total),
        top1pct_customers=F.lit(k).cast("bigint"),
        top1pct_share_pct=share_pct(sum_down_to("exact_revenue", kth, F.lit(k)), total),
    )


def repeat_customers(lines: DataFrame) -> DataFrame:
    """Share of customers with exactly one invoice, and of the others."""
    invoices = (
        lines.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.count_distinct("invoice_no").alias("invoices"))
    )
    return one_row(
        invoices,
        customers=F.count(F.lit(1)),
        one_off_pct=F.lit(100) * F.count_if(F.col("invoices") == 1) / F.nullif(F.count(F.lit(1)), F.lit(0)),
    ).withColumn("repeat_pct", F.lit(100) - F.col("one_off_pct"))


def top_products(lines: DataFrame, k: int = 10) -> DataFrame:
    """Best-selling products; lines without a code or a description are left out."""
    return (
        product_rollup(lines)
        .withColumn("revenue", F.col("revenue_eur").cast("double"))
        .orderBy(F.desc("revenue"), "stock_code", "description")
        .limit(k)
        .select(
            "stock_code",
            "description",
            shorten(F.col("description")).alias("description_short"),
            "revenue",
            euros(F.col("revenue")).alias("revenue_text"),
        )
    )


def weekday_revenue(lines: DataFrame, keep_absent: bool = True) -> DataFrame:
    """Revenue from Monday to Sunday; a day without sales is null, or left out."""
    name = F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.col("weekday_no"))
    numbers = lines.sparkSession.range(1, len(WEEKDAYS) + 1)
    days = numbers.select(F.col("id").cast("int").alias("weekday_no")).withColumn("weekday", name)
    sold = _as_double(_by(lines.select(weekday_name("invoice_date").alias("weekday"), "revenue_eur"), "weekday"))
    # Seven rows on either side.
    week = days.join(F.broadcast(sold), "weekday", "left" if keep_absent else "inner")
    return week.select("weekday_no", "weekday", "revenue").orderBy("weekday_no")


def revenue_by_region(fact: DataFrame) -> DataFrame:
    """Revenue and invoices per region."""
    invoices = fact.groupBy("region", "invoice_no").agg(_revenue(fact).alias("revenue"))
    return (
        invoices.groupBy("region")
        .agg(F.sum("revenue").cast("double").alias("revenue_eur"), F.count("invoice_no").alias("invoices"))
        .orderBy("region")
    )


def revenue_trend(fact: DataFrame) -> DataFrame:
    """Revenue per day."""
    days = fact.select(utc_day("invoice_date").alias("day"), "revenue_eur")
    return _as_double(_by(days, "day")).orderBy("day")


def high_value_customers(fact: DataFrame, k: int = 100) -> DataFrame:
    """The largest customers by revenue with their number of invoices."""
    invoices = fact.filter(F.col("customer_id").isNotNull()).groupBy("customer_id", "invoice_no")
    return (
        invoices.agg(_revenue(fact).alias("revenue"))
        .groupBy("customer_id")
        .agg(F.sum("revenue").cast("double").alias("revenue"), F.count("invoice_no").alias("invoices"))
        .orderBy(F.desc("revenue"), "customer_id")
        .limit(k)
    )


# How a report prints the figures of each insight; what is not named here is printed as it is.
HOME_FORMATS = {
    "home_revenue": euros, "home_share_pct": percent, "next5_revenue": euros, "next5_share_pct": percent,
}
PEAK_FORMATS = {"peak_revenue": euros, "median_month_revenue": euros, "peak_vs_median": times}
CONCENTRATION_FORMATS = {
    "customers": thousands, "top10_share_pct": percent, "top1pct_customers": thousands, "top1pct_share_pct": percent,
}
REPEAT_FORMATS = {"customers": thousands, "one_off_pct": percent, "repeat_pct": percent}


def as_text(table: DataFrame, formats: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """The figures of an insight as a report prints them."""
    return table.withColumns({name: show(F.col(name)) for name, show in formats.items()})


def insights_of_rollups(
    invoices: DataFrame, days: DataFrame, products: DataFrame, home: str = HOME_MARKET
) -> dict[str, DataFrame]:
    """Every insight of the report: from the invoice roll-up, and from revenue by day and country and by product."""
    return {
        "headline_metrics": headline_metrics(invoices),
        "home_market_share": home_market_share(days, home),
        "revenue_by_country": revenue_by_country(days),
        "peak_month": peak_month(days),
        "top_months": top_months(days),
        "customer_concentration": customer_concentration(invoices),
        "repeat_customers": repeat_customers(invoices),
        "top_products": top_products(products),
        "weekday_revenue": weekday_revenue(days, keep_absent=False),
    }


def all_insights(lines: DataFrame, home: str = HOME_MARKET) -> dict[str, DataFrame]:
    """Every insight of the report, from two scans of the lines: the staged roll-up and the products."""
    rollup = stage(invoice_rollup(lines), "invoice-rollup")
    return insights_of_rollups(rollup, rollup, lines, home)
