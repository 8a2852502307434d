"""Sales, countries and rates derived from the star-schema test tables.

The tables hold no dirty lines; the derivation adds cancelled lines, free items, anonymous customers,
feed-style country names, an unmatched country, lines without a product code, long descriptions, a weekday
without sales, weekend gaps and days before the first rate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.schemas import SALES
from basketry.session import dropping_shuffles, setting

# Nation key -> name in the sales feed and in the countries data.
_FEED_NAMES = {
    1: "EIRE", 2: "USA", 3: "RSA", 4: "Channel Islands", 5: " Czech Republic ", 6: "Unspecified",
    7: "United Kingdom",
}
_COUNTRY_NAMES = {
    1: "Ireland", 2: "United States", 3: "South Africa", 4: "Jersey", 5: "Czechia", 6: "Narnia",
    7: "United Kingdom",
}
FIRST_RATED_DAY = "1995-01-10"
# Lines of a packed file, which a scan cannot split.
_PACKED_LINES = 100_000


# Only the columns in use; declaring them saves reading file footers for every query.
_COLUMNS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "part": "p_partkey bigint, p_name string, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _named(names: dict[int, str]):
    entries = [F.lit(part) for pair in names.items() for part in pair]
    return F.coalesce(F.create_map(*entries)[F.col("n_nationkey")], F.col("n_name"))


def sales(spark: SparkSession, sf_dir: str, spread: int | None = None) -> DataFrame:
    """One sales line per line item. Small sides are broadcast by their measured file size.

    ``spread``: deal the lines to so many partitions first. That is a full shuffle, for callers who know that a table
    is one small file of one row group, which a scan cannot split; it is off by default.
    """
    buyers = _table(spark, sf_dir, "orders").join(_table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    lines = _table(spark, sf_dir, "lineitem").join(buyers, F.col("l_orderkey") == F.col("o_orderkey")).join(
        _table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey")
    )
    if spread:
        lines = lines.repartition(spread, "o_orderkey", "l_partkey")
    # Last, so names of nations are not shuffled with the lines.
    lines = lines.join(_table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    quantity = F.when(F.col("o_orderkey") % 41 == 0, -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    derived = {
        "InvoiceNo": F.col("o_orderkey"),
        "StockCode": F.when(F.col("l_partkey") % 97 != 0, F.col("l_partkey")),
        "Description": F.when(F.col("l_partkey") % 7 == 0, F.concat_ws(" of ", *["p_name"] * 6)).otherwise(F.col("p_name")),
        "Quantity": quantity,
        "UnitPrice": F.when(F.col("l_partkey") % 53 == 0, 0.0).otherwise(F.col("p_retailprice")),
        # The shop is closed on Sundays.
        "InvoiceDate": F.when(
            F.dayofweek("o_orderdate") == 1, F.col("o_orderdate") + F.expr("interval 1 day")
        ).otherwise(F.col("o_orderdate")),
        "CustomerID": F.when(
            F.col("o_orderkey") % 29 != 0, F.concat(F.lit("  C"), F.col("o_custkey").cast("string"), F.lit(" "))
        ),
        "Country": _named(_FEED_NAMES),
    }
    return lines.select(*[derived[f.name].cast(f.dataType).alias(f.name) for f in SALES])


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    return nation.join(region, F.col("r_regionkey") == F.col("n_regionkey")).select(
        _named(_COUNTRY_NAMES).alias("country"),
        F.col("r_name").alias("region"),
        (F.lit(1_000_000) + F.col("n_nationkey")).cast("bigint").alias("population"),
    )


def fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A made-up rate for every weekday with orders, from the first rated day on."""
    day = F.to_date(F.col("o_orderdate").cast("timestamp"))
    days = _table(spark, sf_dir, "orders").select(day.alias("date")).distinct()
    rate = F.lit(1.10) + (F.dayofmonth("date") % 20) / F.lit(100.0)
    weekday = ~F.dayofweek("date").isin(1, 7)
    return days.filter(weekday & (F.col("date") >= F.lit(FIRST_RATED_DAY).cast("date"))).select(
        "date", rate.cast("double").alias("fx_rate_gbp_eur")
    )


def land_sales(
    spark: SparkSession, sf_dir: str, folder: str, mark: str, spread: int | None = None, packed: bool = False
) -> dict[str, str]:
    """Write the derived sales as CSV files with a header, the lines up to ``mark`` and the newer ones apart.

    One scan writes both folders. Each task holds a file of both open, instead of sorting its lines by folder in memory.
    ``packed``: files take a quarter of the space and have a bounded number of lines.
    """
    part = F.when(F.col("InvoiceDate") <= F.lit(mark).cast("timestamp"), "early").otherwise("late")
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "2"), dropping_shuffles(spark):
        lines = sales(spark, sf_dir, spread).withColumn("part", part).write.partitionBy("part")
        if packed:
            lines = lines.options(**{"maxRecordsPerFile": _PACKED_LINES, "zlib.compress.level": "BEST_SPEED"})
        lines.csv(
            f"{folder}/sales",
            header=True,
            encoding="ISO-8859-1",
            compression="gzip" if packed else None,
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
    return {name: f"{folder}/sales/part={name}" for name in ("early", "late")}


def land_countries(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Write the countries as one JSON list of some 25 entries, and one without a name."""
    entry = F.struct(F.struct(F.col("country").alias("common")).alias("name"), "region", "population")
    listed = F.concat(F.collect_list(entry), F.array(F.first(entry).withField("name.common", F.lit(""))))
    countries(spark, sf_dir).agg(F.to_json(listed).alias("value")).write.text(f"{folder}/countries")
    return f"{folder}/countries"


def land_rates(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Write the rates as JSON lines, one per day."""
    rates = F.create_map(F.lit("EUR"), F.col("fx_rate_gbp_eur")).alias("rates")
    fx_rates(spark, sf_dir).select("date", rates).write.json(f"{folder}/fx")
    return f"{folder}/fx"
