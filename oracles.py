"""DuckDB SQL for the registered queries, over the driver's tables.

Each statement is the same chain of common table expressions with a last select; DuckDB runs only the
expressions the select refers to.
"""

from __future__ import annotations

from datetime import datetime

MARK = datetime(1998, 6, 30)
OVERLAP_END = datetime(1998, 12, 31)

_SOURCES = """
sales as (
  select cast(o.o_orderkey as varchar) as InvoiceNo,
    case when l.l_partkey % 97 <> 0 then cast(l.l_partkey as varchar) end as StockCode,
    case when l.l_partkey % 7 = 0
      then concat_ws(' of ', p.p_name, p.p_name, p.p_name, p.p_name, p.p_name, p.p_name)
      else p.p_name end as Description,
    cast(case when o.o_orderkey % 41 = 0 then -l.l_quantity else l.l_quantity end as bigint) as Quantity,
    case when l.l_partkey % 53 = 0 then 0.0e0 else p.p_retailprice end as UnitPrice,
    cast(o.o_orderdate as timestamp)
      + case when dayofweek(o.o_orderdate) = 0 then interval 1 day else interval 0 day end as InvoiceDate,
    case when o.o_orderkey % 29 = 0 then null
      else concat('  C', cast(o.o_custkey as varchar), ' ') end as CustomerID,
    case n.n_nationkey when 1 then 'EIRE' when 2 then 'USA' when 3 then 'RSA' when 4 then 'Channel Islands'
      when 5 then ' Czech Republic ' when 6 then 'Unspecified' when 7 then 'United Kingdom'
      else n.n_name end as Country
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey join part p on p.p_partkey = l.l_partkey
    join customer c on c.c_custkey = o.o_custkey join nation n on n.n_nationkey = c.c_nationkey),
countries as (
  select case n.n_nationkey when 1 then 'Ireland' when 2 then 'United States' when 3 then 'South Africa'
      when 4 then 'Jersey' when 5 then 'Czechia' when 6 then 'Narnia' when 7 then 'United Kingdom'
      else n.n_name end as country,
    r.r_name as region, cast(1000000 + n.n_nationkey as bigint) as population
  from nation n join region r on r.r_regionkey = n.n_regionkey),
fx as (
  select d as date, cast(1.10e0 + (extract(day from d) % 20) / 100.0e0 as double) as fx_rate_gbp_eur
  from (select distinct cast(o_orderdate as date) as d from orders) days
  where dayofweek(d) not in (0, 6) and d >= date '1995-01-10'),
cleaned as (
  select * from sales where CustomerID is not null and Quantity > 0 and UnitPrice > 0),
normalized as (
  select InvoiceNo, StockCode, Description, Quantity, UnitPrice, InvoiceDate,
    lower(trim(CustomerID)) as CustomerID, lower(trim(Country)) as Country,
    case lower(trim(Country)) when 'eire' then 'ireland' when 'channel islands' then 'jersey'
      when 'usa' then 'united states' when 'rsa' then 'south africa' when 'czech republic' then 'czechia'
      else lower(trim(Country)) end as country_key
  from cleaned),
countries_norm as (
  select lower(trim(country)) as country_key, region, population from countries),
joined as (
  select n.*, c.region, c.population from normalized n left join countries_norm c using (country_key)),
enriched as (
  select * replace (coalesce(region, 'unknown') as region, coalesce(population, 0) as population)
  from joined),
counters as (
  select count(*) as rows_in,
    count(*) filter (CustomerID is null) as dropped_missing_customer_id,
    count(*) filter (CustomerID is not null and Quantity <= 0) as dropped_non_positive_quantity,
    count(*) filter (CustomerID is not null and Quantity > 0 and UnitPrice <= 0) as dropped_non_positive_price,
    count(*) filter (CustomerID is not null and Quantity > 0 and UnitPrice > 0) as rows_out
  from sales),
days as (select distinct cast(InvoiceDate as date) as invoice_day from sales)"""


def _fact(name: str, lines: str = "true", rates: str = "true") -> str:
    """The fact of the lines and the rates that meet a condition."""
    return f"""
{name}_fx as (select * from fx where {rates}),
{name}_converted as (
  select e.*, f.fx_rate_gbp_eur as known_rate,
    coalesce(f.fx_rate_gbp_eur, (select median(fx_rate_gbp_eur) from {name}_fx)) as fx_rate_gbp_eur,
    round_even(e.Quantity * e.UnitPrice, 4) as revenue_gbp
  from (select * from enriched where {lines}) e
  asof left join {name}_fx f on cast(e.InvoiceDate as date) >= f.date),
{name} as (
  select InvoiceNo as invoice_no, StockCode as stock_code, Description as description,
    Quantity as quantity, UnitPrice as unit_price_gbp, InvoiceDate as invoice_date,
    CustomerID as customer_id, Country as country, region, population, revenue_gbp,
    round_even(revenue_gbp * fx_rate_gbp_eur, 4) as revenue_eur, fx_rate_gbp_eur,
    left(sha1(concat_ws('|', InvoiceNo, coalesce(StockCode, '<NA>'), CustomerID, cast(Quantity as varchar),
      cast(UnitPrice as varchar), strftime(InvoiceDate, '%Y-%m-%d %H:%M:%S+00:00'))), 12) as row_hash
  from {name}_converted)"""


def _deduplicated(name: str) -> str:
    return f"""
{name}_once as (
  select * exclude (nth) from (
    select *, row_number() over (partition by invoice_no, stock_code, customer_id, row_hash
      order by description nulls first, country nulls first) as nth from {name}) numbered
  where nth = 1)"""


_CHAIN = ",".join(
    [
        _SOURCES,
        _fact("fact"),
        _deduplicated("fact"),
        _fact("early", f"InvoiceDate <= timestamp '{OVERLAP_END}'", f"date <= date '{MARK:%Y-%m-%d}'"),
        _deduplicated("early"),
        _fact("late", f"InvoiceDate > timestamp '{MARK}'"),
        _deduplicated("late"),
        f"""
late_matched as (
  select l.*, e.invoice_no is not null as matched,
    e.invoice_no is not null and l is distinct from e as changed
  from late_once l left join early_once e on l.invoice_no is not distinct from e.invoice_no
    and l.stock_code is not distinct from e.stock_code
    and l.customer_id is not distinct from e.customer_id and l.row_hash = e.row_hash),
feed as (
  select InvoiceNo as invoice_no, StockCode as stock_code, Description as description,
    InvoiceDate as invoice_date, CustomerID as customer_id, Country as country,
    cast(Quantity as decimal(12,0)) * cast(UnitPrice as decimal(14,4)) * cast(1.17 as decimal(3,2)) as revenue_eur
  from cleaned)""",
    ]
)

# The fact holds doubles of 4 places, the feed's lines exact decimals of 6.
_REVENUE = "cast(sum(cast(revenue_eur as decimal(28,6))) as double)"


def _headline(lines: str) -> str:
    return f"""select *, total_revenue / invoices as average_order_value from (
      select {_REVENUE} as total_revenue, count(distinct customer_id) as customers,
        count(distinct invoice_no) as invoices, count(*) as transactions,
        cast(min(invoice_date) as date) as first_day, cast(max(invoice_date) as date) as last_day
      from {lines}) figures"""


def _by(lines: str, key: str, name: str) -> str:
    return f"select {key} as {name}, {_REVENUE} as revenue from {lines} where {key} is not null group by 1"


def _home(lines: str, home: str) -> str:
    return f"""with c as ({_by(lines, "country", "country")}),
      n as (select * from c where country <> '{home}' order by revenue desc, country limit 5),
      t as (select {_REVENUE} as total from {lines})
      select '{home}' as home_market, h.revenue as home_revenue, 100.0e0 * h.revenue / total as home_share_pct,
        next5_markets, next5_revenue, 100.0e0 * next5_revenue / total as next5_share_pct
      from t, (select revenue from c where country = '{home}') h,
        (select string_agg(country, ', ' order by revenue desc, country) as next5_markets,
          cast(sum(cast(revenue as decimal(28,6))) as double) as next5_revenue from n) five"""


def _peak(lines: str) -> str:
    return f"""with m as ({_by(lines, "strftime(invoice_date, '%Y-%m')", "month")}),
      p as (select month, revenue from m order by revenue desc, month limit 1)
      select p.month as peak_month, p.revenue as peak_revenue, median_month_revenue,
        p.revenue / median_month_revenue as peak_vs_median
      from p, (select median(revenue) as median_month_revenue from m) mid"""


def _products(lines: str) -> str:
    return f"""select stock_code, description,
        case when length(description) > 50 then left(description, 50) || '…' else description end
          as description_short,
        revenue, '€' || format('{{:,}}', cast(round_even(revenue, 0) as bigint)) as revenue_text
      from (select stock_code, description, {_REVENUE} as revenue from {lines}
        where stock_code is not null and description is not null
        group by all order by revenue desc, stock_code, description limit 10) best"""


def _weekdays(lines: str) -> str:
    return f"""select cast(isodow(invoice_date) as integer) as weekday_no, dayname(invoice_date) as weekday,
      {_REVENUE} as revenue from {lines} group by all"""


def _euro(value: str) -> str:
    return f"'€' || format('{{:,}}', cast(round_even({value}, 0) as bigint))"


def _percent(value: str) -> str:
    return f"format('{{:.1f}}', {value}) || '%'"


def _concentration(lines: str) -> str:
    return f"""with c as ({_by(lines, "customer_id", "customer_id")}),
      r as (select revenue, row_number() over (order by revenue desc) as nth, count(*) over () as n from c),
      k as (select max(n) as customers, greatest(1, cast(floor(max(n) * 0.01e0) as bigint)) as few,
        cast(sum(cast(revenue as decimal(28,6))) as double) as total from r)
      select customers,
        100.0e0 * (select cast(sum(cast(revenue as decimal(28,6))) as double) from r where nth <= 10) / total
          as top10_share_pct,
        few as top1pct_customers,
        100.0e0 * (select cast(sum(cast(revenue as decimal(28,6))) as double) from r
          where nth <= (select few from k)) / total as top1pct_share_pct
      from k"""

def _repeat(lines: str) -> str:
    return f"""select *, 100 - one_off_pct as repeat_pct from (
      select count(*) as customers, 100 * count(*) filter (invoices = 1) / count(*) as one_off_pct
      from (select customer_id, count(distinct invoice_no) as invoices from {lines}
        where customer_id is not null group by 1) per_customer) shares"""

_SELECTS = {
    "sales_lines": "select * from sales",
    "clean_sales": "select * from cleaned",
    "clean_counters": "select * from counters",
    "normalize_sales": "select * from normalized",
    "normalize_countries": "select * from countries_norm",
    "enrich_countries": "select * from enriched",
    "country_join_misses": """select count(*) filter (region is null) as unmatched_rows,
      count(*) as total_rows from joined""",
    "invoice_days": "select * from days",
    "fx_missing_days": "select invoice_day from days where invoice_day not in (select date from fx)",
    "fx_rate_stats": """select count(*) as rates_fetched, min(fx_rate_gbp_eur) as min_rate,
      max(fx_rate_gbp_eur) as max_rate from fx""",
    "fx_asof": """select invoice_day,
        coalesce(fx_rate_gbp_eur, (select median(fx_rate_gbp_eur) from fx)) as fx_rate_gbp_eur,
        fx_rate_gbp_eur is null as is_fallback
      from days asof left join fx on invoice_day >= fx.date""",
    "fx_asof_lines": """select InvoiceNo, StockCode, InvoiceDate, fx_rate_gbp_eur
      from cleaned asof left join fx on cast(InvoiceDate as date) >= fx.date""",
    "last_purchase": """select e.event_id, p.purchase_value
      from events e asof left join (select user_id, ts, max(value) as purchase_value from events
        where event_type = 'purchase' group by all) p on e.user_id = p.user_id and e.ts >= p.ts""",
    "fx_fallback_rows": """select count(*) filter (known_rate is null) as missing_rows,
      count(*) as total_rows, (select median(fx_rate_gbp_eur) from fx) as fallback_rate
      from fact_converted""",
    "fact_sales": "select * from fact",
    "fact_without_descriptions": "select * replace ('' as description) from fact",
    "run_metrics": """select misses.*, fallback_lines, fallback_rate, days_needed, days_missing, rates.*,
        cast(1 as bigint) as skipped_countries
      from (select count(*) filter (region is null) as unmatched_rows, count(*) as total_rows from joined) misses,
        (select count(*) filter (known_rate is null) as fallback_lines,
          (select median(fx_rate_gbp_eur) from fx) as fallback_rate from fact_converted) fallback,
        (select count(*) as days_needed,
          count(*) filter (invoice_day not in (select date from fx)) as days_missing from days) needed,
        (select count(*) as rates_fetched, min(fx_rate_gbp_eur) as min_rate,
          max(fx_rate_gbp_eur) as max_rate from fx) rates""",
    "row_hash_key": """select invoice_no, stock_code, customer_id, row_hash,
      concat_ws('|', invoice_no, coalesce(stock_code, '<NA>'), customer_id, row_hash) as _bk from fact""",
    "duplicate_keys": """select invoice_no, stock_code, customer_id, row_hash, count(*) as rows
      from fact group by all having count(*) > 1""",
    "quality_report": f"""select rows_in as rows_input, rows_out as rows_output,
        round_even(100 * rows_out / rows_in, 2) as kept_pct, dropped_missing_customer_id,
        round_even(100 * dropped_missing_customer_id / rows_in, 2) as dropped_missing_customer_id_pct,
        dropped_non_positive_quantity, dropped_non_positive_price, metrics.*
      from counters, (select count(*) filter (region = 'unknown') as rows_with_unknown_region,
        count(distinct customer_id) as unique_customers, count(distinct invoice_no) as unique_invoices,
        count(distinct country) as unique_countries, round_even({_REVENUE}, 2) as revenue_eur_total,
        round_even(min(revenue_eur), 2) as revenue_eur_min,
        round_even(max(revenue_eur), 2) as revenue_eur_max from fact) metrics""",
    "contract_report": """select
      (select count(*) from sales where Quantity is null) as sales_without_quantity,
      (select count(*) from sales where InvoiceDate is null) as sales_without_date,
      (select count(*) from countries) as countries_found,
      (select count(*) from fx where not coalesce(fx_rate_gbp_eur between 0.5 and 2.5, false))
        as fx_out_of_bounds,
      (select count(date) - count(distinct date) from fx) as fx_days_repeated,
      (select rows_in - dropped_missing_customer_id - dropped_non_positive_quantity
        - dropped_non_positive_price - rows_out from counters) as lines_unaccounted,
      (select rows_out from counters) - (select count(*) from enriched) as lines_lost_in_join,
      (select count(*) from (select 1 from fact group by invoice_no, stock_code, customer_id, row_hash
        having count(*) > 1) repeated) as keys_repeated""",
    "incremental_sales": f"select * from sales where InvoiceDate > timestamp '{MARK}'",
    "upsert_fact": """select * from late_once union all
      select e.* from early_once e where not exists (select 1 from late_once l
        where l.invoice_no = e.invoice_no and l.stock_code is not distinct from e.stock_code
          and l.customer_id = e.customer_id and l.row_hash = e.row_hash)""",
    "upsert_counts": """select (select count(*) from late) as records,
      count(*) filter (not matched) as upserted, count(*) filter (changed) as modified from late_matched""",
    "next_watermark": "select max(invoice_date) as invoice_date from fact",
    "two_run_load": "select * from fact_once",
    "two_run_counts": f"""select cast(run as integer) as run, records, upserted, cast(0 as bigint) as modified,
        (select max(invoice_date) from fact) as last_watermark
      from (select 1 as run, (select count(*) from fact where invoice_date <= timestamp '{MARK}') as records,
          (select count(*) from fact_once where invoice_date <= timestamp '{MARK}') as upserted
        union all
        select 2, (select count(*) from fact where invoice_date > timestamp '{MARK}'),
          (select count(*) from fact_once where invoice_date > timestamp '{MARK}')) loads""",
    "two_run_headline": _headline("fact_once"),
    "two_run_products": _products("fact_once"),
    "stream_load": "select * from fact_once",
    "sales_csv_scan": f"select * from sales where InvoiceDate > timestamp '{MARK}'",
    "countries_json_scan": "select * from countries",
    "fx_json_scan": "select * from fx",
    "staged_fact": "select * from fact",
    "headline_metrics": _headline("fact"),
    "headline_text": f"""select first_day || ' → ' || last_day as period,
      {_euro("total_revenue")} as total_revenue, format('{{:,}}', customers) as customers,
      format('{{:,}}', invoices) as invoices, {_euro("average_order_value")} as average_order_value,
      format('{{:,}}', transactions) as transactions from ({_headline("fact")}) headline""",
    "revenue_by_country": _by("fact", "country", "country"),
    "home_market_share": _home("fact", "united kingdom"),
    "revenue_by_month": _by("fact", "strftime(invoice_date, '%Y-%m')", "month"),
    "top_months": _by("fact", "strftime(invoice_date, '%Y-%m')", "month")
    + " order by revenue desc, month limit 5",
    "peak_month": _peak("fact"),
    "customer_concentration": _concentration("fact"),
    "customer_concentration_text": f"""select format('{{:,}}', customers) as customers,
      {_percent("top10_share_pct")} as top10_share_pct,
      format('{{:,}}', top1pct_customers) as top1pct_customers,
      {_percent("top1pct_share_pct")} as top1pct_share_pct from ({_concentration("fact")}) figures""",
    "repeat_customers": _repeat("fact"),
    "repeat_customers_text": f"""select format('{{:,}}', customers) as customers,
      {_percent("one_off_pct")} as one_off_pct, {_percent("repeat_pct")} as repeat_pct
      from ({_repeat("fact")}) figures""",
    "home_market_text": f"""select home_market, {_euro("home_revenue")} as home_revenue,
      {_percent("home_share_pct")} as home_share_pct, next5_markets, {_euro("next5_revenue")} as next5_revenue,
      {_percent("next5_share_pct")} as next5_share_pct from ({_home("fact", "united kingdom")}) figures""",
    "peak_month_text": f"""select peak_month, {_euro("peak_revenue")} as peak_revenue,
      {_euro("median_month_revenue")} as median_month_revenue,
      format('{{:.1f}}', peak_vs_median) || '×' as peak_vs_median from ({_peak("fact")}) figures""",
    "top_products": _products("fact"),
    "weekday_revenue": f"""select cast(d as integer) as weekday_no,
        dayname(date '2024-01-01' + cast(d - 1 as integer)) as weekday, revenue
      from range(1, 8) days(d) left join ({_weekdays("fact")}) sold on weekday_no = d""",
    "revenue_by_region": f"""select region, {_REVENUE} as revenue_eur, count(distinct invoice_no) as invoices
      from fact group by region""",
    "revenue_trend": _by("fact", "cast(invoice_date as date)", "day"),
    "high_value_customers": f"""select customer_id, {_REVENUE} as revenue,
      count(distinct invoice_no) as invoices from fact where customer_id is not null
      group by 1 order by revenue desc, customer_id limit 100""",
    "invoice_rollup": f"""select invoice_no, customer_id, country, date_trunc('day', invoice_date) as invoice_date,
      {_REVENUE} as revenue_eur, count(*) as lines from fact group by all""",
    "constant_rate_headline": _headline("feed"),
    "constant_rate_home_share": _home("feed", "United Kingdom"),
    "constant_rate_peak_month": _peak("feed"),
    "constant_rate_concentration": _concentration("feed"),
    "constant_rate_repeat": _repeat("feed"),
    "constant_rate_top_months": _by("feed", "strftime(invoice_date, '%Y-%m')", "month")
    + " order by revenue desc, month limit 5",
    "constant_rate_top_products": _products("feed"),
    "constant_rate_weekdays": _weekdays("feed"),
}


def oracles() -> dict[str, str]:
    return {name: f"with {_CHAIN}\nselect * from ({select}) result" for name, select in _SELECTS.items()}
